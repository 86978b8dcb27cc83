"""Flags in context against all sequences of flags, and the stemmer for vocabularies."""

import itertools
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from broadsheet.functions import porter
from broadsheet.operators import analyzer, keywords, segment, tagging

FLAGS = ("a", "n", "v")


def slow_flags(terms, options, transitions, unlisted):
    """The cheapest sequence; of equal ones that with the smaller flags, compared from the end."""
    choices = [options.get(t) or [("x", 0)] for t in terms]

    def price(path):
        prev, total = "", 0
        for flag, cost in path:
            total, prev = total + cost + transitions.get((prev, flag), unlisted), flag
        return total, [flag for flag, _ in path][::-1]

    return [flag for flag, _ in min(itertools.product(*choices), key=price)]


@pytest.mark.parametrize("seed", range(4))
def test_best_of_all_sequences(seed):
    chance = random.Random(seed)
    for _ in range(200):
        options = {t: sorted((f, chance.randrange(5)) for f in chance.sample(FLAGS, chance.randrange(1, 4))) for t in "pqrst"}
        transitions = {(p, f): chance.randrange(6) for p in ("", *FLAGS) for f in FLAGS if chance.random() < 0.8}
        terms = chance.choices("pqrstz", k=chance.randrange(0, 7))
        assert tagging.best_flags(terms, options.get, transitions, 9) == (slow_flags(terms, options, transitions, 9) if terms else [])


@pytest.fixture(scope="module")
def tables(spark):
    lexicon = spark.createDataFrame(
        [("saw", "n", 3), ("saw", "v", 3), ("we", "p", 9), ("the", "d", 9), ("old", "a", 5), ("old", "n", 1), ("gone", "v", 0)],
        "term string, flag string, freq long")
    moves = spark.createDataFrame(
        [("", "p", 5), ("", "d", 5), ("p", "v", 9), ("v", "d", 8), ("d", "n", 6), ("d", "a", 4), ("a", "n", 9), ("n", "v", 3)],
        "prev string, flag string, freq long")
    return lexicon, moves


@pytest.mark.parametrize("max_rows", [tagging.LEXICON_ROWS, 0])
def test_flags_in_context(spark, tables, max_rows):
    docs = spark.createDataFrame(
        [(1, "we saw the old saw. the old gone"), (2, None), (3, ""), (4, "unheard!saw"), (5, "we saw. " * 20_000)],
        "id long, text string")
    found = tagging.tag_tokens(docs, ["id"], *tables, max_rows=max_rows)
    rows = {}
    for r in found.collect():
        rows.setdefault(r.id, []).append((r.pos, r.term, r.flag))
    assert rows[1] == [(0, "we", "p"), (2, "saw", "v"), (4, "the", "d"), (6, "old", "a"), (8, "saw", "n"),
                       (11, "the", "d"), (13, "old", "a"), (15, "gone", "x")]
    assert [r[1:] for r in rows[4]] == [("unheard", "x"), ("saw", "v")] and set(rows) == {1, 4, 5}
    assert len(rows[5]) == 40_000 and {f for _, t, f in rows[5] if t == "saw"} == {"v"}
    kept = keywords.pos_filter(found.drop("flag"), spark.createDataFrame([("saw", "n")], "term string, flag string"), ("n",), True)
    assert kept.where("id = 1").count() == 2  # without context both are nouns
    nouns = tagging.tagged_frequencies(found, ["id"], ("n",), with_flag=True).where("id = 1").collect()
    assert [(r.term, r.flag, r.freq, r.total) for r in nouns] == [("saw", "n", 1, 1)]


def test_ready_tokens_and_empty_tables(spark, tables):
    lexicon, moves = tables
    words = spark.createDataFrame([("中国", 3), ("人民", 3)], "word string, freq long")
    docs = spark.createDataFrame([(1, "中国人民。saw")], "id long, text string")
    cut = segment.with_tokens(docs, ["id"], words)
    more = lexicon.unionByName(spark.createDataFrame([("中国", "ns", 1), ("人民", "n", 1)], lexicon.schema))
    found = tagging.tag_tokens(cut, ["id"], more, moves, "tokens").collect()
    assert [(r.term, r.flag) for r in found] == [("中国", "ns"), ("人民", "n"), ("saw", "v")]
    bare = tagging.tag_tokens(docs, ["id"], lexicon.limit(0), moves.limit(0)).collect()
    assert {r.flag for r in bare} == {tagging.UNKNOWN}
    assert tagging.tag_tokens(docs.limit(0), ["id"], *tables).count() == 0
    with pytest.raises(ValueError):
        tagging.transition_costs(spark.range(tagging.MOST_TRANSITIONS + 1).select(
            F.lit("").alias("prev"), F.col("id").cast("string").alias("flag"), F.lit(1).alias("freq")))


def test_word_and_column_stems_are_equal(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    words = keywords.word_count(docs).select(F.lower("term").alias("term")).distinct()
    made = ["caresses", "ponies", "ties", "cats", "feed", "agreed", "plastered", "motoring", "sing", "hopping", "falling",
            "hissing", "failing", "filing", "happy", "sky", "relational", "rational", "yes", "yoyo", "controll", "roll",
            "adoption", "sensibility", "y", "by", "ééé", "oed", "aing", "generalizations", "oscillators"]
    words = words.unionByName(spark.createDataFrame([(w,) for w in made], "term string"))
    rows = words.select("term", porter.stem(F.col("term")).alias("stem")).collect()
    assert len(rows) > 5000
    assert [r.stem for r in rows] == [porter.stem_word(r.term) for r in rows]


def test_stem_function_and_stop_table(spark):
    docs = spark.createDataFrame([(1, "The Cats were hopping and jumping")], "id long, text string")
    def terms(**options):
        return [r.term for r in analyzer.analyze(docs, ["id"], **options).collect()]
    assert terms() == ["cat", "were", "hop", "jump"]
    assert terms(stem=None) == terms(stem=False) == ["cats", "were", "hopping", "jumping"]
    assert terms(stem=lambda w: w[:3]) == ["cat", "wer", "hop", "jum"]
    listed = spark.createDataFrame([("were",), ("the",), ("and",), ("were",), ("Cats",)], "term string")
    assert terms(stop_words=listed) == ["cat", "hop", "jump"]


@pytest.mark.parametrize("seed", range(40))
def test_sentences_together_as_alone(monkeypatch, seed):
    chance = random.Random(seed)
    monkeypatch.setattr(tagging, "SLICE_TOKENS", chance.choice([3, 50, 10_000]))
    monkeypatch.setattr(tagging, "TOGETHER", chance.choice([1, 2, 4]))
    options = {t: [(f, chance.randrange(5)) for f in chance.sample("anvx", chance.randrange(1, 5))] for t in "pqrst"}
    moves = {(p, f): chance.randrange(6) for p in ("", *"anvx") for f in "anvx" if chance.random() < 0.8}
    rows = [chance.choice([None, [], chance.choices("pqrstz .!", k=chance.randrange(30))]) for _ in range(chance.randrange(12))]
    rare = [None if r is None else [
        {"term": t, "flag": f, "cost": c} for t in sorted({*r} & {*"rst"}) for f, c in options[t]] for r in rows]
    kind = pa.list_(pa.struct([("term", pa.string()), ("flag", pa.string()), ("cost", pa.int64())]))
    found = tagging._tagged(pa.array(rows, pa.list_(pa.string())), pa.array(rare, kind), {t: options[t] for t in "pq"}, moves, 9)

    def alone(tokens):
        marks = [-1, *(k for k, t in enumerate(tokens) if t in ".!"), len(tokens)]
        for a, b in zip(marks, marks[1:]):
            places = [k for k in range(a + 1, b) if tokens[k] != " "]
            for k, flag in zip(places, tagging.best_flags([tokens[k] for k in places], options.get, moves, 9)):
                yield {"pos": k, "term": tokens[k], "flag": flag}

    assert found.to_pylist() == [None if r is None else [*alone(r)] for r in rows]


def test_large_lexicon_with_null_and_repeated_ids(spark, tables):
    docs = spark.createDataFrame(
        [(None, "we saw the old saw"), (None, "the gone saw"), (1, "we saw"), (1, "the old saw. we saw")], "id long, text string")
    whole, split = (
        sorted((str(r.id), r.pos, r.term, r.flag) for r in tagging.tag_tokens(docs, ["id"], *tables, max_rows=n, hot_terms=2).collect())
        for n in (tagging.LEXICON_ROWS, 0))
    assert whole == split and len(whole) == 15
    rows = tagging.tag_tokens(docs, ["id"], *tables)
    arrays = tagging.tag_tokens(docs, ["id"], *tables, exploded=False)
    for options in ({"with_flag": True}, {"allow_pos": ("n", "v"), "with_flag": True}, {"allow_pos": ("v",)}):
        a, b = (tagging.tagged_frequencies(x, ["id"], stop_words=(), **options) for x in (rows, arrays))
        assert a.count() and a.exceptAll(b.select(*a.columns)).isEmpty() and a.count() == b.count()


def test_sentences_are_read_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def read(text):
        seen.add(1)
        return text

    text = read("text")
    docs = spark.createDataFrame([("a",), ("b",), ("c",)], "text string").select(
        F.array(F.struct(text.alias("term"), F.lit("n").alias("flag"))).alias("words"))
    lexicon, moves = tagging.learn_tags(docs)
    assert lexicon.count() == 3 and moves.collect() == [("", "n", 3)] and seen.value == 3


@pytest.mark.parametrize("max_rows", [tagging.LEXICON_ROWS, 0])
def test_sentences_are_tagged_once(spark, tables, max_rows):
    docs = spark.createDataFrame([(1, "we saw")], "id long, text string").repartition(4, "id")
    found = tagging.tag_tokens(docs, ["id"], *tables, max_rows=max_rows)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1 and found.count() == 2
