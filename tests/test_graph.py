"""Graph ranking against a plain one-document-at-a-time computation."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from broadsheet.functions.fixed_values import KEYWORD_STOP_WORDS
from broadsheet.operators import graph
from broadsheet.plans import queries

FOLDER = "/root/testdata/sf0.001"


def brute_force(tokens, span=5, rounds=10):
    """Ranks of one token list, straight from the definition."""
    def keep(t):
        return len(t.strip()) >= 2 and t.lower() not in KEYWORD_STOP_WORDS

    pairs = Counter(
        (a, b)
        for i, a in enumerate(tokens) if keep(a)
        for b in tokens[i + 1:i + span] if keep(b)
    )
    near = defaultdict(Counter)
    for (a, b), w in pairs.items():
        near[a][b] += w
        near[b][a] += w
    out = {n: sum(e.values()) for n, e in near.items()}
    rank = {n: 1 / len(near) for n in near}
    for _ in range(rounds):
        for n in sorted(near):
            rank[n] = 0.15 + 0.85 * sum(w / out[m] * rank[m] for m, w in near[n].items())
    low, high = min(rank.values(), default=0), max(rank.values(), default=0)
    return pairs, near, {n: (r - low / 10) / (high - low / 10) for n, r in rank.items()}


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").limit(40)
    extra = [(-1, "aa bb the aa"), (-2, ""), (-3, "alone"), (-4, "aa aa"), (-5, "the of")]
    made = spark.createDataFrame(extra, "doc_id long, text string")
    return rows.select("doc_id", "text").unionByName(made).cache()


@pytest.fixture(scope="module")
def expected(docs):
    from broadsheet.functions.text import tokens
    return {r.doc_id: brute_force(r.tokens)
            for r in docs.select("doc_id", tokens("text").alias("tokens")).collect()}


def test_pairs_and_graph(docs, expected):
    kept = graph.kept_tokens(docs, ["doc_id"])
    got = {(r.doc_id, r.src, r.dst): r.w for r in graph.cooccurrence(kept, ["doc_id"]).collect()}
    assert got == {(d, a, b): w for d, (p, _, _) in expected.items() for (a, b), w in p.items()}
    edges = {(r.doc_id, r.src, r.dst): r.w for r in graph.term_graph(kept, ["doc_id"]).collect()}
    assert edges == {(d, a, b): w for d, (_, g, _) in expected.items()
                     for a, near in g.items() for b, w in near.items()}
    assert all(edges[(d, b, a)] == w for (d, a, b), w in edges.items())
    strength = {(r.doc_id, r.src): r.strength
                for r in graph.node_strength(kept, ["doc_id"]).collect()}
    assert strength == {(d, a): sum(near.values()) for d, (_, g, _) in expected.items()
                        for a, near in g.items()}


@pytest.mark.parametrize("chunk", [None, 1, 300])
def test_ranks(docs, expected, monkeypatch, chunk):
    if chunk:
        monkeypatch.setattr(graph, "TOKENS_PER_CHUNK", chunk)
    kept = graph.kept_tokens(docs, ["doc_id"])
    got = {(r.doc_id, r.term): r.weight for r in graph.textrank(kept, ["doc_id"]).collect()}
    want = {(d, n): r for d, (_, _, ranks) in expected.items() for n, r in ranks.items()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert max(got.values()) <= 1 and min(got.values()) > 0


def test_self_pair_counts_twice_and_gap_counts_filtered_tokens(spark):
    docs = spark.createDataFrame([(1, "aa.aa"), (2, "aa bb the cc")], "doc_id long, text string")
    kept = graph.kept_tokens(docs, ["doc_id"])
    edges = {(r.doc_id, r.src, r.dst): r.w for r in graph.term_graph(kept, ["doc_id"]).collect()}
    assert edges == {(1, "aa", "aa"): 2, (2, "aa", "bb"): 1, (2, "bb", "aa"): 1,
                     (2, "bb", "cc"): 1, (2, "cc", "bb"): 1}


def test_top_terms_and_parts_of_speech(spark, docs):
    top = graph.textrank_keywords(docs, ["doc_id"], k=3)
    assert top.groupBy("doc_id").count().agg(F.max("count")).first()[0] == 3
    lexicon = spark.createDataFrame([("aa", "n"), ("bb", "v"), ("cc", "x")],
                                    "term string, flag string")
    made = spark.createDataFrame([(1, "aa bb cc aa")], "doc_id long, text string")
    flagged = graph.textrank_keywords(made, ["doc_id"], lexicon=lexicon, with_flag=True).collect()
    assert {(r.term, r.flag) for r in flagged} == {("aa", "n"), ("bb", "v")}
    plain = graph.textrank_keywords(made, ["doc_id"], lexicon=lexicon, allow_pos=("n", "x"))
    assert {r.term for r in plain.collect()} == {"aa", "cc"}
    assert graph.textrank_keywords(made, ["doc_id"], lexicon=lexicon, allow_pos=()).count() == 0


def test_all_ids_and_batches_are_ranked(spark):
    ranked = graph.textrank(queries._kept(spark, FOLDER), ["doc_id"])
    best = ranked.groupBy("doc_id").agg(F.max("weight").alias("best"))
    assert best.filter(F.abs(F.col("best") - 1) > 1e-9).isEmpty()


def test_a_row_gives_k_terms_to_the_sort(spark, docs, monkeypatch):
    whole = graph.textrank_keywords(docs, ["doc_id"], k=None).filter("rank <= 3")
    cut = graph.textrank_keywords(docs, ["doc_id"], k=3)
    assert whole.count() == cut.count() and whole.exceptAll(cut).isEmpty()
    monkeypatch.setattr(graph, "top_terms", lambda ranked, *_, **__: ranked.withColumn("rank", F.lit(1)))
    assert graph.textrank_keywords(docs, ["doc_id"], k=3).groupBy("doc_id").count().agg(F.max("count")).first()[0] == 3
