"""Dictionary segmentation against all segmentations of a run, and ready tokens in place of texts."""

import itertools
import math
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from broadsheet.operators import analyzer, graph, index, keywords, segment

CHARS = "中国人民大会堂"


def all_paths(run):
    for cuts in itertools.product((False, True), repeat=len(run) - 1):
        marks = [0, *(k + 1 for k, cut in enumerate(cuts) if cut), len(run)]
        yield list(zip(marks, marks[1:]))


def slow_path(run, costs, unlisted):
    """The cheapest segmentation of all; of equal ones that with the longer first different word."""
    def price(path):
        found = [costs.get(run[a:b], unlisted if b - a == 1 else None) for a, b in path]
        return None if None in found else (sum(found), [a - b for a, b in path])

    return min((p for p in all_paths(run) if price(p)), key=price)


@pytest.mark.parametrize("seed", range(5))
def test_path_is_the_best_of_all(seed):
    chance = random.Random(seed)
    words = {"".join(chance.choices(CHARS, k=chance.randrange(1, 5))): chance.randrange(1, 9) for _ in range(25)}
    costs = {w: round(1e6 * math.log(sum(words.values()) / n)) for w, n in words.items()}
    unlisted = round(1e6 * math.log(sum(words.values())))
    for _ in range(150):
        run = "".join(chance.choices(CHARS, k=chance.randrange(1, 10)))
        path = segment.best_path(run, costs.get, unlisted, 4)
        assert [(a, b) for a, b, _ in path] == slow_path(run, costs, unlisted)
        assert all(listed == (run[a:b] in costs) for a, b, listed in path)


@pytest.fixture(scope="module")
def dictionary(spark):
    return spark.createDataFrame(
        [("中国", 5), ("人民", 5), ("中国人民", 2), ("大会堂", 3), ("国", 1), ("latin", 9), ("人民", 1), ("会", 0)],
        "word string, freq long")


TEXT = "在中国人民大会堂X了y2 中国人天"


@pytest.mark.parametrize("max_rows", [segment.DICTIONARY_ROWS, 0])
def test_tokens_and_offsets(spark, dictionary, max_rows):
    docs = spark.createDataFrame(
        [(1, TEXT), (2, None), (3, ""), (4, "no Chinese"), (5, "天" * 5), (5 + 1, "中国" * 20_000)], "id long, text string")
    found = {r.id: r.tokens for r in segment.with_tokens(docs, ["id"], dictionary, max_rows=max_rows).collect()}
    assert [t.term for t in found[1]] == ["在", "中国人民", "大会堂", "X", "了", "y2", " ", "中国", "人天"]
    assert all(TEXT[t.startpos:t.endpos] == t.term for t in found[1])
    assert found[2] is None and found[3] == []
    assert [t.term for t in found[4]] == ["no", " ", "Chinese"]
    assert [(t.term, t.startpos, t.endpos) for t in found[5]] == [("天天", k, k + 2) for k in range(4)]
    assert len(found[6]) == 20_000 and {t.term for t in found[6]} == {"中国"}


def test_empty_dictionary_gives_pairs(spark, dictionary):
    docs = spark.createDataFrame([(1, TEXT)], "id long, text string")
    found = segment.with_tokens(docs, ["id"], dictionary.limit(0)).first().tokens
    plain = analyzer.tokens_with_offsets(docs, ["id"]).collect()
    assert [t.term for t in found] == [r.term for r in keywords.explode_tokens(docs, ["id"]).collect()]
    assert analyzer.tokens_with_offsets(segment.with_tokens(docs, ["id"], dictionary.limit(0)), ["id"], "tokens").collect() == plain


def test_ready_tokens_in_place_of_texts(spark, dictionary):
    docs = spark.createDataFrame([(1, TEXT + " the the bb"), (2, "大会堂 bb")], "id long, text string")
    cut = segment.with_tokens(docs, ["id"], dictionary)
    plain = cut.select("id", F.transform("tokens", lambda t: t["term"]).alias("tokens"))
    for ready in (cut, plain):
        rows = keywords.term_frequencies(ready, ["id"], "tokens").collect()
        assert {(r.id, r.term): r.freq for r in rows} == {
            (1, "中国人民"): 1, (1, "大会堂"): 1, (1, "y2"): 1, (1, "中国"): 1, (1, "人天"): 1, (1, "bb"): 1,
            (2, "大会堂"): 1, (2, "bb"): 1}
        best = keywords.extract_keywords(ready, ["id"], "tokens", k=2).collect()
        assert [(r.id, r.term) for r in best if r.id == 1] == [(1, "y2"), (1, "中国")]
        assert {r.term: r.n for r in keywords.word_count(ready, "tokens").collect()}["大会堂"] == 2
        assert graph.textrank_keywords(ready, ["id"], "tokens").where("id = 2").count() == 2
    with pytest.raises(ValueError):
        analyzer.tokens_with_offsets(plain, ["id"], "tokens")


def test_long_chinese_terms_are_indexed(spark):
    words = spark.createDataFrame([("中国人民大会", 3), ("大会堂", 9)], "word string, freq long")
    found = spark.createDataFrame([("u1", "中国人民大会", "大会堂"), ("u2", "中国人民大会", None)], "url string, title string, content string")
    cut = segment.with_tokens(found, ["url"], words, {"title": "title", "content": "content"})
    lists = {r.term: r.urls for r in index.full_index(cut).collect()}
    assert lists == {"中国人民大会": ["u1", "u2"], "大会堂": ["u1"]}


def test_python_holds_a_slice_of_the_rows(monkeypatch):
    monkeypatch.setattr(segment, "SLICE_CHARACTERS", 2_000)
    rows = pa.array([None, [], *([["中国人民", "y", " "] * 100] * 1000)], pa.list_(pa.string()))
    costs = {"中国": 1, "人民": 1}
    tracemalloc.start()
    found = segment._cut(rows, lambda row: costs.get, 9, 2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.null_count == 1 and len(found) == 1002 and len(found.flatten()) == 400_000
    assert found[2].as_py()[:3] == [
        {"term": "中国", "startpos": 0, "endpos": 2}, {"term": "人民", "startpos": 2, "endpos": 4}, {"term": "y", "startpos": 4, "endpos": 5}]
    assert peak < 10 << 20  # 100 MB and more for all rows at once


def test_texts_are_cut_once(spark, dictionary):
    docs = spark.createDataFrame([(1, TEXT)], "id long, text string").repartition(4, "id")
    found = segment.with_tokens(docs, ["id"], dictionary).select("id", F.posexplode("tokens"))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1 and found.count() == 9


KINDS = np.array([2 if "一" <= chr(c) <= "鿕" else chr(c).isalnum() for c in range(0x110000)], np.uint8)


@pytest.mark.parametrize("seed", range(40))
def test_runs_cut_together_are_cut_as_alone(seed, monkeypatch):
    chance = random.Random(seed)
    monkeypatch.setattr(segment, "LONG_RUN", chance.choice([3, 6, 256]))
    monkeypatch.setattr(segment, "SLICE_CHARACTERS", chance.choice([5, 40, 500_000]))
    chars = "中国人民大会堂一鿕"
    words = {"".join(chance.choices(chars, k=chance.randrange(1, 6))): chance.randrange(1, 9) for _ in range(chance.randrange(25))}
    costs = {w: round(1e6 * math.log(sum(words.values()) / n)) for w, n in words.items()}
    unlisted, longest = round(1e6 * math.log(sum(words.values()) or 1)), max(map(len, words), default=1)
    rows = [None, [], *(
        re.findall("[一-鿕]+|[xé]+|(?s:.)", "".join(chance.choices([*chars * 3, "天", "x", " ", "é", "💥", "\n"], k=chance.randrange(60))))
        for _ in range(30))]
    column = pa.concat_arrays([pa.array(rows, pa.list_(pa.string()))] * 2).slice(5, 50)
    texts = pa.array(column.to_pandas().map(lambda x: None if x is None else "".join(x)), pa.string())
    found = segment._cut_texts(pa.concat_arrays([texts, texts])[50:], KINDS, segment.Trie.of(costs), unlisted, longest)
    found.validate(full=True)
    assert found.equals(segment._cut(column, lambda row: costs.get, unlisted, longest))


def test_no_run_of_usual_length_is_cut_by_itself(monkeypatch):
    monkeypatch.setattr(segment, "SLICE_CHARACTERS", 2_000)
    monkeypatch.setattr(segment, "best_path", None)
    rows = pa.array([None, "", *(["中国人民y人民中国天 " * 100] * 1000)])
    trie = segment.Trie.of({"中国": 1, "人民": 1, "中国\n": 1})
    tracemalloc.start()
    found = segment._cut_texts(rows, KINDS, trie, 9, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.null_count == 1 and len(found) == 1002 and len(found.flatten()) == 700_000
    assert [t["term"] for t in found[2].as_py()[:6]] == ["中国", "人民", "y", "人民", "中国", "天"]
    # the result is allocated for as many tokens as characters; 100 MB more for all rows at once
    assert peak < (8 + 8 + 4 + 2 * 3) * 1_100_000 + (8 << 20)


def test_characters_are_of_the_kind_they_have_in_regular_expressions(spark):
    texts = ["aé1²Ⅷx y_z中国a😀b\n\t", "𝔘𝟘𠀀龦鿕鿖ａ々〇", "e\u0301 ẞ\u200d\x00", "", None, "٣ৡ中 中"]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id int, text string")
    empty = spark.createDataFrame([], "word string, freq long")
    found = {r.id: r for r in segment.with_tokens(rows, ["id"], empty).select(
        "id", "tokens", F.regexp_extract_all("text", F.lit(segment.PIECE), F.lit(0)).alias("pieces")).collect()}
    for k, text in enumerate(texts):
        if text is None:
            assert found[k].tokens is None
            continue
        plain = [t for p in found[k].pieces for t in ([p[i:i + 2] for i in range(max(1, len(p) - 1))] if "一" <= p[0] <= "鿕" else [p])]
        assert [t.term for t in found[k].tokens] == plain
        assert all(text[t.startpos:t.endpos] == t.term for t in found[k].tokens)


def test_hashed_edges_lead_to_every_word():
    chance = random.Random(1)
    costs = {"".join(chr(0x4E00 + chance.randrange(5000)) for _ in range(chance.randrange(1, 4))): k for k in range(20_000)}
    trie = segment.Trie.of(costs)
    letters = np.concatenate([np.append(trie.numbered(np.array([*map(ord, w)])), 0) for w in costs])
    starts = np.cumsum([0, *(len(w) + 1 for w in costs)][:-1])
    found = {(s, n): c for s, n, c in zip(*(x.tolist() for x in trie.words_in(letters)))}
    assert all(found[s, len(w)] == c for s, (w, c) in zip(starts.tolist(), costs.items()))
