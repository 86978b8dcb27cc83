import re

from broadsheet.llm import decontaminate as d
from broadsheet.llm.queries import QUERIES


def slow_tiles(item, doc, least=5):
    """Greedy string tiling as first described, word by word."""
    a, b, tiles = [False] * len(item), [False] * len(doc), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and not a[i + n] and not b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return sorted(tiles)
        a[i: i + n], b[j: j + n] = [True] * n, [True] * n
        tiles.append((i, j, n))


def words(text):
    return re.findall(r"\w+", (text or "").lower())


ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
TEXTS = [
    ITEM, "x y " + ITEM.upper() + " z", "eight nine ten eleven twelve thirteen fourteen fifteen, and one two three four five six seven!",
    "one two three four five", ITEM + " " + ITEM, "a b a b a b a b a b a b", "", None,
]


def found(text, items, coverage=0.8):
    return {h["item_id"]: [tuple(t.values()) for t in h["tiles"]] for h in d.Items(items).search(text, coverage)}


def test_tiles_as_by_hand():
    items = [(1, ITEM), (2, "a b a b a b"), (3, "too short"), (4, None)]
    for text in TEXTS:
        expected = {}
        for k, item in items[:2]:
            tiles = slow_tiles(words(item), words(text))
            if sum(n for *_, n in tiles) >= 0.8 * len(words(item)):
                expected[k] = tiles
        assert found(text, items) == expected


def test_passages_in_another_order_count():
    assert found(TEXTS[2], [(1, ITEM)]) == {1: [(0, 9, 7), (7, 0, 8)]}
    assert found(TEXTS[3], [(1, ITEM)]) == {}


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    expected = set()
    for doc_id, text in docs:
        joined = f" {' '.join(words(text))} "
        for k, item in items:
            w = words(item)
            if any(f" {' '.join(w[i: i + 5])} " in joined for i in range(len(w) - 4)):
                tiles = slow_tiles(w, words(text))
                if sum(n for *_, n in tiles) >= 0.8 * len(w):
                    expected.add((doc_id, k, ",".join(":".join(map(str, t)) for t in tiles)))
    result = QUERIES["op2_decontamination"](spark, folder).collect()
    assert {(r.doc_id, r.item_id, r.tiles) for r in result} == expected and expected


def test_edge_cases(spark, make_docs):
    docs = make_docs((1, None), (2, ""), (3, "say " + ITEM), (3, "say " + ITEM), (None, ITEM), (4, "w " * 300_000))
    items = spark.createDataFrame([(1, ITEM), (None, ITEM), (2, None), (3, "")], "item_id long, text string")
    leaks = d.find_leaks(docs, items).collect()
    assert sorted((r.doc_id or 0, r.item_id or 0) for r in leaks) == sorted([(3, 1), (3, 0)] * 2 + [(0, 1), (0, 0)])
    kept = d.drop_leaks(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 4]
    assert d.drop_leaks(docs, items.limit(0)).count() == 6
    assert d.find_leaks(docs, items.limit(0)).count() == 0
    assert d.find_leaks(docs.limit(0), items).count() == 0


def test_blocks_find_the_same(spark, make_docs, monkeypatch):
    docs = make_docs((1, ITEM), (2, "six seven eight nine ten eleven"))
    items = spark.createDataFrame([(1, ITEM), (2, "six seven eight nine ten eleven")], "item_id long, text string")
    whole = sorted((r.doc_id, r.item_id) for r in d.find_leaks(docs, items).collect())
    few = d.blocks(items, 40)
    assert len(few) > 1 and sum(map(len, few)) == 2
    monkeypatch.setattr(d, "blocks", lambda b: few)
    assert sorted((r.doc_id, r.item_id) for r in d.find_leaks(docs, items).collect()) == whole == [(1, 1), (1, 2), (2, 2)]
