import random
import re

import numpy as np
import pytest

from broadsheet.llm import jaccard


def slow_set(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if len(words) < 3:
        return {tuple(words)} if words else set()
    return {tuple(words[i: i + 3]) for i in range(len(words) - 2)}


def slow_classes(texts, percent=90):
    """Least place reachable of each text, by comparing all pairs."""
    sets, root = [slow_set(t) for t in texts], list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def check(spark, texts, percent=90):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8, "doc_id")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(docs, percent=percent).collect()}
    assert [found[i] for i in range(len(texts))] == slow_classes(texts, percent)


def edited(chance, words, edits):
    words = list(words)
    for _ in range(edits):
        words[chance.randrange(len(words))] = f"e{chance.randrange(10 ** 9)}"
    return words


def test_bounds():
    for a in range(1, 60):
        for b in range(1, 60):
            least = next(o for o in range(1000) if 100 * o >= 90 * (a + b - o))
            assert jaccard.needed(a, b) == least
            if least <= min(a, b):  # rows that link share a column of their prefixes, whatever the order
                assert a - jaccard.prefix_length(a) + 1 <= least


def test_columns_and_counts_by_hand():
    known = jaccard._Words()
    for text in (None, "", " \t\n", "One", "a B", "a b c", "a b c a b c a", "É x  y\nz É x y", "w " * 100_000):
        assert len(jaccard.columns(text, known)) == len(slow_set(text))
    assert (jaccard.columns("A b C", known) == jaccard.columns("a B\tc", known)).all()
    chance = random.Random(3)
    for _ in range(300):
        n = chance.randrange(1, 60)
        base = [chance.getrandbits(64) for _ in range(n)]
        a = np.unique(np.array(base, np.uint64))
        b = np.unique(np.array([x if chance.random() < 0.95 else chance.getrandbits(64) for x in base], np.uint64))
        both = len(np.intersect1d(a, b))
        assert jaccard.overlap_reaches(a, b) == (100 * both >= 90 * (len(a) + len(b) - both))
        # the parities never rule out a pair that links
        differ = int(np.bitwise_count(jaccard.parities(a) ^ jaccard.parities(b)).sum())
        assert differ <= len(a) + len(b) - 2 * both


def test_planted_groups(spark, monkeypatch):
    """Copies, chains, near misses and a passage that half of the texts share; a short table of columns."""
    monkeypatch.setattr(jaccard, "MAX_LEVELS", 10)
    chance, texts = random.Random(5), []
    passage = [f"p{i}" for i in range(60)]
    for _ in range(60):
        words = [f"w{chance.randrange(300)}" for _ in range(chance.randrange(1, 150))]
        if chance.random() < 0.5:
            words += passage
        for _ in range(chance.choice((1, 1, 2, 6))):
            texts.append(" ".join(edited(chance, words, chance.randrange(0, 1 + len(words) // 30))))
    words = [f"c{i}" for i in range(200)]
    for _ in range(12):  # each links with its neighbours only
        words = edited(chance, words, 3)
        texts.append(" ".join(words))
    chance.shuffle(texts)
    check(spark, texts)
    check(spark, texts, percent=80)


def test_large_group_of_near_copies(spark, monkeypatch):
    """All rows of a group share most columns; wanted keys are joined by shuffle here."""
    monkeypatch.setattr(jaccard, "WANTED_ROWS", 0)
    chance = random.Random(7)
    words = [f"g{i}" for i in range(120)]
    texts = [" ".join(edited(chance, words, chance.randrange(0, 3))) for _ in range(400)]
    texts += [" ".join(edited(chance, words, 9)) for _ in range(100)]
    texts += [" ".join(words)] * 300
    check(spark, texts)


def near_misses(chance, groups, size, words, edits):
    """Groups of texts that share many columns, most pairs just not enough to link."""
    texts = []
    for g in range(groups):
        base = [f"m{g}x{i}" for i in range(words)]
        texts += [" ".join(edited(chance, base, chance.choice(edits))) for _ in range(size)]
    return texts


@pytest.mark.parametrize("size", [4, 24])  # small cells and large ones
def test_rows_that_share_many_columns_are_paired_once(spark, monkeypatch, size):
    texts = near_misses(random.Random(11), 24 // size, size, 3000, [40])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    order = jaccard.frequent(docs)
    sets = jaccard.describe(docs, order).withColumnRenamed("doc_id", "node").cache()
    counts = jaccard.entries(sets).groupBy("col").count().withColumnRenamed("count", "rows").where("rows > 1")
    cells, rows = jaccard.dealt(sets, counts), sets.selectExpr("node", "n", "bits", "node as root")
    distinct = {tuple(r) for r in jaccard.candidates(cells, rows, False).collect()}
    monkeypatch.setattr(type(docs), "distinct", lambda df: df)  # all rows that the comparison makes
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # cells stay in several tasks
    try:
        made = [tuple(r) for r in jaccard.candidates(cells, rows, False).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert distinct and set(made) == distinct and len(made) <= 1.2 * len(distinct)
    sets_of = [slow_set(t) for t in texts]
    linked = {(a, b) for b in range(len(texts)) for a in range(b) if 190 * len(sets_of[a] & sets_of[b]) >= 90 * (
        len(sets_of[a]) + len(sets_of[b]))}
    assert linked <= distinct


def test_groups_around_the_bound(spark):
    """Long texts of groups of all sizes, each pair near the bound; both passes find links."""
    chance, texts = random.Random(13), []
    for size in (2, 3, 7, 8, 9, 10, 17, 40):
        texts += near_misses(chance, 1, size, 100 + 20 * size, range(1, 4 + size // 4))
    chance.shuffle(texts)
    check(spark, texts)
    check(spark, texts, percent=80)


def test_frequent_columns_come_last(spark):
    """Rare columns come first, so that no cell holds all rows of a passage."""
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [f"{passage} " + " ".join(f"r{i}x{j}" for j in range(60)) for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    order = jaccard.frequent(docs)
    before, after = (jaccard.describe(docs, o).withColumnRenamed("doc_id", "node") for o in (jaccard.Order(), order))
    most = [jaccard.entries(x).groupBy("col").count().agg({"count": "max"}).first()[0] for x in (before, after)]
    assert most[0] == 300 and most[1] < 30 and len(order.listed)
    assert [r.prefix for r in before.collect()] != [r.prefix for r in after.collect()]
    # a bounded table gives another order only
    assert len(jaccard.frequent(docs, limit=3).listed) == 3


def test_edge_cases(spark, make_docs):
    long = "quite another text " * 30_000
    docs = make_docs((5, None), (4, ""), (3, " \n"), (None, "one two three"), (9, "One two\tTHREE"), (7, "one two three"),
                     (7, "one two three"), (None, "alone here"), (11, "a b"), (10, "a B"), (12, "a b c"), (13, long), (14, long + "end"))
    found = sorted(map(tuple, jaccard.join(docs).collect()), key=str)
    assert found == sorted([
        (5, 0, 5), (4, 0, 4), (3, 0, 3), (None, 1, 7), (9, 1, 7), (7, 1, 7), (7, 1, 7), (None, 1, None), (11, 1, 10),
        (10, 1, 10), (12, 1, 12), (13, 3, 13), (14, 4, 14)], key=str)
    assert jaccard.join(docs.limit(0)).count() == 0
    assert jaccard.join(docs.where("text is null")).count() == 1


@pytest.mark.parametrize("hot", [2, 4096])
def test_split_cells_meet_all_pairs(spark, hot):
    sets = spark.createDataFrame([(i, np.array([42], np.int64).tobytes()) for i in range(9)], "node long, prefix binary")
    counts = spark.createDataFrame([(42, 9)], "col long, rows long")
    cells = {}
    for r in jaccard.dealt(sets, counts, hot).collect():
        cells.setdefault(r.cell, set()).add(r.node)
    pairs = {(a, b) for nodes in cells.values() for a in nodes for b in nodes if a < b}
    assert len(pairs) == 36
