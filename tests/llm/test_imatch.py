import hashlib
import re
import statistics

from pyspark.sql import functions as F

from broadsheet.llm import imatch
from broadsheet.llm.queries import QUERIES


def terms(text):
    return {w for w in re.split(r"[^\w]|_", (text or "").lower()) if w}


def edited(text, following):
    n = len(text)
    return text[: n - n // 4] + following[: n // 4]


def hashes(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "w string")
    return {r.w: r.h for r in df.select("w", F.xxhash64("w").alias("h")).collect()}


def slow_sets(own, known, band):
    """The sets behind the components, from the definition."""
    found = []
    numbers = {known[t] & (1 << 64) - 1: known[t] for t in own}
    for level, (size, used) in enumerate(imatch.LEVELS):
        for part in range(used):
            found.append(frozenset(v for u, v in numbers.items() if v in band and (u >> (12 * level + 4)) % size == part))
    whole = frozenset(numbers.values()) if not any(found) else None
    return [whole, *(s or None for s in found)]


def slow_likeness(a, b):
    used = [(x, y) for x, y in zip(a, b) if x is not None or y is not None]
    return sum(x == y for x, y in used) / len(used) if used else 1.0


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = sorted(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    texts = [r.text for r in rows]
    after = texts[1:] + texts[:1]
    changed = [edited(a, b) for a, b in zip(texts, after)]
    known = hashes(spark, set().union(*map(terms, texts + changed)))
    count = {}
    for t in texts:
        for w in terms(t):
            count[known[w]] = count.get(known[w], 0) + 1
    n = len(texts)
    band = {v for v, c in count.items() if max(2, imatch.LOW * n) <= c <= imatch.HIGH * n}
    sets = [slow_sets(terms(t), known, band) for t in texts]
    changed_sets = [slow_sets(terms(t), known, band) for t in changed]
    found = {r.doc_id: r for r in QUERIES["op10_imatch"](spark, folder).collect()}
    assert len(found) == n
    for k, row in enumerate(rows):
        r = found[row.doc_id]
        assert r.n_chars == len(texts[k]) and r.edited_sha256 == hashlib.sha256(changed[k].encode()).hexdigest()
        assert abs(r.near_edited - slow_likeness(sets[k], changed_sets[k])) < 1e-9
        assert abs(r.near_next - slow_likeness(sets[k], sets[(k + 1) % n])) < 1e-9
    by_text = {}
    for row in rows:
        assert by_text.setdefault(row.text, found[row.doc_id].fingerprint) == found[row.doc_id].fingerprint


def test_edited_texts_are_likelier_than_the_next(spark):
    rows = QUERIES["op10_imatch"](spark, "/root/testdata/sf0.01").where("n_chars >= 400").collect()
    assert statistics.mean(r.near_edited for r in rows) > 0.25 and statistics.mean(r.near_next for r in rows) < 0.05
    assert sum(r.near_edited > r.near_next for r in rows) > 0.95 * len(rows)


def test_edge_cases(spark, make_docs):
    docs = make_docs((None, "zero"), (1, None), (2, ""), (3, "é💥 b c d e f g h"), (3, "é💥 b c d e f g h"), (5, "last one here " * 60_000))
    rows = imatch.compare_with_next(docs).collect()
    assert len(rows) == 6
    own = {r.doc_id: r for r in rows}
    assert own[5].edited_sha256 == hashlib.sha256(edited("last one here " * 60_000, "zero").encode()).hexdigest()
    assert own[1].near_edited == own[1].near_next == 1.0 and own[None].near_next == 0.0
    assert len({r.fingerprint for r in rows if r.doc_id == 3}) == 1
    assert {r.near_next for r in rows if r.doc_id == 3} == {0.0, 1.0}
    alone = imatch.compare_with_next(docs.where("doc_id = 5")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0
    assert imatch.compare_with_next(docs.limit(0)).count() == 0


def test_lexicon_beyond_the_bound_gives_the_same(spark, make_docs, monkeypatch):
    docs = make_docs(*((i, f"word{i % 7} term{i % 5} thing{i % 3} x{i} and{i % 11} or{i % 13}") for i in range(60)))
    first = sorted(map(tuple, imatch.compare_with_next(docs).collect()))
    monkeypatch.setattr(imatch, "broadcast_within", lambda *a: None)
    assert sorted(map(tuple, imatch.compare_with_next(docs).collect())) == first


def test_no_python_in_the_plan(spark, make_docs):
    plan = imatch.compare_with_next(make_docs((1, "a b"), (2, "c d")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_many_buckets(spark, make_docs):
    """Two buckets a partition: 800 of them, some rows null or twice, find the same next rows as two buckets."""
    rows = [(None, "none a"), (None, None), *((i * 7 % 1000, f"word{i % 9} of row {i * 7 % 1000}") for i in range(1000)), (5, "five")]
    docs, usual = make_docs(*rows, rows[-1]), spark.conf.get("spark.sql.shuffle.partitions")
    found = {}
    try:
        for parts in (1, 400):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            texts = imatch.with_next(docs)
            own = [(r.doc_id, r.text, r.next_text) for r in texts.select("doc_id", "text", "next_text").collect()]
            found[parts] = sorted(own, key=str)
            follows = texts.alias("a").join(texts.alias("b"), (F.col("a.next_bucket") == F.col("b.bucket")) & (F.col("a.next_rank") == F.col("b.rank")))
            assert follows.where(F.col("a.next_text") == F.col("b.text")).count() == len(rows) + 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    assert found[1] == found[400] and len(found[1]) == len(rows) + 1
    plain = dict(rows[2:-1])
    assert all(after == plain[i + 1] for i, _, after in found[400] if i is not None and 5 < i < 999)
