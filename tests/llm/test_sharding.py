import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from broadsheet.llm import sharding
from broadsheet.llm.queries import QUERIES


def test_tree_finds_the_tightest():
    chance, room, keys = random.Random(5), sharding.Room(), set()
    for n in range(3000):
        if keys and chance.random() < 0.4:
            key = chance.choice(sorted(keys))
            keys.discard(key)
            room.remove(key)
        else:
            key = (chance.randrange(100), n)
            keys.add(key)
            room.add(key)
        size = chance.randrange(110)
        assert room.tightest(size) == min((k for k in keys if k[0] >= size), default=None)
    assert room.root.height < 20


def test_best_fit_equals_a_plain_search():
    chance = random.Random(6)
    for _ in range(50):
        sizes = sorted((chance.randint(1, 50) for _ in range(200)), reverse=True)
        room, expected = [], []
        for s in sizes:
            fits = [(r, k) for k, r in enumerate(room) if r >= s]
            k = min(fits)[1] if fits else len(room)
            if not fits:
                room.append(60)
            room[k] -= s
            expected.append(k)
        assert sharding.best_fit(sizes, 60) == expected


def check(rows, count):
    groups, slots, sizes = defaultdict(set), defaultdict(list), defaultdict(int)
    for r in rows:
        groups[r.text_crc32, r.size].add(r.shard)
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(len(s) == 1 for s in groups.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(count))
    return sizes


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op1_sharding"](spark, folder).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
    sizes = check(rows, 40)
    assert len(sizes) == 40 and max(sizes.values()) < 1.02 * min(sizes.values())


def test_a_group_beyond_its_share_is_alone(spark):
    rows = [(0, "same")] * 500 + [(i, f"t{i}") for i in range(1, 500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text_crc32", F.crc32(F.col("text").cast("binary")))
    placed = sharding.shard(docs, F.col("text"), F.lit(10), count=5)
    sizes = check(placed.select("row.*", "size", "shard", "slot").collect(), 5)
    assert sorted(sizes.values())[-1] == 5000 and max(sorted(sizes.values())[:4]) - min(sizes.values()) <= 10


def test_fixed_capacity_and_edge_cases(spark, make_docs):
    docs = make_docs((1, None), (2, ""), (None, "x"), (3, "long " * 10_000), (3, "long " * 10_000), *((i, f"t{i}") for i in range(10, 60)))
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 16
    rows = sharding.shard(docs, F.coalesce("text", F.lit("")), size, capacity=200).select("row.doc_id", "size", "shard", "slot").collect()
    assert len(rows) == 55
    load = defaultdict(int)
    for r in rows:
        load[r.shard] += r.size
    assert sorted(load.values())[-1] == 2 * 50_016 and sorted(load.values())[-2] <= 200
    assert len({r.shard for r in rows if r.doc_id in (1, 2)}) == 1
    assert sharding.shard(docs.limit(0), F.col("text"), size, count=4).count() == 0
