"""The index table in ranges: changes against a rebuilt index, untouched files, files read."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from broadsheet.operators import index, lookup, ranged

LISTS = "term string, part int, urls array<string>"
CHANGES = "term string, url string, added boolean"


def lists_of(df):
    return sorted((r.term, r.part, tuple(r.urls)) for r in df.collect())


def postings_of(df):
    return {(r.term, u) for r in df.collect() for u in r.urls}


def made(spark, path, postings, max_urls=100_000, ranges=6):
    """A table of exactly so many ranges; adaptive execution would join small ones."""
    frame = spark.createDataFrame(sorted(postings) or [], "term string, url string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    try:
        ranged.create(index.posting_lists(frame, max_urls), path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", before)


def data_files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/data-*/range=*/*.parquet")}


@pytest.mark.parametrize("max_urls", [3, 100_000])
def test_changes_equal_a_rebuilt_index(spark, tmp_path, max_urls):
    chance = random.Random(max_urls)
    terms = [f"t{k:02d}" for k in range(40)] + ["é", "漢字", "𝒳", "￿"]
    urls = [f"u{k}" for k in range(30)]
    state = {(t, u) for t in terms[5:] for u in chance.sample(urls, chance.randrange(1, 12))}
    state |= {("t20", u) for u in urls}
    path = str(tmp_path / "table")
    made(spark, path, state, max_urls)
    for version in range(1, 4):
        gone = set(chance.sample(sorted(state), 25)) | {p for p in state if p[0] == "t07"}
        new = {(chance.choice(terms), chance.choice(urls)) for _ in range(25)} - gone
        rows = [(*p, False) for p in gone] + [(*p, True) for p in new] + [("unknown", "u1", False)]
        changes = spark.createDataFrame(rows, CHANGES)
        state = (state - gone) | new
        for _ in range(2 if version == 1 else 1):  # twice is the same as once
            ranged.apply(spark, path, changes, max_urls)
        whole = index.posting_lists(spark.createDataFrame(sorted(state), "term string, url string"), max_urls)
        assert lists_of(ranged.read(spark, path)) == lists_of(whole)
    asked = spark.createDataFrame([("t20",), ("é",), ("",), ("none",)], "keyword string")
    found = lookup.lookup_terms(ranged.read(spark, path, asked), asked)
    assert {(r.keyword, u) for r in found.collect() for u in r.urls} == {p for p in state if p[0] in ("t20", "é")}


def test_only_touched_ranges_are_written(spark, tmp_path):
    path = str(tmp_path / "table")
    made(spark, path, {(f"t{k:03d}", f"u{j}") for k in range(60) for j in range(3)})
    first, entries = data_files(path), {r.range: r.folder for r in ranged.manifest(spark, path).collect()}
    assert len(entries) == 6
    touched = ranged.apply(spark, path, spark.createDataFrame([("t000", "u9", True), ("t0005", "u1", True)], CHANGES))
    assert len(touched) == 1
    assert {f: t for f, t in data_files(path).items() if f in first} == first
    later = {r.range: r.folder for r in ranged.manifest(spark, path).collect()}
    assert [n for n in entries if later[n] != entries[n]] == touched
    assert len(data_files(path)) == len(first) + 1


def test_files_read_follow_the_keywords(spark, tmp_path):
    path = str(tmp_path / "table")
    made(spark, path, {(f"t{k:03d}", "u") for k in range(60)})

    def read(*words):
        asked = spark.createDataFrame([(w,) for w in words], "keyword string")
        return len(ranged.read(spark, path, asked).inputFiles())

    assert len(ranged.read(spark, path).inputFiles()) == 6
    assert read("t000") == 1 and read("t000", "t001") == 1 and read("t000", "t059") == 2
    assert read("", "") == 0


def test_parts_of_one_term_in_several_ranges(spark, tmp_path):
    path, urls = str(tmp_path / "table"), [f"u{k}" for k in range(200)]
    state = {("hot", u) for u in urls} | {("a", "u1"), ("z", "u1")}
    made(spark, path, state, max_urls=10)
    changes = spark.createDataFrame([("hot", "new", True), ("hot", "u7", False)], CHANGES)
    assert len(ranged.apply(spark, path, changes, 10)) > 1
    found = ranged.read(spark, path)
    assert postings_of(found) == state - {("hot", "u7")} | {("hot", "new")}
    assert found.filter(F.size("urls") > 30).isEmpty()


def test_empty_tables_and_changes(spark, tmp_path):
    path = str(tmp_path / "table")
    made(spark, path, set())
    none = spark.createDataFrame([], CHANGES)
    asked = spark.createDataFrame([("a",)], "keyword string")
    assert ranged.read(spark, path).isEmpty() and ranged.read(spark, path, asked).isEmpty()
    assert ranged.apply(spark, path, none) == []
    ranged.apply(spark, path, spark.createDataFrame([("b", "u", True), ("a", "u", True), ("c", "u", False)], CHANGES))
    assert postings_of(ranged.read(spark, path)) == {("a", "u"), ("b", "u")}
    ranged.apply(spark, path, spark.createDataFrame([("b", "u", False), ("a", "u", False)], CHANGES))
    assert ranged.read(spark, path).isEmpty() and ranged.read(spark, path, asked).isEmpty()
    assert ranged.manifest(spark, path).filter("folder is not null").isEmpty()


def test_changes_of_articles(spark, tmp_path):
    schema = "url string, title string, content string"
    before = [("u1", "cat sat", "dog dog cat"), ("u2", "birds flying", None), ("u3", "same words", "same")]
    after = [("u1", "cat stood", "dog dog cow"), ("u3", "same words", "same"), ("u4", "elephant", "cat")]
    idf = spark.createDataFrame([("cat", 2.0), ("dog", 1.0), ("cow", 3.0)], "term string, idf double")
    path, old, new = str(tmp_path / "table"), spark.createDataFrame(before, schema), spark.createDataFrame(after, schema)
    ranged.create(index.full_index(old, idf), path)
    touched = F.col("url") != "u3"
    changes = ranged.posting_changes(old.filter(touched), new.filter(touched), idf)
    assert changes.filter("term = 'cat' and url = 'u1'").isEmpty()
    ranged.apply(spark, path, changes)
    assert lists_of(ranged.read(spark, path)) == lists_of(index.full_index(new, idf))
