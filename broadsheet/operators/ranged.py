"""An index table in term ranges: takes changes of articles, and reads only the ranges of its keywords.

A table is a folder with a manifest and data folders. The manifest has one row per range of
``(term, part)``: its lowest key, by which every key has exactly one home, and the data folder that
holds it now. A change reads the ranges of the changed terms, merges them into a new data folder and
ends with a manifest of the next number; files of all other ranges stay as they are. Readers take
the newest manifest, so they see a change wholly or not at all, and of two writers of one version the
second fails. Replaced data folders stay for readers of older manifests.

The parts of a frequent term may lie in several ranges. Lists are merged by term with hashed parts,
like new ones, so no list is gathered in one task. The driver holds the manifest alone: one key and
one path per range, less than the file listing of any scan.

The keywords of an article depend on the article and the IDF table only, so with a fixed IDF table
the changed table equals one that is built anew.
"""

from __future__ import annotations

import uuid
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import broadcast_within, written
from .index import INDEX_KEYWORDS, URLS_PER_LIST, index_postings, posting_lists
from .lookup import BROADCAST_BYTES, BROADCAST_ROWS

LISTS = "term string, part int, urls array<string>"
MANIFEST = "range int, low_term string, low_part int, folder string"
LAST_PART = (1 << 31) - 1


def _write_ranges(lists: DataFrame, path: str) -> str:
    """Rows with their ``range`` as a new data folder; a large range becomes several files."""
    folder = f"{path.rstrip('/')}/data-{uuid.uuid4().hex}"
    lists.sortWithinPartitions("range", "term", "part").write.partitionBy("range").parquet(folder)
    return folder


def _write_manifest(spark: SparkSession, path: str, version: int, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.parquet(
        f"{path.rstrip('/')}/manifest/version={version}")


def create(index: DataFrame, path: str) -> None:
    """Write posting lists ``(term, part, urls)`` as version 0 of a new table.

    An empty index is one range without a folder.
    """
    spark = index.sparkSession
    ranged = index.select("term", "part", "urls").repartitionByRange("term", "part")
    folder = _write_ranges(ranged.withColumn("range", F.spark_partition_id()), path)
    low = F.min(F.struct("term", "part")).alias("low")
    lows = spark.read.schema(f"{LISTS}, range int").parquet(folder).groupBy("range").agg(low)
    rows = [tuple(r) for r in lows.select("range", "low.term", "low.part").collect()]
    _write_manifest(spark, path, 0, [(*r, folder) for r in rows] or [(0, "", 0, None)])


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The newest manifest: ``range, low_term, low_part, folder, version``; an emptied range has no folder."""
    every = spark.read.schema(f"{MANIFEST}, version int").parquet(f"{path.rstrip('/')}/manifest")
    return every.filter(F.col("version") == every.agg(F.max("version")).first()[0])


class _Ranges:
    """Where keys live: the ranges of a manifest by their lowest keys, compared as UTF-8 bytes."""

    def __init__(self, rows: list) -> None:
        rows = sorted(rows, key=lambda r: (r.low_term.encode(), r.low_part))
        self.lows = [(r.low_term.encode(), r.low_part) for r in rows]
        self.numbers = [r.range for r in rows]
        self.folders = {r.range: r.folder for r in rows}

    def place(self, term: str, part: int) -> int:
        return max(bisect_right(self.lows, (term.encode(), part)) - 1, 0)

    def home(self, term: str, part: int) -> int:
        return self.numbers[self.place(term, part)]

    def of_term(self, term: str) -> list[int]:
        """All ranges that may hold parts of a term; before the first key there is the first range."""
        return self.numbers[self.place(term, 0): self.place(term, LAST_PART) + 1]


def _frame(spark: SparkSession, ranges: _Ranges, wanted) -> DataFrame:
    """Rows of the wanted ranges, with their ``range``."""
    paths = [f"{ranges.folders[n]}/range={n}" for n in sorted(wanted) if ranges.folders[n]]
    if not paths:
        return spark.createDataFrame([], f"{LISTS}, range int")
    number = F.regexp_extract("_metadata.file_path", r".*/range=(\d+)/", 1).cast("int")
    return spark.read.schema(LISTS).parquet(*paths).withColumn("range", number)


def read(spark: SparkSession, path: str, keywords: DataFrame | None = None) -> DataFrame:
    """Posting lists of the table, or of the ranges alone that may hold one of ``keywords(keyword)``.

    Keywords within the bound of a broadcast choose the files before the scan is planned; beyond it
    all are read.
    """
    ranges = _Ranges(manifest(spark, path).collect())
    wanted = set(ranges.numbers)
    if keywords is not None:
        asked = written(keywords.select("keyword").filter(F.col("keyword") != "").distinct(), "keywords")
        if broadcast_within(asked, BROADCAST_ROWS, BROADCAST_BYTES, "keyword") is not None:
            wanted = {n for (k,) in asked.collect() for n in ranges.of_term(k)}
    return _frame(spark, ranges, wanted).drop("range")


def posting_changes(
    before: DataFrame, after: DataFrame, idf: DataFrame, k: int = INDEX_KEYWORDS
) -> DataFrame:
    """``(term, url, added)`` between two states of the touched articles only.

    ``before`` holds all rows of changed and deleted urls, ``after`` those of new and changed ones.
    Postings that both have are no change.
    """
    old = index_postings(before, idf, k).withColumn("added", F.lit(False))
    new = index_postings(after, idf, k).withColumn("added", F.lit(True))
    states = old.unionByName(new).groupBy("term", "url").agg(
        F.count(F.lit(1)).alias("n"), F.max("added").alias("added"))
    return states.filter(F.col("n") == 1).select("term", "url", "added")


def apply(spark: SparkSession, path: str, changes: DataFrame, max_urls: int = URLS_PER_LIST) -> list[int]:
    """Merge ``changes(term, url, added)`` into the table; returns the ranges that were written anew.

    A posting whose change is not ``added`` is taken out, one that is there already or not there any
    more is no error: applying a change twice gives the same table.
    """
    entries = manifest(spark, path).collect()
    changes = written(changes.select("term", "url", "added"), "changes")
    terms = changes.select("term").distinct()
    ranges, version = _Ranges(entries), entries[0].version
    shared = spark.sparkContext.broadcast(ranges)

    @F.arrow_udf("array<int>")
    def of_term(term: pa.Array) -> pa.Array:
        return pa.array([shared.value.of_term(t) for t in term.to_pylist()], pa.list_(pa.int32()))

    @F.arrow_udf("int")
    def home(term: pa.Array, part: pa.Array) -> pa.Array:
        return pa.array(map(shared.value.home, term.to_pylist(), part.to_pylist()), pa.int32())

    touched = {r[0] for r in terms.select(F.explode(of_term("term"))).distinct().collect()}
    if not touched:
        return []
    old = _frame(spark, ranges, touched)
    kept = old.join(terms, "term", "left_anti")
    listed = old.join(terms, "term", "left_semi").select(
        "term", F.explode("urls").alias("url"), F.lit(None).cast("boolean").alias("added"))
    postings = listed.unionByName(changes).groupBy("term", "url").agg(F.max("added").alias("added"))
    lists = posting_lists(postings.filter(F.coalesce("added", F.lit(True))).select("term", "url"), max_urls)
    merged = kept.unionByName(lists.withColumn("range", home("term", "part")))
    folder = _write_ranges(merged.repartitionByRange("range", "term", "part"), path)
    filled = spark.read.schema(f"{LISTS}, range int").parquet(folder).select("range").distinct()
    filled = {r[0] for r in filled.collect()}
    rows = []
    for number, (term, part) in zip(ranges.numbers, ranges.lows):
        now = ranges.folders[number] if number not in touched else folder if number in filled else None
        rows.append((number, term.decode(), part, now))
    _write_manifest(spark, path, version + 1, rows)
    return sorted(touched)
