"""Keyed tables: upsert, version retention, deletes, multi-get and the index table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import broadcast_within, written

# Places of winning rows are broadcast within both bounds and joined by shuffle beyond.
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 16 << 20


def upsert_latest(
    base: DataFrame, updates: DataFrame, key: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Base and updates merged by key; the row with the greatest ``order`` columns wins.

    Of rows with equal ``order`` the one written later wins: updates before base, then the later row.
    Rows are written once, with their place. Only key, order and place are grouped, and each task
    first reduces its rows to one per key, so a key with very many writes is harmless. The winners
    are then fetched by place: no value is sorted or aggregated, and within the bound none is shuffled.
    """
    both = written(
        base.unionByName(updates).withColumn("__place", F.monotonically_increasing_id()), "writes")
    newest = F.max(F.struct(*order, "__place"))["__place"].alias("__place")
    winners = written(both.groupBy(*key).agg(newest).select("__place"), "winners")
    few = broadcast_within(winners, BROADCAST_ROWS, BROADCAST_BYTES, F.lit("12345678"))
    winners = winners.hint("shuffle_hash") if few is None else few
    return both.join(winners, "__place", "left_semi").select(*base.columns)


def put_records(spark: SparkSession, rows: Sequence[Sequence[str]], timestamp: int) -> DataFrame:
    """Cells of a few ``[row, family, qualifier, value]`` records, ready for ``upsert_latest``."""
    cells = spark.createDataFrame(
        [tuple(r) for r in rows],
        "row string, columnFamily string, qualifier string, value string",
    )
    return cells.select(
        "row", "columnFamily", "qualifier", F.lit(timestamp).cast("bigint").alias("timestamp"),
        F.lit("Put").alias("type"), "value",
    )


def keep_versions(
    cells: DataFrame, key: Sequence[str], order: Sequence[str], versions: int = 3
) -> DataFrame:
    """The newest ``versions`` rows per key, numbered in ``version`` from 1.

    Spark cuts every partition to that many rows per key before the shuffle.
    """
    newest_first = Window.partitionBy(*key).orderBy(*(F.desc(c) for c in order))
    return cells.withColumn("version", F.row_number().over(newest_first)).filter(
        F.col("version") <= versions
    )


def get_rows(table: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Multi-get: the rows whose key is listed."""
    return table.join(keys.select(on), on, "left_semi")


def scan_prefix(table: DataFrame, column: str, prefix: str) -> DataFrame:
    """Prefix scan; a literal prefix is pushed to the Parquet reader."""
    return table.filter(F.col(column).startswith(prefix))


def delete_rows(table: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """The table without the listed keys."""
    return table.join(keys.select(on), on, "left_anti")


def write_index(index: DataFrame, path: str) -> None:
    """Posting lists as Parquet in ranges of ``(term, part)``.

    Files and row groups cover disjoint term ranges, so an exact or a prefix lookup reads only the
    matching ones, and the parts of a frequent term spread over files.
    """
    index.repartitionByRange("term", "part").sortWithinPartitions("term", "part").write.mode(
        "overwrite"
    ).parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def pipe_joined(index: DataFrame) -> DataFrame:
    """Compatible form ``(term, part, index)`` with the list joined by ``|``."""
    return index.select("term", "part", F.array_join("urls", "|").alias("index"))
