"""Article tables and their cell form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.html import ARTICLE_RULE, BodyRule, article_body, page_title
from ..session import written

CELL_SCHEMA = (
    "row string, columnFamily string, qualifier string, timestamp string, type string, value string"
)


def scan_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def articles_from_pages(pages: DataFrame, rule: BodyRule = ARTICLE_RULE) -> DataFrame:
    """Fetched pages to articles ``(url, title, content)``, keyed by ``url``."""
    return pages.select(
        "url", page_title("html").alias("title"), article_body("html", rule).alias("content")
    )


def to_cells(
    articles: DataFrame,
    key: str = "url",
    columns: Sequence[str] = ("title", "content"),
    family: str = "f",
    timestamp: Column | None = None,
) -> DataFrame:
    """Wide rows to one row per cell ``(row, columnFamily, qualifier, timestamp, type, value)``."""
    timestamp = F.lit(0) if timestamp is None else timestamp
    stamped = articles.withColumn("__ts", timestamp.cast("bigint"))
    return stamped.unpivot([key, "__ts"], list(columns), "qualifier", "value").select(
        F.col(key).alias("row"),
        F.lit(family).alias("columnFamily"),
        "qualifier",
        F.col("__ts").alias("timestamp"),
        F.lit("Put").alias("type"),
        "value",
    )


def from_cells(
    cells: DataFrame, qualifiers: Sequence[str] = ("title", "content"), key: str = "url"
) -> DataFrame:
    """Cells back to one wide row per key; of several values of a cell the newest counts.

    Of values with equal times the cell written later wins; a cell without a time is never the newest.
    Cells are written once, with their place. Only keys, times and places are grouped, and each task
    first reduces its cells to one row per key. Values are then fetched by place, one column after the
    other: they stream past a hash table of the keys and the columns already there, one partition of
    them at a time, so no value is sorted. Name the column of the longest values last. A key without
    a value gets a place below zero of its own, so such keys don't meet in one task.
    """
    placed = written(
        cells.select("row", "qualifier", "timestamp", "value").withColumn(
            "__place", F.monotonically_increasing_id()), "cells")
    newest = [
        F.max(F.when(
            (F.col("qualifier") == q) & F.col("timestamp").isNotNull(), F.struct("timestamp", "__place")
        ))["__place"].alias(f"__place{i}")
        for i, q in enumerate(qualifiers)
    ]
    nowhere = -1 - F.pmod(F.xxhash64(key), F.lit(1 << 40))
    wide = placed.groupBy(F.col("row").alias(key)).agg(*newest)
    for i, q in enumerate(qualifiers):
        place = f"__place{i}"
        values = placed.where(F.col("qualifier") == q).select(
            F.col("__place").alias(place), F.col("value").alias(q))
        wide = wide.withColumn(place, F.coalesce(place, nowhere)).hint("shuffle_hash").join(
            values, place, "left")
    return wide.select(key, *qualifiers)


def rows_to_json(
    articles: DataFrame,
    key: str = "url",
    columns: Sequence[str] = ("title", "content"),
    family: str = "f",
    timestamp: Column | None = None,
) -> DataFrame:
    """One scan record per wide row: ``(row, blob)`` with one JSON cell per line, inside the row."""
    timestamp = F.lit(0) if timestamp is None else timestamp

    def line(column: str) -> Column:
        return F.when(F.col(column).isNotNull(), F.to_json(F.struct(
            F.col(key).alias("row"),
            F.lit(family).alias("columnFamily"),
            F.lit(column).alias("qualifier"),
            timestamp.cast("string").alias("timestamp"),
            F.lit("Put").alias("type"),
            F.col(column).alias("value"),
        )))

    lines = F.array_compact(F.array(*(line(c) for c in columns)))
    return articles.select(F.col(key).alias("row"), F.array_join(lines, "\n").alias("blob"))


def cells_from_json(blobs: DataFrame) -> DataFrame:
    """Explode the lines of each blob and parse them; the stored time is text and becomes long."""
    lines = blobs.select(F.explode(F.split("blob", "\n")).alias("line"))
    cell = F.from_json("line", CELL_SCHEMA)
    return lines.select(cell.alias("cell")).select("cell.*").withColumn(
        "timestamp", F.col("timestamp").cast("bigint")
    )
