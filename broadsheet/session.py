"""Session helpers: shared working folder, lineage cuts, checked broadcasts, small-input spreading."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own; on a cluster a
    machine-local folder would be lost with its machine, so the setting is required there.
    """
    sc = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if folder is None:
        if not re.fullmatch(r"local(\[[^\[\]]*\])?", sc.master):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="broadsheet-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write the frame once to reliable storage and read it from there: a lost executor costs a
    re-read, not a re-run, and the frame is computed only once however often it is used."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Like ``materialise`` for large frames: a Parquet table in the shared folder."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def once(function):
    """A Python function whose column is computed once: Spark infers a filter from an exploded array and would
    push it, with a second call of the function, below the shuffle that spreads the rows."""
    return function.asNondeterministic()


def broadcast_within(df: DataFrame, max_rows: int, max_bytes: int, size_of) -> DataFrame | None:
    """``df`` with a broadcast hint if it is inside both bounds, else ``None``.

    ``df`` should be materialised: the check runs a count. ``size_of`` is the column whose UTF-8
    bytes dominate a row.
    """
    rows, size = df.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(size_of)), F.lit(0))).first()
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else None


def spread(df: DataFrame, key: str, small_bytes: int = 1 << 30) -> DataFrame:
    """Hash a small input over all cores by its unique key.

    A small file is often a single row group, which one task would read and process alone. Inputs
    above ``small_bytes`` already come as many splits and are left as they are: hashing them would
    only ship the whole corpus over the network.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size > small_bytes:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, key)
