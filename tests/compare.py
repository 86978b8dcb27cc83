"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def normal(frame):
    """Columns by name, rows by value."""
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns), ignore_index=True)


def difference(spark_frame, sql_frame) -> str | None:
    a, b = normal(spark_frame.toPandas()), normal(sql_frame)
    if list(a.columns) != list(b.columns):
        return f"columns {list(a.columns)} against {list(b.columns)}"
    if [str(t) for t in a.dtypes] != [str(t) for t in b.dtypes]:
        kinds = [(c, str(x), str(y)) for c, x, y in zip(a.columns, a.dtypes, b.dtypes) if str(x) != str(y)]
        if any({x, y} - {"object", "str", "string"} and not x.startswith("datetime") for _, x, y in kinds):
            return f"types {kinds}"
    if len(a) != len(b):
        return f"{len(a)} rows against {len(b)}"
    for c in a.columns:
        x, y = a[c].tolist(), b[c].tolist()
        bad = [i for i, (u, v) in enumerate(zip(x, y)) if u != v and not (u != u and v != v)]
        if bad:
            i = bad[0]
            return f"column {c}: {len(bad)} differ, first {x[i]!r} against {y[i]!r}"
    return None
