"""Compare a Spark result with DuckDB on the same parquet tables."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = ["region", "nation", "customer", "orders", "lineitem"]


def connect(folder: str, files: str = "") -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet") + files
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(columns, rows) -> list[tuple]:
    """Rows with columns by name, floats by exact value, in a fixed order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v + 0.0)
        return repr(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """What differs, or None."""
    result = con.execute(sql)
    theirs_columns = [d[0] for d in result.description]
    theirs = result.fetchall()
    ours = [tuple(r) for r in spark_df.collect()]
    if sorted(spark_df.columns) != sorted(theirs_columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(theirs_columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    a, b = canonical(spark_df.columns, ours), canonical(theirs_columns, theirs)
    for x, y in zip(a, b):
        if x != y:
            return f"{x} != {y}"
    return None
