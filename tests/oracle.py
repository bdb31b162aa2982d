"""Compare a Spark result with DuckDB on the same tables."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os

import duckdb


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def _rows(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None."""
    got = spark_df.collect()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(spark_df.columns) != sorted(names):
        return f"columns {sorted(spark_df.columns)} against {sorted(names)}"
    kinds = {d[0]: str(d[1]) for d in cur.description}
    huge = [n for n, k in kinds.items() if "HUGE" in k or "DECIMAL" in k]
    if huge:
        return f"oracle types {huge}"
    if len(got) != len(want):
        return f"rows {len(got)} against {len(want)}"
    if not got:
        return "no rows"
    a, b = _rows(spark_df.columns, [tuple(r) for r in got]), _rows(names, want)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{sorted(names)}: {len(bad)} differ, first {bad[0]}"
    return None
