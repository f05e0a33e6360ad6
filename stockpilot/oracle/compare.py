"""Run an oracle query in DuckDB and compare it with a Spark result.

Comparison is order-insensitive: columns are matched by name, rows as a
multiset of normalised tuples (dates as ISO text, floats to 9 places)."""

from __future__ import annotations

import datetime as dt
from collections import Counter

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def duckdb_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    import os

    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir.rstrip('/')}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def _norm(v: object) -> object:
    if isinstance(v, float):
        return round(v, 9) + 0.0
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    if hasattr(v, "__int__") and type(v).__name__ == "Decimal":
        return float(v)
    return v


def canonical(cols: list[str], rows: list[tuple]) -> tuple[list[str], Counter]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def diff(spark_cols: list[str], spark_rows: list[tuple], duck_cols: list[str], duck_rows: list[tuple]) -> str | None:
    """None when equal, else a short description of the difference."""
    sc, s = canonical(spark_cols, spark_rows)
    dc, d = canonical(duck_cols, duck_rows)
    if sc != dc:
        return f"columns differ: spark {sc} vs oracle {dc}"
    if s != d:
        only_s, only_d = s - d, d - s
        return (
            f"rows differ: spark {sum(s.values())} vs oracle {sum(d.values())}; "
            f"spark-only e.g. {list(only_s)[:2]}; oracle-only e.g. {list(only_d)[:2]}"
        )
    return None
