"""Every registered query agrees with its DuckDB specification (sf0.001):
same column names and types, same rows."""

import os

import duckdb
import pytest

from conftest import SF0001
from stockpilot import registry
from stockpilot.oracle.compare import TABLES, diff, duckdb_rows

SQL = registry.oracle_sql()
DUCK_TYPES = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "DATE": "date", "VARCHAR": "string", "BOOLEAN": "boolean"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF0001}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def test_every_query_has_an_oracle():
    assert set(SQL) == set(registry.queries())


@pytest.mark.parametrize("key", sorted(registry.ENTRIES))
def test_query_matches_oracle(spark, duck, key):
    df = registry.ENTRIES[key].query(spark, SF0001)
    rel = duck.sql(SQL[key])
    assert {f.name: f.dataType.simpleString() for f in df.schema.fields} == {
        n: DUCK_TYPES.get(str(t), str(t)) for n, t in zip(rel.columns, rel.types)
    }
    rows = [tuple(r) for r in df.collect()]
    cols, expected = duckdb_rows(SQL[key], SF0001)
    assert diff(df.columns, rows, cols, expected) is None
