"""Duplicate checks by digest, and on-hand rows counted before the order join."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from stockpilot import registry
from stockpilot.operators import positions, quality
from stockpilot.plans.materialize import materialize

ROWS = [
    (1, None, "a", 1.0),
    (None, 1, "a", 1.0),  # the same values, NULL elsewhere
    (1, 1, "a", float("nan")),
    (1, 1, "a", float("nan")),
    (2, 2, "", 0.0),
    (2, 2, "", -0.0),
    (2, 2, None, 0.0),
    (3, 3, "x", None),
    (3, 3, "x", None),
    (3, 3, "x", None),
]
SCHEMA = "a int, b int, c string, d double"


def test_duplicates_are_told_by_values(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    found = Counter((r.a, r.b, r.c, str(r.d), r.extra_copies) for r in quality.duplicate_rows(df).collect())
    assert found == Counter([(1, 1, "a", "nan", 1), (2, 2, "", "0.0", 1), (3, 3, "x", "None", 2)])
    assert tuple(quality.duplicate_summary(df).first()) == (3, 4)
    written = materialize(quality.repeated_digests(df), "digests")
    assert quality.duplicate_rows(df, written).count() == 3
    with pytest.raises(quality.DuplicateRowsError):
        quality.assert_no_duplicates(df)


def test_equal_digests_of_different_rows_are_no_duplicates(spark, monkeypatch):
    def coarse(df):
        return df.withColumns({c: F.lit(7).cast("bigint") for c in quality.DIGEST})

    monkeypatch.setattr(quality, "with_digest", coarse)
    df = spark.createDataFrame([(1, "a"), (2, "a"), (2, "a")], "k int, v string")
    assert [tuple(r) for r in quality.duplicate_rows(df).collect()] == [(2, "a", 1)]
    quality.assert_no_duplicates(df.where("k = 1"))


def test_no_rows_and_sound_rows(spark):
    df = spark.createDataFrame(ROWS[:2], SCHEMA)
    quality.assert_no_duplicates(df)
    assert tuple(quality.duplicate_summary(df.limit(0)).first()) == (0, 0)


def test_repeated_onhand_rows_are_combined_before_the_join(spark):
    """A SKU and store with most on-hand rows: one row is left, and nothing changes."""
    st = registry.stages(spark, SF0001)
    hot = st.inventory.where("store_oh is not null").orderBy("parent_sku", "store").limit(1)
    onhand = st.inventory.unionByName(hot.crossJoin(spark.range(500)).drop("id"))

    def made(rows):
        joined = positions.position_rows(rows, st.store_orders, st.expanded, positions.STORE, st.quirks)
        return Counter(tuple(r) for r in positions.per_position(joined, st.expanded, positions.STORE).collect())

    counted = positions.counted_onhand(onhand, positions.STORE)
    assert counted.agg(F.max("onhand_rows")).first()[0] >= 500
    assert counted.count() <= st.inventory.count()
    assert made(counted) == made(onhand)


def test_sku_columns_are_not_shuffled_with_the_orders(spark):
    """Neither the order join nor the aggregate over it carries style, color or a second SKU."""
    st = registry.stages(spark, SF0001)
    for grain, rows in ((positions.WAREHOUSE, st.warehouse_rows), (positions.STORE, st.store_rows)):
        assert not set(positions.SKU_COLUMNS) & set(rows.columns)
        made = positions.per_position(rows, st.expanded, grain)
        assert made.columns[: len(grain.columns)] == list(grain.columns)
