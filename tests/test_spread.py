"""Steps whose tasks need much memory are dealt to all shuffle partitions, however small
their input is when shuffled."""

import datetime as dt
import re
from contextlib import contextmanager
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from stockpilot import registry
from stockpilot.config import Quirks
from stockpilot.operators import aggregates, forecast, positions, replenishment
from stockpilot.operators.joins import without
from stockpilot.sources import extracts, fixtures

DAY = dt.date(1998, 6, 1)


@pytest.fixture
def no_broadcast(spark):
    with _conf(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        yield


@contextmanager
def _conf(spark, key, value):
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _written_by(df, path):
    """How many tasks had rows to write."""
    df.write.parquet(str(path))
    return df.sparkSession.read.parquet(str(path)).select(F.input_file_name()).distinct().count()


def _tables(spark, n=64):
    part = spark.range(n).select(
        F.col("id").alias("p_partkey"), F.lit("PROMO").alias("p_type"), (F.col("id") % 7).cast("int").alias("p_size")
    )
    nation = spark.range(8).select(F.col("id").cast("int").alias("n_nationkey"), (F.col("id") % 2).cast("int").alias("n_regionkey"))
    return part.coalesce(1), nation


def test_parts_are_spread_before_they_are_multiplied(spark, tmp_path):
    part, nation = _tables(spark)
    assert _written_by(fixtures.inventory_view(part, F.broadcast(nation)), tmp_path / "rows") > 2


def test_joined_forecast_rows_are_not_put_into_one_task(spark, no_broadcast, tmp_path):
    rows = spark.range(100).select(F.col("id").alias("baby_sku"), (F.col("id") % 3).alias("store"))
    daily = rows.select(F.col("baby_sku").alias("sku"), "store", F.lit(DAY).alias("cal_date"), F.lit(1.0).alias("forecast"))
    got = forecast.attach_forecast(rows, daily)
    assert got.count() == 100 and _written_by(got, tmp_path / "rows") > 2


def test_orders_joined_row_by_row_are_not_put_into_one_task(spark, no_broadcast, tmp_path):
    onhand = spark.range(100).select(F.col("id").alias("parent_sku"), (F.col("id") % 3).alias("store"))
    orders = onhand.select(F.col("parent_sku").alias("sku"), "store", F.lit(7).alias("ord_units"))
    got = positions.attach_orders(onhand, orders.union(orders), "store")
    assert got.count() == 200 and _written_by(got, tmp_path / "rows") > 2


def test_order_rows_are_not_shuffled_for_the_request(spark, no_broadcast):
    onhand = spark.createDataFrame([(1, 7, 3.5), (1, 7, 3.5), (2, 7, 1.0), (3, 8, None), (None, 7, 1.0)], "parent_sku long, input_source_store int, lt_days double")
    orders = spark.createDataFrame(
        [(1, 7, 5, DAY, None), (1, 7, 6, DAY, DAY), (2, 8, 1, DAY, DAY), (3, None, 1, DAY, DAY), (None, 7, 1, DAY, DAY)],
        "sku long, input_source_store int, ord_units int, first_ship_date date, transit_date date",
    )
    expanded = spark.createDataFrame(
        [("s", "c", 1, 10, DAY, 28), (None, "c", 3, None, None, None), ("s", "d", 4, 40, DAY, 28), ("s", "e", None, 50, DAY, 28)],
        "style string, color string, sku long, item_id long, provided_date date, coverage_day int",
    )
    want = positions.with_sku_attributes(positions.attach_orders(onhand, orders, "input_source_store"), expanded)
    joined = positions.requested_orders(onhand, orders, expanded, "input_source_store")
    assert joined.columns == want.columns and sorted(map(str, joined.collect())) == sorted(map(str, want.collect()))
    got = positions.order_rows(onhand, orders, expanded, positions.WAREHOUSE, Quirks())
    assert got.count() == want.count() == 5
    plan = got._jdf.queryExecution().executedPlan().toString()
    # Nothing is shuffled above the join that multiplies the on-hand rows.
    assert "Exchange" not in plan[: plan.index("LeftOuter")]


def test_distinct_positions_are_not_put_into_one_task(spark, no_broadcast, tmp_path):
    rows = spark.range(100).select(*[(F.col("id") % (100 if c == "baby_sku" else 3)).alias(c) for c in forecast.POSITION_COLUMNS])
    got = registry._distinct_store_positions(SimpleNamespace(store_position=rows.union(rows).coalesce(1)))
    assert got.count() == 100 and _written_by(got, tmp_path / "rows") > 2


def test_projected_rows_and_their_sums_are_not_put_into_one_task(spark, no_broadcast, tmp_path):
    item = spark.range(100).select(*[(F.col("id") % m).alias(c) for m, c in zip((100, 50, 3), replenishment.WAREHOUSE_ITEM)])
    rows = item.withColumns(
        {c: F.lit(2) for c in ("ppk_qty", "num_of_store", "baby_oh", "first_period_short_term_oo", "second_period_short_term_oo", "copies")}
        | {"coverage_date": F.lit(DAY)}
    )
    need = item.withColumn("total_replenishment_order_qty", F.lit(1.0))
    got = replenishment.projected_on_hand(rows, need)
    assert got.count() == 100 and _written_by(got, tmp_path / "rows") > 2
    assert {r["total_projected_warehouse_oh"] for r in got.collect()} == {6.0}


def test_forecast_by_text_is_dealt_as_it_is_joined(spark, no_broadcast):
    part, nation = _tables(spark)
    inventory = fixtures.inventory_view(part, nation)
    rows = fixtures.forecast_view(inventory)
    skus = rows.select("sku")
    view = fixtures.text_key_tables(fixtures.FixtureTables(skus, skus, inventory, skus, skus, rows, skus, skus)).forecast
    want = rows.withColumn("sku", F.lpad(F.col("sku").cast("string"), 12, "0"))
    assert view.schema == want.schema and sorted(map(str, view.collect())) == sorted(map(str, want.collect()))
    babies = spark.range(1000010, 1000100).select(F.lpad(F.col("id").cast("string"), 12, "0").alias("baby_sku"))
    days = [spark.range(1).select(F.lit(d).alias("d")) for d in (DAY, DAY + dt.timedelta(30))]
    got = extracts.extract_forecast(view, babies, *days)
    plan = got._jdf.queryExecution().executedPlan().toString()
    # The join reads the daily rows where they are made: the pairs are shuffled before.
    joined = plan.index("LeftSemi")
    made = plan.index("Generate explode", joined)
    assert "Exchange" not in plan[joined:made]


def test_forecast_keeps_its_place_in_the_semi_join(spark, no_broadcast):
    view = fixtures.forecast_view(fixtures.inventory_view(*_tables(spark)))
    babies = spark.range(1000010, 1000100).select(F.col("id").alias("baby_sku"))
    days = [spark.range(1).select(F.lit(d).alias("d")) for d in (DAY, DAY + dt.timedelta(30))]
    got = extracts.extract_forecast(view, aggregates.distinct_keys(babies, ["baby_sku"]), *days)
    plan = got._jdf.queryExecution().executedPlan().toString()
    # The keys are shuffled for it, the daily rows are not.
    assert "LeftSemi" in plan and len(re.findall(r"Exchange hashpartitioning\(sku#", plan)) == 1


def test_zero_fill_shuffles_no_position_that_is_valid(spark, no_broadcast):
    g = positions.WAREHOUSE
    per_pos = spark.createDataFrame(
        [(1, True, "a"), (1, False, "a"), (2, False, "a"), (3, True, None), (3, False, "a"), (4, None, "a"), (None, True, "a"), (None, False, "a")],
        "parent_sku long, has_window boolean, style string",
    ).withColumns({c: F.lit(1) for c in g.columns if c not in ("parent_sku", "style")} | {"copies": F.lit(2)})
    got = positions.zero_positions(per_pos, g, Quirks())
    want = without(per_pos, per_pos.where("has_window").dropna(subset=list(g.columns)), "parent_sku")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))
    assert "NOT coalesce(has_window" in got._jdf.queryExecution().optimizedPlan().toString()
