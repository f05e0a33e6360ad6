"""The batch runner writes what the plan computes."""

import datetime as dt
import pathlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import test_hand_examples as hand
from conftest import SF0001
from stockpilot import registry, schemas
from stockpilot.config import RunConfig
from stockpilot.functions import to_day
from stockpilot.operators.quality import DuplicateRowsError
from stockpilot.operators.request import RepeatedRequestError
from stockpilot.plans.stages import Inputs
from stockpilot.plans.runner import run_job
from stockpilot.session import shared_dir
from stockpilot.sources import sinks
from stockpilot.sources.extracts import read_request, write_request_csv
from stockpilot.sources.fixtures import AS_OF


def _rows(df, drop=("request_id",)):
    return Counter(tuple(r) for r in df.drop(*drop).collect())


def test_run_job_writes_both_results(spark, tmp_path):
    st = registry.stages(spark, SF0001)
    recs, missing = str(tmp_path / "recs"), str(tmp_path / "missing")
    result = run_job(st.inputs, st.cfg, recs, missing)
    assert not result.request_has_nulls and result.request_duplicate_rows == 0
    assert _rows(spark.read.parquet(recs), ()) == _rows(st.recommendations, ())
    assert _rows(spark.read.parquet(missing), ()) == _rows(st.missing_skus, ())


def test_duplicate_order_rows_stop_the_run(spark, tmp_path):
    st = registry.stages(spark, SF0001)
    i = st.inputs
    doubled = Inputs(i.request, i.catalog, i.inventory, i.warehouse_orders.unionByName(i.warehouse_orders), i.store_orders, i.forecast)
    with pytest.raises(DuplicateRowsError):
        run_job(doubled, st.cfg, str(tmp_path / "r"), str(tmp_path / "m"))
    assert not (tmp_path / "r").exists()


@pytest.mark.parametrize("kind", ["folder", "table"])
def test_a_rerun_replaces_its_request_and_no_other(spark, tmp_path, kind):
    st = registry.stages(spark, SF0001)
    target = str(tmp_path / "recs") if kind == "folder" else "recs_by_request"
    spark.sql("DROP TABLE IF EXISTS recs_by_request")
    rows = st.recommendations.cache()
    for run in ("r0", "r1", "r0"):
        sinks.write_recommendations(rows.withColumn("request_id", F.lit(run)), target, by_request=True)
    out = sinks.read_back(rows, target)
    for run in ("r0", "r1"):
        assert _rows(out.where(F.col("request_id") == run).select(*rows.columns)) == _rows(rows)
    assert out.count() == 2 * rows.count()
    spark.sql("DROP TABLE IF EXISTS recs_by_request")


def test_staged_folders_go_with_a_run_that_ends_well(spark, tmp_path):
    staged = pathlib.Path(shared_dir(spark).removeprefix("file:")) / "staged"
    before = set(staged.iterdir()) if staged.exists() else set()
    i = registry.stages(spark, SF0001)
    run_job(i.inputs, i.cfg, str(tmp_path / "r"), str(tmp_path / "m"), single_file=True)
    assert set(staged.iterdir()) <= before
    assert len(list((tmp_path / "r").glob("part-*"))) == 1


REPEATS = {
    "an exact repeat": [("ST", "RED", "2024-01-10", 10), ("ST", "RED", "2024-01-10", 10)],
    "two dates": [("ST", "RED", "2024-01-10", 10), ("ST", "RED", "1/12/2024", 10)],
}


@pytest.mark.parametrize("kind", sorted(REPEATS))
def test_a_repeated_request_stops_the_run(spark, tmp_path, kind):
    i = hand._inputs(spark, [hand._inv(11, 100, 5, 6)], hand.H1_WAREHOUSE)
    request = spark.createDataFrame(REPEATS[kind], schemas.REQUEST)
    twice = Inputs(request, i.catalog, i.inventory, i.warehouse_orders, i.store_orders, i.forecast)
    with pytest.raises(RepeatedRequestError, match="'ST', color 'RED'"):
        run_job(twice, RunConfig(hand.AS_OF, "twice"), str(tmp_path / "r"), str(tmp_path / "m"))
    assert not (tmp_path / "r").exists() and not (tmp_path / "m").exists()


def test_keys_of_different_types_are_refused(spark):
    i = hand._inputs(spark, [hand._inv(11, 100, 5, 6)], hand.H1_WAREHOUSE)
    text = i.catalog.withColumn("sku", F.col("sku").cast("string"))
    with pytest.raises(TypeError, match="sku key"):
        schemas.check_keys(
            catalog=text, inventory=i.inventory, warehouse_orders=i.warehouse_orders, store_orders=i.store_orders, forecast=i.forecast
        )


def test_keys_of_any_whole_width_agree(spark, tmp_path):
    """An int key beside a bigint one is the same key."""
    i = hand._inputs(spark, [hand._inv(11, 100, 5, 6), hand._inv(12, 100, 5, 1)], hand.H1_WAREHOUSE)
    narrow = lambda df, *keys: df.withColumns({k: F.col(k).cast("int") for k in keys})
    mixed = Inputs(
        i.request, narrow(i.catalog, "sku"), narrow(i.inventory, "parent_sku"), narrow(i.warehouse_orders, "sku"), i.store_orders, i.forecast
    )
    for name, inputs in (("same", i), ("mixed", mixed)):
        run_job(inputs, RunConfig(hand.AS_OF, "widths"), str(tmp_path / name), str(tmp_path / f"{name}-missing"))
    read = [sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / name)).collect()) for name in ("same", "mixed")]
    assert read[0] and read[0] == read[1]


def test_repeated_request_rows_are_in_the_result(spark, tmp_path):
    i = hand._inputs(spark, [hand._inv(11, 100, 5, 6)], hand.H1_WAREHOUSE)
    extra = spark.createDataFrame([("none such", "RED", "2024-01-10", 10)] * 3, i.request.schema)
    repeated = Inputs(i.request.unionByName(extra), i.catalog, i.inventory, i.warehouse_orders, i.store_orders, i.forecast)
    result = run_job(repeated, RunConfig(hand.AS_OF, "again"), str(tmp_path / "r"), str(tmp_path / "m"))
    assert result.request_duplicate_rows == 2
    assert {r["style"] for r in result.repeated_requests.collect()} == {"none such"}


def test_missing_and_fractional_values_of_the_sources(spark):
    rows = spark.createDataFrame([("00123", 1.75, float("nan"))], "sku string, store_oh double, forecast double")
    schema = T.StructType([T.StructField("sku", T.LongType()), T.StructField("store_oh", T.LongType()), T.StructField("forecast", T.DoubleType())])
    assert [tuple(r) for r in schemas.conform(rows, schema).collect()] == [("00123", 1.75, None)]


def test_request_files_as_spreadsheets_write_them(spark, tmp_path):
    path = tmp_path / "request.csv"
    path.write_text('style,color,first_ship_date,coverage_day\n"5"" POT",NA,1/15/2024,14\n"a, b",RED,2024-01-05 10:00:00,\n')
    read = read_request(spark, str(path))
    got = [tuple(r) for r in read.withColumn("provided_date", to_day("provided_date")).collect()]
    assert got == [('5" POT', None, dt.date(2024, 1, 15), 14), ("a, b", "RED", dt.date(2024, 1, 5), None)]


def test_command_line_run(spark, tmp_path, capsys):
    import json

    from stockpilot.__main__ import main

    st = registry.stages(spark, SF0001)
    i = st.inputs
    src = {}
    for name in ("catalog", "inventory", "warehouse_orders", "store_orders", "forecast"):
        src[name] = str(tmp_path / name)
        getattr(i, name).write.parquet(src[name])
    request = write_request_csv(i.request, str(tmp_path / "request"))
    recs, missing = str(tmp_path / "recs"), str(tmp_path / "missing")
    main([
        "--request", request, "--catalog", src["catalog"], "--inventory", src["inventory"],
        "--warehouse-orders", src["warehouse_orders"], "--store-orders", src["store_orders"],
        "--forecast", src["forecast"], "--recommendations", recs, "--missing-skus", missing,
        "--as-of", AS_OF.isoformat(), "--request-id", st.cfg.request_id,
    ])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["request_id"] == st.cfg.request_id
    assert _rows(spark.read.parquet(recs), ()) == _rows(st.recommendations, ())
    assert _rows(spark.read.parquet(missing), ()) == _rows(st.missing_skus, ())


def test_request_checks_warn_and_count(spark):
    from stockpilot import schemas
    from stockpilot.plans.runner import check_request

    request = spark.createDataFrame(
        [("ST", "RED", "2024-01-10", 10), ("ST", "RED", "2024-01-10", 10), ("XX", None, "2024-01-10", 10)], schemas.REQUEST
    )
    assert check_request(request) == (True, 1)
