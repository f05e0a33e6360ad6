"""Command line: run one request end to end.

    zip -r stockpilot.zip stockpilot
    spark-submit --conf spark.checkpoint.dir=<shared folder> \\
        --py-files stockpilot.zip stockpilot/__main__.py \\
        --request input.csv --catalog <src> --inventory <src> \\
        --warehouse-orders <src> --store-orders <src> --forecast <src> \\
        --recommendations <target> --missing-skus <target> \\
        --as-of 2024-01-01 --request-id buyer_2024_01_01

or ``python -m stockpilot ...`` where pyspark picks up the cluster settings.
Sources and targets are parquet folders (containing ``/``) or table names.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession

from stockpilot.config import Quirks, RunConfig
from stockpilot.plans.runner import run_job
from stockpilot.sources.tables import load_inputs


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="stockpilot")
    for name in ("request", "catalog", "inventory", "warehouse-orders", "store-orders", "forecast",
                 "recommendations", "missing-skus", "request-id"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--as-of", default=dt.date.today().isoformat())
    p.add_argument("--mode", default="append")
    p.add_argument("--single-file", action="store_true")
    p.add_argument("--quirks", default="{}", help="JSON object of Quirks fields, e.g. {\"dedupe_zero_fill\": true}")
    a = p.parse_args(argv)

    spark = SparkSession.builder.appName("stockpilot").getOrCreate()
    inputs = load_inputs(spark, a.request, a.catalog, a.inventory, a.warehouse_orders, a.store_orders, a.forecast)
    cfg = RunConfig(dt.date.fromisoformat(a.as_of), a.request_id, Quirks(**json.loads(a.quirks)))
    result = run_job(inputs, cfg, a.recommendations, a.missing_skus, a.mode, a.single_file)
    print(json.dumps(result.__dict__))


if __name__ == "__main__":
    main()
