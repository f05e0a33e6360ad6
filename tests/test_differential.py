"""Random inputs with the awkward cases, Spark against the row-level oracle.

Each case has stores under two warehouses, parents with several babies,
on-hand values that vary within a warehouse, repeated on-hand rows, NULL
on-hand values, levels, pack sizes and dates, NULL and NaN forecasts, fractional
quantities, zero pack sizes, orders for SKUs nobody asked for and a request no
catalog entry matches.
"""

import datetime as dt
import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from stockpilot import schemas
from stockpilot.config import Quirks, RunConfig
from stockpilot.oracle import sql as oracle
from stockpilot.oracle.compare import diff
from stockpilot.plans.stages import Inputs, Stages

AS_OF = dt.date(2024, 1, 1)
STAGES = {
    "expanded": "isku",
    "warehouse_position": "warehouse_position",
    "store_position": "store_position",
    "store_forecast": "spf",
    "store_need": "need",
    "recommended": "recommended",
    "packed": "packed",
    "recommendations": "recommendations",
    "missing_skus": "missing_skus",
}
ARROW = {
    "string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "date": pa.date32(),
}


def _day(rng, lo, hi):
    return AS_OF + dt.timedelta(days=rng.randint(lo, hi))


def make_case(seed, fractional=False):
    rng = random.Random(seed)

    def part():
        return rng.choice((0.0, 0.25, 0.5, 0.75)) if fractional else 0

    pairs = [(s, c) for s in ("S1", "S2", "S3", "S4") for c in ("RED", "BLUE")]
    skus = list(range(1, 25))
    catalog = [(*rng.choice(pairs), k, k * 10) for k in skus]
    asked = rng.sample(pairs, 5)
    request = [(s, c, _day(rng, 0, 20).isoformat(), rng.randint(7, 35)) for s, c in asked] + [("NONE", "RED", "2024-01-05", 14)]

    warehouses_of = {10: [1], 11: [1], 12: [2], 13: [1, 2], 14: [2], 15: [1]}
    lead = {1: 5.0, 2: 9.0}
    inventory = []
    for p in rng.sample(skus, 14):
        babies = [p] if rng.random() < 0.5 else [1000 + p * 10 + j for j in range(1, rng.randint(2, 3) + 1)]
        ppk = rng.choice([1, 2, 3, 6, 12, 0] if rng.random() < 0.1 else [1, 2, 3, 6, 12])
        level = rng.randint(2, 15)
        for store in rng.sample(sorted(warehouses_of), rng.randint(1, 5)):
            for wh in warehouses_of[store]:
                for b in babies:
                    parent_oh = None if rng.random() < 0.05 else (p * 7 + wh) % 30 + (rng.randint(0, 3) if rng.random() < 0.2 else 0)
                    baby_oh = (b * 3 + wh) % 25
                    store_oh = None if rng.random() < 0.05 else rng.randint(0, 20) + part()
                    own_level = None if rng.random() < 0.04 else level + part()
                    own_ppk = None if rng.random() < 0.04 else ppk
                    if baby_oh is not None:
                        baby_oh += part()
                    inventory.append((wh, store, p, b, parent_oh, baby_oh, store_oh, own_ppk, lead[wh], own_level))
    inventory += rng.sample(inventory, 3)

    def orders(locations, n):
        rows = set()
        for _ in range(n):
            units = rng.randint(1, 20)
            first = None if rng.random() < 0.05 else _day(rng, -15, 90)
            transit = None if rng.random() < 0.6 else _day(rng, -10, 90)
            rows.add((rng.choice(skus), rng.choice(locations), units, rng.randint(0, units), first, transit, rng.choice("YN") if rng.random() < 0.8 else ""))
        return sorted(rows, key=repr)

    stocked = sorted({(r[3], r[1]) for r in inventory}) + [(999, 10)]
    forecast = []
    for b, s in stocked:
        step = rng.choice([1, 3, 7])
        for off in range(-5, 70, step):
            if rng.random() < 0.1:
                continue
            value = None if rng.random() < 0.03 else float("nan") if rng.random() < 0.03 else rng.randint(0, 16) * 0.5
            forecast.append((b, s, AS_OF + dt.timedelta(days=off), value))
    return dict(
        request=request, catalog=catalog, inventory=inventory,
        warehouse_orders=orders([1, 2], 60), store_orders=orders(sorted(warehouses_of), 90), forecast=forecast,
    )


QUANTITIES = [f if f.name not in schemas.QUANTITIES else T.StructField(f.name, T.DoubleType()) for f in schemas.INVENTORY.fields]
SCHEMAS = dict(
    request=schemas.REQUEST, catalog=schemas.CATALOG, inventory=schemas.INVENTORY,
    warehouse_orders=schemas.ORDERS, store_orders=schemas.ORDERS, forecast=schemas.FORECAST,
)


def _arrow(rows, schema):
    fields = [pa.field(f.name, ARROW[f.dataType.simpleString()]) for f in schema.fields]
    cols = list(zip(*rows)) if rows else [[] for _ in fields]
    return pa.table([pa.array(list(c), type=f.type) for c, f in zip(cols, fields)], schema=pa.schema(fields))


CASES = [
    (1, Quirks()),
    (2, Quirks()),
    (3, Quirks()),
    (4, Quirks(store_extra_lead=False, include_received_day=True, require_both_periods=False,
               pack_max_scope="warehouse", zero_fill_grain="position", dedupe_zero_fill=True)),
    (5, Quirks(zero_fill_grain="position")),
    (6, Quirks(dedupe_zero_fill=True)),
    (7, Quirks(pack_max_scope="warehouse", require_both_periods=False)),
    (8, Quirks(include_received_day=True, store_extra_lead=False)),
]


@pytest.mark.parametrize("seed,quirks", CASES)
def test_random_case_matches_oracle(spark, seed, quirks):
    fractional = seed % 2 == 0
    case = make_case(seed, fractional)
    given = dict(SCHEMAS, inventory=T.StructType(QUANTITIES)) if fractional else SCHEMAS
    rows_of = {n: [tuple(float(v) if fractional and f.name in schemas.QUANTITIES and v is not None else v for v, f in zip(r, given[n].fields)) for r in rows] for n, rows in case.items()}
    # As the sources are loaded: NaN becomes NULL.
    inputs = Inputs(**{n: schemas.conform(spark.createDataFrame(rows, given[n]), SCHEMAS[n]) for n, rows in rows_of.items()})
    st = Stages(inputs, RunConfig(AS_OF, "diff", quirks))
    con = duckdb.connect()
    for n, rows in rows_of.items():
        con.register(n, _arrow([tuple(None if v != v else v for v in r) for r in rows], given[n]))
    for attr, cte in STAGES.items():
        df = getattr(st, attr)
        select = oracle.with_ctes(f"SELECT * FROM {cte}", quirks, "diff", AS_OF.isoformat(), given_tables=True, fractional=fractional)
        cur = con.execute(select)
        expected = cur.fetchall()
        cols = [d[0] for d in cur.description]
        assert diff(df.columns, [tuple(r) for r in df.collect()], cols, expected) is None, attr
