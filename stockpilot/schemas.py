"""Declared schemas of the job's inputs and outputs.

Columns are checked by name.  Dates, flags, lead times, unit counts and forecasts
have fixed types.  Keys (SKUs, stores, items) keep the type that they come with,
text or number, which has to agree across the tables; quantities stay whole
numbers or doubles as they come.  NaN in a double counts as missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# The buyer's file as written: every column text.
REQUEST_CSV = _schema(
    ("style", T.StringType()),
    ("color", T.StringType()),
    ("first_ship_date", T.StringType()),
    ("coverage_day", T.StringType()),
)

REQUEST = _schema(
    ("style", T.StringType()),
    ("color", T.StringType()),
    ("provided_date", T.StringType()),
    ("coverage_day", T.IntegerType()),
)

CATALOG = _schema(
    ("style", T.StringType()),
    ("color", T.StringType()),
    ("sku", T.LongType()),
    ("item_id", T.LongType()),
)

INVENTORY = _schema(
    ("input_source_store", T.IntegerType()),
    ("store", T.IntegerType()),
    ("parent_sku", T.LongType()),
    ("baby_sku", T.LongType()),
    ("parent_oh", T.LongType()),
    ("baby_oh", T.LongType()),
    ("store_oh", T.LongType()),
    ("ppk_qty", T.LongType()),
    ("lt_days", T.DoubleType()),
    ("sks_ord_level", T.LongType()),
)

# Warehouse and store orders share one layout; ``store`` is the warehouse for
# the former and the selling store for the latter.
ORDERS = _schema(
    ("sku", T.LongType()),
    ("store", T.IntegerType()),
    ("ord_units", T.IntegerType()),
    ("rcvd_units", T.IntegerType()),
    ("first_ship_date", T.DateType()),
    ("transit_date", T.DateType()),
    ("promo_fl", T.StringType()),
)

FORECAST = _schema(
    ("sku", T.LongType()),
    ("store", T.IntegerType()),
    ("cal_date", T.DateType()),
    ("forecast", T.DoubleType()),
)

# The two output tables keep the column names, and spelling, the
# reference writes (``recomended_order_units`` with one "m"), so that readers of
# those tables keep working.
RECOMMENDATIONS = _schema(
    ("input_source_store", T.IntegerType()),
    ("parent_sku", T.LongType()),
    ("baby_sku", T.LongType()),
    ("recomended_order_units", T.LongType()),
    ("num_of_store", T.LongType()),
    ("next_ship_date", T.DateType()),
    ("request_id", T.StringType()),
)

MISSING_SKUS = _schema(
    ("sku", T.LongType()),
    ("request_id", T.StringType()),
)


KEYS = ("sku", "parent_sku", "baby_sku", "item_id", "store", "input_source_store")
QUANTITIES = ("parent_oh", "baby_oh", "store_oh", "ppk_qty", "sks_ord_level")
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _column(df: DataFrame, field: T.StructField) -> Column:
    c, given = F.col(field.name), df.schema[field.name].dataType
    if isinstance(given, (T.DoubleType, T.FloatType)):
        c = F.nanvl(c, F.lit(None).cast(given))
    if field.name in KEYS:
        return c
    if field.name in QUANTITIES:
        return c.cast("bigint" if isinstance(given, WHOLE) else "double")
    return c.cast(field.dataType)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s columns in order, with their declared types.

    Missing columns are an error; extra columns are dropped; keys keep their type.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    return df.select(*[_column(df, f).alias(f.name) for f in schema.fields])


def check_keys(**tables: DataFrame) -> None:
    """Raise when a key is text in one table and a number in another: joining them
    would need a cast that may change keys ('00123' and 123).  Whole numbers of any
    width agree; Spark widens the narrower ones where they meet."""
    places = {
        "sku": (("catalog", "sku"), ("inventory", "parent_sku"), ("inventory", "baby_sku"), ("warehouse_orders", "sku"),
                ("store_orders", "sku"), ("forecast", "sku")),
        "store": (("inventory", "store"), ("store_orders", "store"), ("forecast", "store")),
        "warehouse": (("inventory", "input_source_store"), ("warehouse_orders", "store")),
    }
    for key, where in places.items():
        given = {f"{t}.{c}": tables[t].schema[c].dataType for t, c in where}
        if len({"whole" if isinstance(t, WHOLE) else t.simpleString() for t in given.values()}) > 1:
            types = {place: t.simpleString() for place, t in given.items()}
            raise TypeError(f"the {key} key has different types: {types}")
