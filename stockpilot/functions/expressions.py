"""Column builders for the projections, filters and scalar rules (PRJ / FLT).

All are Catalyst expressions: they stay inside whole-stage codegen and never
call Python per row.  Missing values are SQL NULL throughout.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed values, as the reference writes them: the replenishment flag is "Y" or
# "N", and an empty promotion flag reads as "N".
YES = "Y"
NO = "N"


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_int(x: ColumnOrName) -> Column:
    """Truncating cast toward zero, from text or any number (PRJ-3)."""
    return _c(x).cast("double").cast("int")


def to_day(x: ColumnOrName) -> Column:
    """Parse to a date, cutting any time of day; NULL stays NULL (PRJ-4).  Text is
    ISO or month/day/year; anything else is an error."""
    slashed = F.regexp_extract(_c(x).cast("string"), r"^\s*(\d{1,2}/\d{1,2}/\d{4})(\s.*)?$", 1)
    return F.coalesce(F.try_to_date(slashed, "M/d/yyyy"), F.to_date(_c(x)))


def add_days(day: ColumnOrName, n: ColumnOrName) -> Column:
    return F.date_add(_c(day), _c(n))


def blank_to(x: ColumnOrName, value: str) -> Column:
    """Replace the empty string; NULL stays NULL (PRJ-6).  A view of this single
    step: no result of the job reads the flag."""
    return F.when(_c(x) == "", F.lit(value)).otherwise(_c(x))


def arrival_date(transit: ColumnOrName, first_ship: ColumnOrName, lead_days: ColumnOrName) -> Column:
    """Transit date when known, else first ship date, plus lead time (PRJ-7), for the
    row-level view; the job adds the lead time to ``order_buckets``' base day."""
    return add_days(F.coalesce(_c(transit), _c(first_ship)), lead_days)


def zero(dtype: str = "bigint") -> Column:
    """A constant zero of the given type (PRJ-8)."""
    return F.lit(0).cast(dtype)


def clamp0(x: ColumnOrName) -> Column:
    """Negative or missing becomes 0 (PRJ-9); ``greatest`` skips NULL."""
    return F.greatest(_c(x), F.lit(0))


def round_even(x: ColumnOrName) -> Column:
    """Round half to even, 0 digits (PRJ-10): 2.5 -> 2, 3.5 -> 4."""
    return F.bround(_c(x), 0)


def replen_flag(store_oh: ColumnOrName, expected: ColumnOrName, level: ColumnOrName) -> Column:
    """'Y' when stock after expected demand falls below the order-up-to level
    (PRJ-11); a NULL comparison gives 'N'."""
    return F.when(_c(store_oh) - _c(expected) < _c(level), F.lit(YES)).otherwise(F.lit(NO))


def pack_units(units: ColumnOrName, ppk: ColumnOrName) -> Column:
    """Order units times units per pack (PRJ-12)."""
    return _c(units) * _c(ppk)


def in_window(arrival: ColumnOrName, coverage: ColumnOrName, extra_lead: ColumnOrName | None = None) -> Column:
    """Order arrives by the coverage date (FLT-1); with ``extra_lead`` the lead
    time is added once more first (FLT-2).  NULL dates are never in."""
    a = _c(arrival) if extra_lead is None else add_days(arrival, extra_lead)
    return F.coalesce(a <= _c(coverage), F.lit(False))


def first_period(cal: ColumnOrName, as_of: dt.date, received: ColumnOrName) -> Column:
    """as_of <= cal_date < received_date (FLT-3)."""
    return F.coalesce((_c(cal) >= F.lit(as_of)) & (_c(cal) < _c(received)), F.lit(False))


def second_period(cal: ColumnOrName, received: ColumnOrName, coverage: ColumnOrName, include_received: bool = False) -> Column:
    """received_date < cal_date <= coverage_date (FLT-4); the received day
    itself belongs to neither period unless ``include_received``."""
    lower = _c(cal) >= _c(received) if include_received else _c(cal) > _c(received)
    return F.coalesce(lower & (_c(cal) <= _c(coverage)), F.lit(False))
