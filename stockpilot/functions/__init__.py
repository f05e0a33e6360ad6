from stockpilot.functions.expressions import (
    add_days,
    arrival_date,
    blank_to,
    clamp0,
    first_period,
    in_window,
    pack_units,
    replen_flag,
    round_even,
    second_period,
    to_day,
    to_int,
    zero,
)

__all__ = [
    "add_days",
    "arrival_date",
    "blank_to",
    "clamp0",
    "first_period",
    "in_window",
    "pack_units",
    "replen_flag",
    "round_even",
    "second_period",
    "to_day",
    "to_int",
    "zero",
]
