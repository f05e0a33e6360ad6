"""Run parameters and the switches for reference behaviours that change results.

The defaults reproduce the reference job exactly, quirks included, so that its
users get the numbers they get today.  Each switch names the fixed behaviour.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

PACK_SCOPES = ("parent", "warehouse")
ZERO_FILL_GRAINS = ("sku", "position")


@dataclass(frozen=True)
class Quirks:
    # Store orders count the lead time twice in the window test
    # (arrival + lead <= coverage); False tests arrival <= coverage.
    store_extra_lead: bool = True
    # Forecast on the received date itself falls in neither period; True puts
    # it in the second period.
    include_received_day: bool = False
    # A store needs forecast rows in both periods or it drops out; False keeps
    # it with a zero total for the empty period.
    require_both_periods: bool = True
    # Multi-baby parents take max quantity / max pack over all warehouses
    # ("parent") or over each warehouse on its own ("warehouse").
    pack_max_scope: str = "parent"
    # Zero-filled positions are added only for SKUs with no in-window order
    # anywhere ("sku") or for every position without one ("position").
    zero_fill_grain: str = "sku"
    # Zero-filled warehouse/store rows are repeated once per matched order
    # row; True keeps one copy.
    dedupe_zero_fill: bool = False

    def __post_init__(self) -> None:
        if self.pack_max_scope not in PACK_SCOPES:
            raise ValueError(f"pack_max_scope must be one of {PACK_SCOPES}")
        if self.zero_fill_grain not in ZERO_FILL_GRAINS:
            raise ValueError(f"zero_fill_grain must be one of {ZERO_FILL_GRAINS}")


@dataclass(frozen=True)
class RunConfig:
    """``as_of`` replaces the wall clock that decides the first forecast period;
    ``request_id`` tags every output row."""

    as_of: dt.date
    request_id: str
    quirks: Quirks = field(default_factory=Quirks)
