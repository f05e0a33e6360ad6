"""stockpilot: inventory replenishment planning as Spark DataFrame operators.

Given a buyer's request (style, color, ship date, days of coverage), a product
catalog, open purchase orders for warehouses and stores, an on-hand snapshot and
a daily forecast, the operators compute open-order positions by period, store
demand, replenishment needs, projected warehouse stock and the recommended
order quantity in units or packs, plus a report of requested SKUs that no store
carries.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark
built-ins only; nothing runs in a Python worker.
"""

from stockpilot.config import Quirks, RunConfig
from stockpilot.plans.stages import Inputs, Stages, missing_skus, recommend_orders

__all__ = [
    "Inputs",
    "Quirks",
    "RunConfig",
    "Stages",
    "missing_skus",
    "recommend_orders",
]
