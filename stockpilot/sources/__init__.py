from stockpilot.sources.extracts import (
    extract_forecast,
    extract_inventory,
    extract_store_orders,
    extract_warehouse_orders,
    lookup_skus,
    read_request,
    sku_keys,
    stage,
    write_request_csv,
)
from stockpilot.sources.sinks import write_missing, write_recommendations

__all__ = [
    "extract_forecast",
    "extract_inventory",
    "extract_store_orders",
    "extract_warehouse_orders",
    "lookup_skus",
    "read_request",
    "sku_keys",
    "stage",
    "write_missing",
    "write_recommendations",
    "write_request_csv",
]
