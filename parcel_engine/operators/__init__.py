from parcel_engine.operators.dedup import dedup_latest
from parcel_engine.operators.facts import delivery_facts
from parcel_engine.operators.kpis import courier_daily_kpis
from parcel_engine.operators.orders import enrich_orders, order_summary

__all__ = [
    "courier_daily_kpis",
    "dedup_latest",
    "delivery_facts",
    "enrich_orders",
    "order_summary",
]
