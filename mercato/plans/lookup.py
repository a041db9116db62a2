"""Few rows of large layers: the history of some customers, the large orders of a region.

Plain filters on layers compacted with a layout (``sources/layout``), where they reach the row groups.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.plans.analytics import revenue_by_region
from mercato.plans.tables import Tables
from mercato.sources.layout import rows_with

_SHOWN = ["customer_id", "order_id", "date", "timestamp", "region", "city", "final_amount", "status"]


def customer_history(tables: Tables, customers: Iterable[str]) -> DataFrame:
    """All orders of these customers, each customer's latest first; undated ones last."""
    found = rows_with(tables.orders, "customer_id", customers).select(*_SHOWN)
    return found.orderBy("customer_id", F.col("date").desc(), F.col("timestamp").desc(), "order_id")


def largest_customers(tables: Tables, count: int) -> list[str]:
    """Ids of the customers with the greatest revenue, of equal revenue by id."""
    top = tables.customer_metrics.where("customer_id IS NOT NULL").orderBy(F.col("total_revenue").desc(), "customer_id")
    return [r["customer_id"] for r in top.select("customer_id").limit(count).collect()]


def largest_region(tables: Tables) -> str | None:
    """The region with the greatest revenue, of equal revenue the first by name; None without orders."""
    top = revenue_by_region(tables).where("region IS NOT NULL").first()
    return top["region"] if top is not None else None


def region_orders(tables: Tables, region: str | None, least: float) -> DataFrame:
    """Orders of a region (as the curated layer spells it) from an amount on."""
    return tables.orders.where((F.col("region") == F.lit(region)) & (F.col("final_amount") >= least)).select(*_SHOWN)
