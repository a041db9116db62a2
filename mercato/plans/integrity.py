"""Order checks on storage by order id: no row moves when they run.

Each night's new orders, payments and lines are reduced to mergeable rows per order, which costs one
combined shuffle of the new rows, and stored bucketed by order id. The checks then merge and join bucket
by bucket. An order with a third of all lines is a row per run here, so it makes no bucket heavy.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from mercato.operators import quality
from mercato.sources import buckets
from mercato.streaming.layers import Store

_KINDS = {
    "headers": quality.HEADERS, "lines": quality.LINE_SUMS, "orders": quality.SIDE, "payments": quality.SIDE,
}


@dataclass(frozen=True)
class ByOrder:
    """The tables by order id of a store; the number of buckets is theirs for good."""

    spark: SparkSession
    store: Store
    buckets: int

    def _folder(self, kind: str) -> str:
        return f"{self.store.root}/by_order/{kind}"

    def _table(self, kind: str) -> DataFrame:
        return buckets.open_buckets(self.spark, self._folder(kind), _KINDS[kind], "order_id", self.buckets)

    def _add(self, kind: str, rows: DataFrame, run: int) -> None:
        buckets.add_run(rows, self._folder(kind), _KINDS[kind], "order_id", self.buckets, run)

    def add_orders(self, orders: DataFrame, run: int) -> None:
        """Headers for the line check, of any orders: raw ones with tidied ids, too."""
        self._add("headers", quality.order_headers(orders), run)

    def add_lines(self, lines: DataFrame, run: int) -> None:
        self._add("lines", quality.line_sums(lines), run)

    def add_sides(self, orders: DataFrame, payments: DataFrame, run: int) -> None:
        """Curated orders and payments, for the reconciliation."""
        self._add("orders", quality.order_side(orders, "final_amount"), run)
        self._add("payments", quality.order_side(payments, "amount"), run)

    def line_checks(self) -> DataFrame:
        return quality.headers_against_sums(self._table("headers").drop("run"), quality.merged_line_sums(self._table("lines")))

    def reconciliation(self) -> DataFrame:
        return quality.reconcile_sides(quality.merged_sides(self._table("orders")), quality.merged_sides(self._table("payments")))

    def forget(self) -> None:
        for kind in _KINDS:
            buckets.forget(self.spark, self._folder(kind))
