"""The nightly job: four summaries for one as-of date, each stored as a snapshot."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack
from dataclasses import dataclass
from functools import cache
from threading import Lock

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from mercato.operators.customers import customer_metrics
from mercato.plans import summaries
from mercato.plans.tables import Tables
from mercato.session import staged
from mercato.sources.snapshots import refresh_snapshot, write_snapshot
from mercato.sources.tables import has_rows
from mercato.streaming.layers import Store

MANIFEST = "summary string, status string, rows bigint, as_of string"


@dataclass(frozen=True)
class Step:
    """A summary, the table it needs, and whether it can be refreshed for single days."""

    name: str
    source: str
    build: Callable[[], DataFrame]
    per_day: bool = False


def run_nightly(
    spark: SparkSession,
    tables: Tables,
    store: Store,
    as_of: str,
    dates: list[str] | None = None,
    compat: bool = False,
) -> DataFrame:
    """Build and store the summaries; returns what was written, skipped or failed.

    Daily sales come first and the others wait for them; the others do not depend on each
    other and run side by side. A missing or empty input skips a summary. ``dates``
    recomputes only those days of the two per-day summaries. Customer metrics feed two
    summaries and are stored once for both.
    """
    first_use = Lock()
    with ExitStack() as open_tables, ThreadPoolExecutor(3) as pool:

        @cache
        def stored_metrics() -> DataFrame:
            totals = customer_metrics(tables.orders, as_of, by_identity=compat)
            return open_tables.enter_context(staged(totals, "customer-metrics"))

        def metrics() -> DataFrame:
            with first_use:
                return stored_metrics()

        def run(step: Step) -> tuple[str, str, int, str]:
            return step.name, *_run_step(tables, step, store, dates), as_of

        first, *others = [
            Step("daily_sales", "orders",
                 lambda: summaries.daily_sales(tables.orders, as_of, compat, dates), per_day=True),
            Step("customer_rfm", "orders", lambda: summaries.score_customers(metrics(), as_of, compat)),
            Step("churn_candidates", "orders", lambda: summaries.churn_from_metrics(metrics(), as_of)),
            Step("payment_analysis", "payments",
                 lambda: summaries.payment_analysis(tables.payments, as_of, dates), per_day=True),
        ]
        manifest = [run(first)]
        if manifest[0][1].startswith("failed"):
            manifest += [(step.name, "blocked", 0, as_of) for step in others]
        else:
            manifest += pool.map(run, others)
    return spark.createDataFrame(manifest, MANIFEST)


def _run_step(tables: Tables, step: Step, store: Store, dates: list[str] | None) -> tuple[str, int]:
    try:
        source = tables[step.source]
    except (PySparkException, FileNotFoundError):
        return "skipped", 0
    path = store.summary(step.name)
    try:
        if not has_rows(source):
            return "skipped", 0
        if dates is None or not step.per_day:
            return "written", write_snapshot(step.build(), path)
        return "written", refresh_snapshot(step.build(), path, "date", dates)
    except Exception as problem:  # a failed task is no PySparkException
        return f"failed: {type(problem).__name__}", 0
