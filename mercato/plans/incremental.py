"""Nightly summaries that read what is new, not the whole history.

A run takes the curated batches that came since the last one, late records of earlier days among
them, and keeps, below ``<root>/state``:

- ``customers``: mergeable totals per customer, bucketed by customer. New orders are reduced to a row
  per customer, dealt out like the buckets, and merged; the stored side is read where it lies, without
  a shuffle, and written as the next version.
- ``numbers``: a whole number per customer from 1 on, given once, without gaps.
- ``daily/<summary>/date=<d>``: summaries per day. Only days that new batches hold are computed
  again, from those days' folders of the layer, and replace their folders by dynamic partition
  overwrite; the folders of other days keep their files. ``event_customers`` has, per day, event type
  and block of customers, a bitmap of the customers; any range of days is an OR of bitmaps, exact.

A marker, published last, says which batches are in and which version of the totals is valid. A run
that fails midway leaves the marker as it was and is repeated: totals go to a new version, days and
numbers are written anew. ``tidy`` must not delete batches that no run has read; if it has, the run
says so and :func:`run` with ``rebuild=True`` starts over from the whole layer.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mercato import schemas
from mercato.operators.customers import TOTALS, customer_totals, merged_totals, metrics_from_totals
from mercato.plans import summaries
from mercato.session import staged
from mercato.sources.files import Files
from mercato.sources.snapshots import write_snapshot
from mercato.streaming import layers
from mercato.streaming.layers import Changes, Store

NUMBERS = "customer_id string, number bigint"
MANIFEST = "summary string, status string, rows bigint, as_of string"


@dataclass(frozen=True)
class Progress:
    """What the stored state holds."""

    seen: dict[str, dict[str, int]]
    customers: str | None = None
    buckets: int = 0
    numbered: int = 0
    run: int = 0


def _state(store: Store) -> str:
    return f"{store.root}/state"


def daily_folder(store: Store, name: str) -> str:
    return f"{_state(store)}/daily/{name}"


def progress(spark: SparkSession, store: Store) -> Progress:
    files, folder = Files(spark), f"{_state(store)}/current"
    markers = [n for n in files.names(folder) if n.isdigit()]
    return Progress(**json.loads(files.read_text(f"{folder}/{markers[-1]}"))) if markers else Progress(seen={})


def _publish(spark: SparkSession, store: Store, now: Progress) -> None:
    Files(spark).publish_text(f"{_state(store)}/current/{now.run:012d}", json.dumps(asdict(now)))


# -- customers ----------------------------------------------------------------
def _table_of(folder: str) -> str:
    return f"customer_totals_{folder.rsplit('-', 1)[-1]}"


def stored_totals(spark: SparkSession, folder: str, buckets: int) -> DataFrame:
    """A version of the totals as a bucketed table; the catalog entry is made where it is missing."""
    name = _table_of(folder)
    if not spark.catalog.tableExists(name):
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({TOTALS}) USING parquet "
            f"CLUSTERED BY (customer_id) SORTED BY (customer_id) INTO {buckets} BUCKETS LOCATION '{folder}'"
        )
    return spark.table(name)


def folded(spark: SparkSession, orders: DataFrame, before: DataFrame | None, buckets: int) -> DataFrame:
    """Totals after some more orders. They are combined by customer, then dealt out as the buckets are,
    so the join moves nothing of what is stored."""
    more = customer_totals(orders).repartition(buckets, "customer_id")
    return more if before is None else merged_totals(before, more)


def _write_totals(totals: DataFrame, store: Store, buckets: int) -> str:
    folder = f"{_state(store)}/customers/version-{uuid.uuid4().hex}"
    writer = totals.write.format("parquet").bucketBy(buckets, "customer_id").sortBy("customer_id")
    writer.option("path", folder).saveAsTable(_table_of(folder))
    return folder


def customer_metrics(spark: SparkSession, store: Store, as_of: str) -> DataFrame:
    """Customer metrics for a date, from the stored totals."""
    now = progress(spark, store)
    if now.customers is None:
        raise FileNotFoundError(f"no customer totals at {store.root}")
    return metrics_from_totals(stored_totals(spark, now.customers, now.buckets), as_of)


# -- days -----------------------------------------------------------------------
def _of_days(rows: DataFrame, dates: list[str | None]) -> DataFrame:
    """Rows of some days; a filter on date folders. ``UNDATED`` stands for all rows whose date is none."""
    known = [d for d in dates if d not in (None, layers.UNDATED)]
    chosen = F.col("date").isin(known) if known else F.lit(False)
    return rows.where(chosen if len(known) == len(dates) else chosen | ~layers.is_date())


def refresh_days(days: DataFrame, folder: str, dates: int) -> None:
    """Replace the folders of exactly the days that ``days`` has, ``dates`` at most.

    A day has few rows, so its file costs more than they do; the days are dealt out over all cores.
    """
    tasks = max(1, min(dates, days.sparkSession.sparkContext.defaultParallelism))
    (
        layers.into_partitions(days).repartition(tasks, "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("date").parquet(folder)
    )


def read_days(spark: SparkSession, store: Store, name: str) -> DataFrame:
    """A daily summary, all days; filters on ``date`` read those folders only."""
    folder = daily_folder(store, name)
    found = spark.read.parquet(folder)
    order = [f.name for f in found.schema if f.name != "date"]
    ddl = StructType([*[found.schema[c] for c in order]]).add("date", "string")
    rows = layers.out_of_partitions(spark.read.schema(ddl).parquet(folder))
    return rows.select("date", *[c for c in order if c != "date_text"])


# -- customer numbers and bitmaps -------------------------------------------------
def customer_numbers(spark: SparkSession, store: Store) -> DataFrame:
    """(customer_id, number, run) of all customers that events named so far, and the run that numbered them."""
    folder = f"{_state(store)}/numbers"
    if not Files(spark).exists(folder):
        return spark.createDataFrame([], f"{NUMBERS}, run bigint")
    return spark.read.schema(f"{NUMBERS}, run bigint").parquet(folder)


def _number_customers(events: DataFrame, store: Store, now: Progress) -> int:
    """Give numbers to customers that have none; returns how many are numbered now.

    New ids are stored with their task and place in it first; a task's first number follows from the
    counts of the tasks before it, one row per task. Numbers of an unfinished run are not read.
    """
    spark = events.sparkSession
    known = customer_numbers(spark, store).where(F.col("run") < now.run)
    new = events.select("customer_id").distinct().join(known.select("customer_id"), "customer_id", "left_anti")
    placed = new.select("customer_id", F.monotonically_increasing_id().alias("at"))
    with staged(placed, "new-customers") as rows:
        task, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
        sizes = rows.groupBy(task.alias("task")).agg(F.count("*").alias("n")).orderBy("task").collect()
        firsts, total = [], now.numbered
        for r in sizes:
            firsts.append((r["task"], total))
            total += r["n"]
        starts = spark.createDataFrame(firsts, "task bigint, first bigint")
        numbered = rows.select("customer_id", task.alias("task"), place.alias("place")).join(F.broadcast(starts), "task")
        numbered.select("customer_id", (F.col("first") + F.col("place") + 1).alias("number")).write.mode("overwrite").parquet(
            f"{_state(store)}/numbers/run={now.run}"
        )
    return total


def _device_counts() -> list[Column]:
    return [F.count_if(F.col("device") == d.upper()).alias(f"{d.lower()}_events") for d in schemas.DEVICES]


def daily_event_counts(events: DataFrame) -> DataFrame:
    """Events per day and type, in all and per device."""
    return events.groupBy("date", "event_type").agg(F.count("event_id").alias("total_events"), *_device_counts())


def daily_event_customers(events: DataFrame, numbers: DataFrame) -> DataFrame:
    """(date, event_type, block, customers): bitmaps of the customers of a day's events of a type.

    Customers of a day and type are made distinct before the join, so a customer with a third of the
    events is a row per day and type there.
    """
    named = events.select("date", "event_type", "customer_id").distinct().join(numbers.select("customer_id", "number"), "customer_id")
    return named.groupBy("date", "event_type", F.bitmap_bucket_number("number").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("customers")
    )


def event_funnel(spark: SparkSession, store: Store, first: str | None = None, last: str | None = None) -> DataFrame:
    """Events and distinct customers per type over a range of days, both ends included, from the daily
    rows alone. Days without date are in no range, and in the funnel without a range."""
    counts, customers = (read_days(spark, store, n) for n in ("event_counts", "event_customers"))
    for bound, of in ((first, "date >= '{}'"), (last, "date <= '{}'")):
        if bound is not None:
            counts, customers = counts.where(of.format(bound)), customers.where(of.format(bound))
    added = counts.groupBy("event_type").agg(
        *[F.sum(c).alias(c) for c in ("total_events", *[f"{d.lower()}_events" for d in schemas.DEVICES])]
    )
    blocks = customers.groupBy("event_type", "block").agg(F.bitmap_count(F.bitmap_or_agg("customers")).alias("n"))
    distinct = blocks.groupBy("event_type").agg(F.sum("n").alias("unique_customers"))
    return added.join(distinct, "event_type").select(
        "event_type", "total_events", "unique_customers", *[f"{d.lower()}_events" for d in schemas.DEVICES]
    )


# -- the run ----------------------------------------------------------------------
def _everything(spark: SparkSession, store: Store, topic: str) -> Changes | None:
    """The whole layer as changes, for a new start."""
    try:
        rows = layers.read_curated(spark, store, topic)
    except FileNotFoundError:
        return None
    day = F.when(layers.is_date(), F.col("date")).otherwise(layers.UNDATED)
    dates = [r[0] for r in rows.select(day).distinct().collect()]
    return Changes(rows, dates, layers.committed_batches(spark, store, topic))


def _fold_orders(spark: SparkSession, store: Store, now: Progress, orders: Changes, as_of: str) -> Progress:
    before = stored_totals(spark, now.customers, now.buckets) if now.customers else None
    version = _write_totals(folded(spark, orders.rows, before, now.buckets), store, now.buckets)
    days = _of_days(layers.read_curated(spark, store, "orders"), orders.dates)
    refresh_days(summaries.daily_sales(days, as_of), daily_folder(store, "daily_sales"), len(orders.dates))
    return replace(now, customers=version)


def _fold_payments(spark: SparkSession, store: Store, now: Progress, payments: Changes, as_of: str) -> Progress:
    days = _of_days(layers.read_curated(spark, store, "payments"), payments.dates)
    refresh_days(summaries.payment_analysis(days, as_of), daily_folder(store, "payment_analysis"), len(payments.dates))
    return now


def _fold_events(spark: SparkSession, store: Store, now: Progress, events: Changes, as_of: str) -> Progress:
    now = replace(now, numbered=_number_customers(events.rows, store, now))
    days = _of_days(layers.read_curated(spark, store, "user_events"), events.dates)
    refresh_days(daily_event_counts(days), daily_folder(store, "event_counts"), len(events.dates))
    refresh_days(daily_event_customers(days, customer_numbers(spark, store)), daily_folder(store, "event_customers"), len(events.dates))
    return now


_FOLD = {"orders": _fold_orders, "payments": _fold_payments, "user_events": _fold_events}


def run(spark: SparkSession, store: Store, as_of: str, buckets: int | None = None, rebuild: bool = False) -> DataFrame:
    """Bring state, daily summaries and the two customer summaries up to date; returns what was done:
    per topic the days written, per customer summary its rows.

    ``buckets`` counts when the stored totals begin, at the first run or a rebuild; it is
    ``spark.sql.shuffle.partitions`` unless given. A topic without new batches is ``unchanged``; the
    customer summaries are always made anew, as days pass for every customer.
    """
    before = progress(spark, store)
    now = replace(before, run=before.run + 1)
    if rebuild:  # numbers, once given, stay
        now = replace(now, seen={}, customers=None, buckets=0)
    if not now.buckets:
        now = replace(now, buckets=buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
    manifest: list[tuple[str, str, int, str]] = []
    for topic, fold in _FOLD.items():
        change = _everything(spark, store, topic) if rebuild else layers.changes(spark, store, topic, now.seen.get(topic, {}))
        if change is None:
            manifest.append((topic, "unchanged", 0, as_of))
            continue
        now = fold(spark, store, now, change, as_of)
        now = replace(now, seen={**now.seen, topic: change.upto})
        manifest.append((topic, "written", len(change.dates), as_of))
    if now.customers is not None:
        metrics = metrics_from_totals(stored_totals(spark, now.customers, now.buckets), as_of)
        with staged(metrics, "customer-metrics") as rows:
            for name, made in (("customer_rfm", summaries.score_customers), ("churn_candidates", summaries.churn_from_metrics)):
                manifest.append((name, "written", write_snapshot(made(rows, as_of), store.summary(name)), as_of))
    _publish(spark, store, now)
    _forget_old_totals(spark, store)
    return spark.createDataFrame(manifest, MANIFEST)


def _forget_old_totals(spark: SparkSession, store: Store) -> None:
    """Delete all versions of the totals but the valid one and the one before it, which may still be read."""
    files, folder, current = Files(spark), f"{_state(store)}/customers", f"{_state(store)}/current"
    markers = [n for n in files.names(current) if n.isdigit()]
    held = {json.loads(files.read_text(f"{current}/{m}"))["customers"] for m in markers[-2:]}
    for name in files.names(folder):
        if f"{folder}/{name}" not in held:
            spark.sql(f"DROP TABLE IF EXISTS {_table_of(name)}")
            files.delete(f"{folder}/{name}")
