"""Every registered query: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato import schemas
from mercato.operators import cleaning, customers, export, quality
from mercato.plans import analytics, catalog, incremental, lookup, nightly, report, summaries
from mercato.sources import envelope as messages
from mercato.sources import snapshots, tables, testdata
from mercato.streaming import drift, layers, live, stateful
from mercato.workspace import AS_OF, HEARTBEAT, Workspace

Query = Callable[[Workspace], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# -- parsing and cleaning -----------------------------------------------------
_TOPIC_LABEL = {"orders": "orders", "payments": "payments", "user_events": "events"}
_UNCOMPARED = ("processed_at", "items")  # run time; always null in the test messages


def _parsed(topic: str) -> Query:
    def run(w: Workspace) -> DataFrame:
        parsed = messages.parse_envelope(w.messages(topic), layers.TOPICS[topic].record, keep_source=False)
        return parsed.drop(*_UNCOMPARED)

    return run


def _keyed(topic: str) -> Query:
    def run(w: Workspace) -> DataFrame:
        return testdata.envelope(w.raw(topic), topic).select(
            F.col("key").cast("string").alias("key"), "topic", "partition", "offset",
            F.get_json_object(F.col("value").cast("string"), "$.date").alias("message_date"),
        )

    return run


def _cleaned(topic: str) -> Query:
    return lambda w: cleaning.CLEAN[topic](w.raw(topic)).drop(*_UNCOMPARED)


for _topic, _label in _TOPIC_LABEL.items():
    QUERIES[f"envelope_{_label}"] = _keyed(_topic)
    QUERIES[f"parse_{_label}"] = _parsed(_topic)
    QUERIES[f"clean_{_label}"] = _cleaned(_topic)
    QUERIES[f"reject_summary_{_label}"] = lambda w, t=_topic: cleaning.reject_summary(w.raw(t), t)
    QUERIES[f"reject_reasons_{_label}"] = lambda w, t=_topic: cleaning.reject_reasons(w.raw(t), t)


# -- nightly summaries --------------------------------------------------------
@query
def daily_sales(w: Workspace) -> DataFrame:
    return summaries.daily_sales(w.tables.orders, AS_OF)


@query
def daily_sales_compat(w: Workspace) -> DataFrame:
    return summaries.daily_sales(w.tables.orders, AS_OF, compat=True)


@query
def customer_metrics(w: Workspace) -> DataFrame:
    return customers.customer_metrics(w.tables.orders, AS_OF)


@query
def rfm_scores(w: Workspace) -> DataFrame:
    return summaries.rfm_scores(w.tables.orders, AS_OF)


@query
def rfm_scores_compat(w: Workspace) -> DataFrame:
    return summaries.rfm_scores(w.tables.orders, AS_OF, compat=True)


@query
def rfm_segment_counts(w: Workspace) -> DataFrame:
    return summaries.rfm_segment_counts(w.tables.customer_rfm)


@query
def churn_candidates(w: Workspace) -> DataFrame:
    return summaries.churn_candidates(w.tables.orders, AS_OF)


@query
def churn_candidates_compat(w: Workspace) -> DataFrame:
    return summaries.churn_candidates(w.tables.orders, AS_OF, compat=True)


@query
def churn_risk_counts(w: Workspace) -> DataFrame:
    return summaries.churn_risk_counts(w.tables.churn_candidates)


@query
def payment_analysis(w: Workspace) -> DataFrame:
    return summaries.payment_analysis(w.tables.payments, AS_OF)


@query
def nightly_manifest(w: Workspace) -> DataFrame:
    return nightly.run_nightly(w.spark, w.tables, w.fresh_store(), AS_OF)


@query
def nightly_snapshot(w: Workspace) -> DataFrame:
    """The stored daily sales after a full run and a rerun of one day."""
    store = w.fresh_store()
    nightly.run_nightly(w.spark, w.tables, store, AS_OF)
    nightly.run_nightly(w.spark, w.tables, store, AS_OF, dates=["2001-07-31"])
    return snapshots.read_snapshot(w.spark, store.summary("daily_sales"))


# -- nightly summaries that read what is new --------------------------------------
@query
def customer_metrics_folded(w: Workspace) -> DataFrame:
    """Metrics out of totals that four nightly runs merged, each from new batches only."""
    return incremental.customer_metrics(w.spark, w.nightly_runs("orders"), AS_OF)


@query
def rfm_scores_folded(w: Workspace) -> DataFrame:
    return snapshots.read_snapshot(w.spark, w.nightly_runs("orders").summary("customer_rfm"))


@query
def churn_candidates_folded(w: Workspace) -> DataFrame:
    return snapshots.read_snapshot(w.spark, w.nightly_runs("orders").summary("churn_candidates"))


@query
def daily_sales_refreshed(w: Workspace) -> DataFrame:
    """Daily sales of which each run replaced the days it had new orders of."""
    return incremental.read_days(w.spark, w.nightly_runs("orders"), "daily_sales")


@query
def payment_analysis_refreshed(w: Workspace) -> DataFrame:
    return incremental.read_days(w.spark, w.nightly_runs("payments"), "payment_analysis")


#: Days of the test tables' events, for the funnel over a range.
DAYS = ("2024-01-05", "2024-01-20")


@query
def event_funnel_range(w: Workspace) -> DataFrame:
    """Distinct customers per event type over some days, from daily bitmaps."""
    return incremental.event_funnel(w.spark, w.nightly_runs("user_events"), *DAYS)


@query
def event_funnel_all_days(w: Workspace) -> DataFrame:
    return incremental.event_funnel(w.spark, w.nightly_runs("user_events"))


# -- analyses, sheets, warehouse queries, checks, findings ----------------------
for _name, _analysis in analytics.ANALYSES.items():
    if _name.startswith("warehouse_"):
        QUERIES[_name] = lambda w, f=_analysis: f(w.warehouse_tables())
    else:
        QUERIES[_name] = lambda w, f=_analysis: f(w.tables)

#: A year of the test tables, for the queries over a range of dates.
YEAR = ("1997-01-01", "1997-12-31")


@query
def revenue_by_region_range(w: Workspace) -> DataFrame:
    """One year out of the date-partitioned layer."""
    return analytics.revenue_by_region(w.layer_tables().between(*YEAR))


@query
def payment_methods_range(w: Workspace) -> DataFrame:
    return analytics.payment_methods(w.layer_tables().between(*YEAR))


# -- loading and exporting ----------------------------------------------------
@query
def table_counts(w: Workspace) -> DataFrame:
    return tables.register_tables(w.spark, w.entries())


@query
def table_index(w: Workspace) -> DataFrame:
    index = report.export_tables(w.spark, w.entries(), w.fresh_path("export"))
    return index.drop("exported_at", "description")


@query
def exported_rows(w: Workspace) -> DataFrame:
    return report.exported_rows(report.export_tables(w.spark, w.entries(), w.fresh_path("export")))


@query
def report_manifest(w: Workspace) -> DataFrame:
    return report.write_report(
        w.spark, w.tables, analytics.REPORT_SHEETS, w.fresh_path("report"),
        limits={"Orders": 1000, "Payments Sample": 1000},
    )


@query
def export_orders(w: Workspace) -> DataFrame:
    return export.export_safe(w.tables.orders).drop("processed_at", "items")


@query
def export_payments(w: Workspace) -> DataFrame:
    return export.export_safe(w.tables.payments).drop("processed_at")


@query
def export_events(w: Workspace) -> DataFrame:
    return export.export_safe(w.tables.user_events).drop("processed_at")


@query
def export_lines_json(w: Workspace) -> DataFrame:
    """Nested values as JSON text: each line as a one-element items array."""
    lines = w.order_lines()
    nested = lines.select("order_id", F.array(F.struct("product_id", "quantity")).alias("items"))
    return export.export_safe(nested)


# -- line items as messages carry them ------------------------------------------
@query
def parse_order_items(w: Workspace) -> DataFrame:
    """Nested items out of the message text, one row per line."""
    return quality.explode_items(w.item_messages())


@query
def export_order_items(w: Workspace) -> DataFrame:
    """The nested column of parsed messages as JSON text."""
    pair = F.transform("items", lambda x: F.struct(x["product_id"].alias("product_id"), x["quantity"].alias("quantity")))
    return export.export_safe(w.item_messages().select("order_id", pair.alias("items")))


@query
def quality_item_lines(w: Workspace) -> DataFrame:
    return quality.line_check_counts(_all_orders(w), quality.explode_items(w.item_messages()))


@query
def quality_item_catalogue(w: Workspace) -> DataFrame:
    return quality.catalogue_check_counts(quality.explode_items(w.item_messages()), testdata.catalogue(w.spark, w.sf_dir))


# -- quality ------------------------------------------------------------------
def _all_orders(w: Workspace) -> DataFrame:
    """Raw orders, also those that cleaning drops, under their curated ids."""
    return w.raw("orders").withColumn("order_id", F.upper(F.trim("order_id")))


@query
def quality_line_checks(w: Workspace) -> DataFrame:
    return quality.line_checks(_all_orders(w), w.order_lines())


@query
def quality_line_totals(w: Workspace) -> DataFrame:
    return quality.line_check_counts(_all_orders(w), w.order_lines())


@query
def quality_amounts(w: Workspace) -> DataFrame:
    return quality.amount_check_counts(w.tables.orders)


@query
def quality_payment_reconciliation(w: Workspace) -> DataFrame:
    return quality.reconcile_payments(w.tables.orders, w.tables.payments)


@query
def quality_payment_reconciliation_counts(w: Workspace) -> DataFrame:
    return quality.reconcile_counts(w.tables.orders, w.tables.payments)


@query
def quality_line_checks_stored(w: Workspace) -> DataFrame:
    """The same check on storage by order id: its plan moves no row."""
    return w.by_order().line_checks()


@query
def quality_payment_reconciliation_stored(w: Workspace) -> DataFrame:
    return w.by_order().reconciliation()


@query
def quality_search_events(w: Workspace) -> DataFrame:
    return quality.search_check_counts(w.tables.user_events)


@query
def quality_unknown_places(w: Workspace) -> DataFrame:
    """Against the shop's own place list, which the test tables do not use."""
    return quality.unknown_places(w.tables.orders)


@query
def quality_unlisted_places(w: Workspace) -> DataFrame:
    """Against the places of one region, taken from the nation and region tables."""
    places = testdata.table(w.spark, w.sf_dir, "nation").join(
        testdata.table(w.spark, w.sf_dir, "region").filter("r_name = 'ASIA'"),
        F.col("n_regionkey") == F.col("r_regionkey"),
    )
    return quality.unknown_places(
        w.tables.orders, places.select(F.col("r_name").alias("region"), F.col("n_name").alias("city"))
    )


for _topic, _label in _TOPIC_LABEL.items():
    QUERIES[f"quality_domains_{_label}"] = lambda w, t=_topic: quality.domain_counts(w.tables[t], t)


def _delivered_twice(w: Workspace) -> DataFrame:
    """Payments as an at-least-once writer leaves them: failed ones arrived again."""
    payments = w.tables.payments.drop("processed_at")
    return payments.unionByName(payments.filter("not is_successful"))


@query
def quality_duplicate_ids(w: Workspace) -> DataFrame:
    return quality.duplicate_ids(_delivered_twice(w), "payment_id")


@query
def quality_deduplicated(w: Workspace) -> DataFrame:
    return quality.deduplicate(_delivered_twice(w), "payment_id")


@query
def quality_catalogue(w: Workspace) -> DataFrame:
    return quality.catalogue_check_counts(
        w.order_lines(), testdata.catalogue(w.spark, w.sf_dir)
    )


@query
def quality_shop_catalogue(w: Workspace) -> DataFrame:
    """Against the shop's own product list, which the test tables do not use."""
    return quality.catalogue_check_counts(w.order_lines())


# -- streaming ----------------------------------------------------------------
for _topic, _label in _TOPIC_LABEL.items():
    QUERIES[f"stream_raw_{_label}"] = lambda w, t=_topic: (
        layers.read_raw(w.spark, w.ingested(t), t).drop("json_str", *_UNCOMPARED)
    )
    QUERIES[f"stream_curated_{_label}"] = lambda w, t=_topic: (
        layers.read_curated(w.spark, w.ingested(t), t).drop(*_UNCOMPARED)
    )


@query
def stream_all_topics(w: Workspace) -> DataFrame:
    """What the three queries received, kept and dropped."""
    store = w.ingested()
    counts = [layers.batch_counts(w.spark, store, t) for t in schemas.TOPICS]
    per_batch = counts[0].unionByName(counts[1]).unionByName(counts[2])
    return per_batch.groupBy("topic").agg(
        F.sum("received").alias("received"), F.sum("clean").alias("clean"), F.sum("dropped").alias("dropped")
    )


for _topic, _label in _TOPIC_LABEL.items():
    QUERIES[f"stream_compacted_{_label}"] = lambda w, t=_topic: w.layer_tables()[t].drop(*_UNCOMPARED)


@query
def customer_history(w: Workspace) -> DataFrame:
    """All orders of the ten customers with the greatest revenue."""
    tables = w.layer_tables()
    return lookup.customer_history(tables, lookup.largest_customers(tables, 10))


@query
def region_premium_orders(w: Workspace) -> DataFrame:
    """The premium orders of the region with the greatest revenue."""
    tables = w.layer_tables()
    return lookup.region_orders(tables, lookup.largest_region(tables), schemas.VALUE_BANDS[0][0])


@query
def stream_topic_counts(w: Workspace) -> DataFrame:
    """Running message counts over all topics read as one stream."""
    for topic in schemas.TOPICS:
        w.envelope_folder(topic)
    everything = messages.read_envelope_files(
        w.spark, f"{w.root}/envelopes/*", w.spark.sparkContext.defaultParallelism
    )
    name = f"topic_counts_{uuid.uuid4().hex[:8]}"
    running = live.start_watch(
        live.topic_counts(everything), name, "memory", "complete", {"availableNow": True}
    )
    layers.await_all([running])
    return w.spark.table(name)


@query
def stream_deduplicated_payments(w: Workspace) -> DataFrame:
    """Payments of which many were delivered twice, repeats dropped as they arrived."""
    return _payload(stateful.read_unique(w.spark, w.unique_payments(), "payments"))


def _payload(records: DataFrame) -> DataFrame:
    return records.drop("processed_at", *[c for c in records.columns if c.startswith("kafka_")])


@query
def stream_reconciled_payments(w: Workspace) -> DataFrame:
    """Payments that met their orders on the way, and what stayed alone."""
    return stateful.read_reconciled(w.spark, w.reconciled_payments()).where(F.col("order_id") != HEARTBEAT)


@query
def drift_report_orders(w: Workspace) -> DataFrame:
    """Fields that order messages carry beyond the declared shape, their type and the first batch."""
    return drift.report(w.spark, w.drifting_orders(), "orders").drop("first_run")


@query
def drift_orders(w: Workspace) -> DataFrame:
    """Those fields, read from the compacted raw layer."""
    rows = drift.read_raw(w.spark, w.drifting_orders(), "orders")
    return rows.select("order_id", "num_items", "coupon", F.col("gift.note").alias("gift_note"), F.col("gift.wrap").alias("gift_wrap"))


for _topic, _label in _TOPIC_LABEL.items():
    QUERIES[f"watch_{_label}"] = lambda w, t=_topic: live.WATCH[t](w.raw(t))


@query
def watch_order_lines(w: Workspace) -> DataFrame:
    """The product text of orders, one line item per order record."""
    lines = w.order_lines()
    single = lines.select("order_id", F.array(F.struct("product_name", "quantity")).alias("items"))
    return single.select("order_id", live.items_label("items").alias("products"))


# -- warehouse ----------------------------------------------------------------
@query
def catalog_event_partitions(w: Workspace) -> DataFrame:
    return catalog.list_partitions(w.spark, w.warehouse("user_events"), "user_events")


@query
def catalog_event_columns(w: Workspace) -> DataFrame:
    return catalog.describe_table(w.spark, w.warehouse("user_events"), "user_events")


@query
def catalog_event_funnel(w: Workspace) -> DataFrame:
    """The event funnel in SQL over the warehouse's named table."""
    return w.spark.sql(
        f"""SELECT dt, event_type, COUNT(*) AS total_events, MIN(event_time) AS first_event
            FROM {w.warehouse('user_events')}.user_events GROUP BY dt, event_type"""
    )


@query
def catalog_daily_orders(w: Workspace) -> DataFrame:
    return w.spark.sql(
        f"""SELECT dt, COUNT(*) AS orders, MAX(final_amount) AS largest, MIN(order_timestamp) AS first_order
            FROM {w.warehouse('orders')}.orders GROUP BY dt"""
    )


@query
def catalog_daily_payments(w: Workspace) -> DataFrame:
    return w.spark.sql(
        f"""SELECT dt, payment_method, COUNT(*) AS payments, MAX(payment_timestamp) AS last_payment
            FROM {w.warehouse('payments')}.payments GROUP BY dt, payment_method"""
    )


@query
def catalog_daily_sales(w: Workspace) -> DataFrame:
    """The daily summary through its warehouse view."""
    return w.spark.table(f"{w.warehouse('daily_sales')}.daily_sales_summary")


@query
def catalog_customer_rfm(w: Workspace) -> DataFrame:
    return w.spark.table(f"{w.warehouse('customer_rfm')}.customer_rfm")


@query
def catalog_churn_candidates(w: Workspace) -> DataFrame:
    return w.spark.table(f"{w.warehouse('churn_candidates')}.churn_candidates")


@query
def catalog_payment_analysis(w: Workspace) -> DataFrame:
    return w.spark.table(f"{w.warehouse('payment_analysis')}.payment_analysis")


@query
def layer_inventory(w: Workspace) -> DataFrame:
    """Date folders of the compacted layers, and whether they hold files."""
    store, found = w.compacted(), []
    for topic in schemas.TOPICS:
        files = export.file_inventory(w.spark, f"{store.curated(topic)}/compacted")
        date = F.regexp_extract("folder", "/date=([^/]*)$", 1)
        dated = files.where(~F.col("folder").endswith(f"date={layers.UNDATED}"))
        found.append(dated.groupBy(F.lit(topic).alias("topic"), date.alias("date")).agg((F.sum("files") > 0).alias("holds_files")))
    return found[0].unionByName(found[1]).unionByName(found[2])


def build_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        name: (lambda spark, sf_dir, f=fn: f(Workspace(spark, sf_dir))) for name, fn in QUERIES.items()
    }
