"""The platform's jobs, over one root folder.

    python -m mercato.jobs ingest    --root R --servers broker:9092 [--unique '2 hours'] [--reconcile]
    python -m mercato.jobs recover   --root R
    python -m mercato.jobs watch     --root R --servers broker:9092 [--only orders …]
    python -m mercato.jobs verify    --root R
    python -m mercato.jobs nightly   --root R --as-of 2026-06-01 [--incremental]
    python -m mercato.jobs analyse   --root R [--only revenue_by_region …]
    python -m mercato.jobs report    --root R --out DIR
    python -m mercato.jobs export    --root R --out DIR
    python -m mercato.jobs compact   --root R [--search]
    python -m mercato.jobs tidy      --root R
    python -m mercato.jobs redate    --root R --pattern dd/MM/yyyy
    python -m mercato.jobs history   --root R --customers CUST00001 … [--out DIR]
    python -m mercato.jobs warehouse --root R --database shop

On a cluster: ``PYTHONPATH=. spark-submit <options> mercato/jobs.py <job> …``; executors
need no Python code of this package.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato import schemas
from mercato.plans import analytics, catalog, incremental, lookup, nightly, report
from mercato.plans.tables import Tables
from mercato.session import list_with_cores, pin_time_zone
from mercato.sources.envelope import parse_envelope, read_envelope_files, read_kafka
from mercato.sources.layout import LAYOUTS, Layout
from mercato.sources.snapshots import prune_snapshots, read_snapshot
from mercato.sources.tables import TableEntry, register_tables
from mercato.streaming import layers, live, stateful
from mercato.streaming.layers import Store

# The exported tables, their layer and sheet name.
EXPORTED = {
    "orders": ("curated", "Orders_Raw"),
    "payments": ("curated", "Payments_Raw"),
    "user_events": ("curated", "User_Events_Raw"),
    "customer_rfm": ("summaries", "Customer_RFM_Raw"),
    "churn_candidates": ("summaries", "Churn_Candidates_Raw"),
}


def stored_tables(spark: SparkSession, store: Store) -> Tables:
    """Curated layers and summary snapshots of a store, by name."""

    def load(name: str) -> DataFrame:
        if name in schemas.TOPICS:
            return layers.read_curated(spark, store, name)
        return read_snapshot(spark, store.summary(name))

    return Tables(load)


def table_entries(tables: Tables) -> list[TableEntry]:
    return [
        TableEntry(name, layer, lambda n=name: tables[n], sheet)
        for name, (layer, sheet) in EXPORTED.items()
    ]


def _source(spark: SparkSession, args: argparse.Namespace, *topics: str) -> DataFrame:
    """Messages of some topics: from brokers, or from files below ``--files``."""
    if args.files:
        folders = f"{args.files}/{{{','.join(topics)}}}"
        return read_envelope_files(spark, folders, args.max_files)
    return read_kafka(spark, topics, args.servers, max_per_trigger=args.max_messages)


def _trigger(args: argparse.Namespace) -> dict:
    return {"availableNow": True} if args.once else {"processingTime": "10 seconds"}


def ingest(spark: SparkSession, store: Store, args: argparse.Namespace) -> None:
    """Run the three topics until stopped, or with ``--once`` until all input is read.

    An existing warehouse shows each batch once it is written. ``--unique`` also keeps layers without
    repeated deliveries, ``--reconcile`` lets payments meet their orders on the way.
    """

    def tell(topic: str, batch_id: int, counts: dict[str, int]) -> None:
        print(f"{topic} batch {batch_id}: {counts['received']} in, {counts['clean']} clean, "
              f"{counts['dropped']} dropped", flush=True)
        if counts["clean"] and spark.catalog.databaseExists(args.database):
            catalog.refresh_topic(spark, args.database, topic, store)

    source = lambda topic: _source(spark, args, topic)
    if args.unique or args.reconcile:
        stateful.state_on_disk(spark)
    queries = layers.start_all(source, store, trigger=_trigger(args), report=tell, tasks=args.tasks)
    if args.unique:
        for name, topic in layers.TOPICS.items():
            queries.append(stateful.start_unique(source(name), topic, store, args.unique, _trigger(args)))
    if args.reconcile:
        queries.append(stateful.start_reconciliation(source, store, _trigger(args)))
    layers.await_all(queries)


def recover(spark: SparkSession, store: Store, args: argparse.Namespace) -> None:
    """Bring records that came too late for the unique layers into them."""
    for name, topic in layers.TOPICS.items():
        print(f"{name}: {stateful.recover_late(spark, store, topic)} recovered", flush=True)


def watch(spark: SparkSession, store: Store, args: argparse.Namespace) -> None:
    """Show messages as they arrive, and the running count of each topic; stores nothing."""
    topics = args.only or list(schemas.TOPICS)
    queries = [
        live.start_watch(
            live.WATCH[t](parse_envelope(_source(spark, args, t), layers.TOPICS[t].record)),
            f"watch_{t}", trigger=_trigger(args),
        )
        for t in topics
    ]
    counts = live.topic_counts(_source(spark, args, *topics))
    queries.append(live.start_watch(counts, "watch_counts", mode="complete", trigger=_trigger(args)))
    layers.await_all(queries)


def verify(spark: SparkSession, store: Store, args: argparse.Namespace) -> None:
    """Row counts, a few rows and a breakdown of each curated table."""
    tables = stored_tables(spark, store)
    found = register_tables(spark, table_entries(tables))
    found.show(truncate=False)
    available = {r["table_name"] for r in found.collect() if r["available"]}
    for topic, sample, counts in (
        ("orders", analytics.check_orders_sample, analytics.check_value_segments),
        ("payments", analytics.check_payments_sample, analytics.check_payment_methods),
        ("user_events", analytics.check_events_sample, analytics.check_event_types),
    ):
        if topic in available:
            sample(tables).show(truncate=False)
            counts(tables).show(10, truncate=False)


def run_nightly(spark: SparkSession, store: Store, args: argparse.Namespace) -> None:
    """All four summaries from the whole layers, or with ``--incremental`` from what is new."""
    if args.incremental:
        incremental.run(spark, store, args.as_of, args.buckets, args.rebuild).show(truncate=False)
        catalog.refresh_warehouse(spark, args.database, store)
        return
    tables = stored_tables(spark, store)
    nightly.run_nightly(spark, tables, store, args.as_of, args.dates, args.compat).show(truncate=False)
    catalog.refresh_warehouse(spark, args.database, store)


def analyse(spark: SparkSession, store: Store, args: argparse.Namespace) -> None:
    """Show analyses; one that lacks its table is reported and the others go on."""
    tables = stored_tables(spark, store)
    for name in args.only or analytics.ANALYSES:
        print(name, flush=True)
        try:
            analytics.ANALYSES[name](tables).show(truncate=False)
        except Exception as problem:  # a missing table, or a failed task
            print(f"skipped: {problem}", flush=True)


def write_report(spark: SparkSession, store: Store, args: argparse.Namespace) -> None:
    tables = stored_tables(spark, store)
    report.write_report(spark, tables, analytics.REPORT_SHEETS, args.out).show(truncate=False)


def export(spark: SparkSession, store: Store, args: argparse.Namespace) -> None:
    index = report.export_tables(spark, table_entries(stored_tables(spark, store)), args.out)
    index.show(truncate=False)
    report.exported_rows(index).show()


def _layout(args: argparse.Namespace, topic: str) -> Layout | None:
    return LAYOUTS[topic] if args.search else None


def compact(spark: SparkSession, store: Store, args: argparse.Namespace) -> None:
    """Rewrite closed batches; the newest batch of a run may still be replayed and stays."""
    for topic in layers.TOPICS.values():
        layers.compact(spark, store.raw(topic.name), topic.raw, open_batches=1, by_date=False)
        layers.compact(spark, store.curated(topic.name), topic.curated, open_batches=1, layout=_layout(args, topic.name))
        layers.fold_counts(spark, store, topic.name)
    catalog.refresh_warehouse(spark, args.database, store)


def history(spark: SparkSession, store: Store, args: argparse.Namespace) -> None:
    """All orders of some customers, shown or written to a folder."""
    found = lookup.customer_history(stored_tables(spark, store), args.customers)
    if args.out:
        found.write.mode("overwrite").parquet(args.out)
    else:
        found.show(1000, truncate=False)


def tidy(spark: SparkSession, store: Store, args: argparse.Namespace) -> None:
    """Delete batches that compaction has rewritten, and summary versions before the last two.

    Run it when no reader can still be on them. The warehouse moves to what stays first.
    """
    catalog.refresh_warehouse(spark, args.database, store)
    for topic in schemas.TOPICS:
        for layer in (store.raw(topic), store.curated(topic)):
            print(f"{layer}: {layers.drop_covered_batches(spark, layer)} batches dropped", flush=True)
    for summary in catalog.SUMMARY_VIEWS:
        print(f"{summary}: {prune_snapshots(spark, store.summary(summary))} versions dropped", flush=True)


def redate(spark: SparkSession, store: Store, args: argparse.Namespace) -> None:
    """Give compacted rows without a date the one that their text has in another pattern."""
    rule = F.date_format(F.try_to_timestamp("date_text", F.lit(args.pattern)), "yyyy-MM-dd")
    for name, topic in layers.TOPICS.items():
        moved = layers.redate(spark, store.curated(name), topic.curated, rule, _layout(args, name))
        print(f"{name}: {sum(moved.values())} rows dated", flush=True)
    catalog.refresh_warehouse(spark, args.database, store)


def warehouse(spark: SparkSession, store: Store, args: argparse.Namespace) -> None:
    catalog.create_warehouse(spark, args.database, store)
    catalog.list_tables(spark, args.database).show(truncate=False)


JOBS: dict[str, Callable[[SparkSession, Store, argparse.Namespace], None]] = {
    "ingest": ingest, "recover": recover, "watch": watch, "verify": verify, "nightly": run_nightly, "analyse": analyse,
    "report": write_report, "export": export, "compact": compact, "tidy": tidy,
    "redate": redate, "history": history, "warehouse": warehouse,
}


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="mercato")
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--root", required=True, help="folder of the layers and summaries")
    parser.add_argument("--servers", default="localhost:9092", help="brokers to ingest from")
    parser.add_argument("--files", help="ingest envelope files below this folder instead")
    parser.add_argument("--max-messages", type=int, help="messages per batch from brokers; all there are if not given")
    parser.add_argument("--max-files", type=int, help="envelope files per batch; all there are if not given")
    parser.add_argument("--tasks", type=int, help="write each batch by date with so many tasks (backfills)")
    parser.add_argument("--once", action="store_true", help="ingest what is there, then stop")
    parser.add_argument("--as-of", help="date the nightly summaries are for")
    parser.add_argument("--dates", nargs="*", help="recompute only these days of the daily summaries")
    parser.add_argument("--compat", action="store_true", help="historic reading of the scoring rules")
    parser.add_argument("--unique", help="keep layers without deliveries repeated within this time, such as '2 hours'")
    parser.add_argument("--reconcile", action="store_true", help="let payments meet their orders while ingesting")
    parser.add_argument("--incremental", action="store_true", help="nightly: fold in what is new only")
    parser.add_argument("--buckets", type=int, help="buckets of the stored customer totals, when they begin")
    parser.add_argument("--rebuild", action="store_true", help="nightly --incremental: start over from the whole layers")
    parser.add_argument("--search", action="store_true", help="compact, redate: store rows so that few of them are found quickly")
    parser.add_argument("--customers", nargs="+", help="ids of the customers to show the history of")
    parser.add_argument("--pattern", help="redate: pattern of the date texts, such as dd/MM/yyyy")
    parser.add_argument("--only", nargs="*", help="names of the analyses, or topics, to show")
    parser.add_argument("--out", help="folder for a report or export")
    parser.add_argument("--database", default="shop")
    args = parser.parse_args(arguments)
    for job, option in (("nightly", "as_of"), ("report", "out"), ("export", "out"), ("redate", "pattern"), ("history", "customers")):
        if args.job == job and getattr(args, option) is None:
            parser.error(f"{job} needs --{option.replace('_', '-')}")
    return args


def main(arguments: list[str] | None = None) -> None:
    args = parse(arguments)
    spark = list_with_cores(pin_time_zone(SparkSession.builder.appName(f"mercato-{args.job}").getOrCreate()))
    JOBS[args.job](spark, Store(args.root.rstrip("/")), args)


if __name__ == "__main__":
    main()
