"""The platform's layers over one set of test tables, each built once per application.

Analyses read a stored curated layer, as they do in production; the first query that
needs a table writes it to the shared folder, from the whole test tables, and later ones
read it column by column. The folder carries the application id, so nothing is reused
from an earlier run.
"""

from __future__ import annotations

import hashlib
import threading
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato import schemas
from mercato.jobs import table_entries
from mercato.operators import quality
from mercato.operators.cleaning import CLEAN
from mercato.operators.customers import customer_metrics
from mercato.plans import catalog, incremental, integrity, nightly, summaries
from mercato.plans.tables import Tables
from mercato.session import STORED, list_with_cores, pin_time_zone, shared_folder
from mercato.sources import testdata
from mercato.sources.envelope import parse_envelope, read_envelope_files, to_envelope
from mercato.sources.files import Files
from mercato.sources.layout import LAYOUTS
from mercato.sources.tables import TableEntry
from mercato.streaming import drift, layers, stateful

AS_OF = "2001-08-02"  # the day after the last order in the test tables
#: Arrival times at which a new landing of messages begins; what has none lands first.
LANDINGS = {
    "orders": ["1997-01-01", "1999-01-01", "2001-01-01"],
    "payments": ["1997-01-01", "1999-01-01", "2001-01-01"],
    "user_events": ["2024-01-09", "2024-01-17", "2024-01-25"],
}
#: Layers that are compacted for searches, too; the others show the plain way.
SEARCHED = {"orders": LAYOUTS["orders"]}
#: A pair of messages far behind all others, which lets a watermark pass those.
HEARTBEAT, LAST_TIME = "HEARTBEAT", "2100-01-01T00:00:00"
#: Orders that a batch of the reconciliation takes; they and their payments wait as state in the executors' memory.
BATCH_ROWS = 2_000_000
#: Files that a batch takes per core.
BATCH_FILES = 4

_written: dict[str, T.StructType] = {}
_writing = threading.RLock()  # callers may run queries side by side


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = list_with_cores(pin_time_zone(spark))
        self.sf_dir = sf_dir
        tag = hashlib.sha1(sf_dir.rstrip("/").encode()).hexdigest()[:10]
        self.tag = f"{spark.sparkContext.applicationId.replace('-', '_')}_{tag}"
        self.root = f"{shared_folder(spark)}/mercato/{self.tag}"
        self.tables = Tables(self._load)

    def stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        path = f"{self.root}/{name}"
        with _writing:
            if not self._is_written(path):
                df = build()
                df.write.mode("overwrite").options(**STORED).parquet(path)
                _written[path] = df.schema
        return self.spark.read.schema(_written[path]).parquet(path)

    def _is_written(self, path: str) -> bool:
        return path in _written and Files(self.spark).exists(path)

    def _load(self, name: str) -> DataFrame:
        if name in CLEAN:
            return self.stored(name, lambda: CLEAN[name](self._records(name)))
        if name == "customer_metrics":
            return self.stored(name, lambda: customer_metrics(self.tables.orders, AS_OF))
        if name == "customer_rfm":
            return self.stored(
                name, lambda: summaries.score_customers(self.tables.customer_metrics, AS_OF)
            )
        if name == "churn_candidates":
            return self.stored(
                name, lambda: summaries.churn_from_metrics(self.tables.customer_metrics, AS_OF)
            )
        raise FileNotFoundError(name)

    def raw(self, topic: str) -> DataFrame:
        """The topic's records as the raw layer holds them."""
        return self.stored(f"raw_{topic}", lambda: testdata.RAW[topic](self.spark, self.sf_dir))

    def _records(self, topic: str) -> DataFrame:
        """The same records, read from the raw layer only if that is stored: who reads a curated table alone
        needs no second copy of all rows."""
        if self._is_written(f"{self.root}/raw_{topic}"):
            return self.raw(topic)
        return testdata.RAW[topic](self.spark, self.sf_dir)

    def _curated(self, topic: str) -> DataFrame:
        """The same records cleaned, read from the curated table only if that is stored."""
        return self.tables[topic] if self._is_written(f"{self.root}/{topic}") else CLEAN[topic](self._records(topic))

    def order_lines(self) -> DataFrame:
        return self.stored("order_lines", lambda: testdata.order_lines(self.spark, self.sf_dir))

    def messages(self, topic: str) -> DataFrame:
        """The topic's stored messages, read as a batch."""
        return self.spark.read.schema(schemas.ENVELOPE).parquet(self.envelope_folder(topic))

    def entries(self) -> list[TableEntry]:
        return table_entries(self.tables)

    # -- streaming ------------------------------------------------------------
    def envelope_folder(self, topic: str) -> str:
        """A topic's messages as files in arrival order."""
        folder = f"{self.root}/envelopes/{topic}"
        with _writing:
            if not self._is_written(folder):
                arrived = self._records(topic).repartitionByRange("kafka_timestamp", "kafka_offset")
                messages = testdata.envelope(arrived, topic)
                messages.write.mode("overwrite").options(**STORED).parquet(folder)
                _written[folder] = messages.schema
        return folder

    def fresh_path(self, label: str) -> str:
        return f"{self.root}/fresh/{label}-{uuid.uuid4().hex}"

    def fresh_store(self) -> layers.Store:
        return layers.Store(self.fresh_path("store"))

    def ingest(self, store: layers.Store, topics: list[str]) -> None:
        """Stream all messages of the topics through to both layers, then stop.

        A micro-batch takes one file per core and is written by as many tasks, so both
        follow the size of the cluster.
        """
        cores = self.spark.sparkContext.defaultParallelism
        queries = layers.start_all(
            lambda t: read_envelope_files(self.spark, self.envelope_folder(t), cores),
            store,
            topics,
            {"availableNow": True},
            tasks=cores,
        )
        layers.await_all(queries)

    def compacted(self, *topics: str) -> layers.Store:
        """The same store after one compaction of all batches of these topics (all, if none are named);
        nothing is deleted."""
        with _writing:
            for name in topics or schemas.TOPICS:  # each to its end, so that no two hold what they work with at once
                store = self.ingested(name)
                done, topic = f"{store.root}#compacted/{name}", layers.TOPICS[name]
                if done not in _written:
                    layers.compact(self.spark, store.raw(name), topic.raw, by_date=False)
                    layers.compact(self.spark, store.curated(name), topic.curated, layout=SEARCHED.get(name))
                    _written[done] = T.StructType()
        return store

    def layer_tables(self) -> Tables:
        """The curated layers as production has them: date folders, compacted. Customers' metrics are those
        of that layer's orders, so no other copy of the orders is made for them."""

        def load(name: str) -> DataFrame:
            if name in CLEAN:
                return layers.read_curated(self.spark, self.compacted(name), name)
            if name == "customer_metrics" and not self._is_written(f"{self.root}/{name}"):
                return self.stored(name, lambda: customer_metrics(load("orders"), AS_OF))
            return self._load(name)

        return Tables(load)

    def warehouse(self, *names: str) -> str:
        """Name of the warehouse database. It shows these topics of that store and these nightly summaries
        (all, if none are named), each made when first asked for."""
        database = f"shop_{self.tag}"
        with _writing:
            for name in names or (*schemas.TOPICS, *catalog.SUMMARY_VIEWS):
                done = f"{self.root}/streamed#warehouse/{name}"
                if done in _written:
                    continue
                if name in schemas.TOPICS:
                    catalog.create_warehouse(self.spark, database, self.compacted(name), (name,))
                else:
                    catalog.create_warehouse(self.spark, database, self._summaries("payments" if name == "payment_analysis" else "orders"), ())
                _written[done] = T.StructType()
        return database

    def _summaries(self, topic: str) -> layers.Store:
        """The same store after a nightly run over this topic."""
        store = layers.Store(f"{self.root}/streamed")
        done, rows = f"{store.root}#summaries/{topic}", self.tables[topic]  # stored before the steps ask side by side

        def load(name: str) -> DataFrame:
            if name != topic:
                raise FileNotFoundError(name)
            return rows

        if done not in _written:
            nightly.run_nightly(self.spark, Tables(load), store, AS_OF)
            _written[done] = T.StructType()
        return store

    def warehouse_tables(self) -> Tables:
        return Tables(lambda name: catalog.warehouse_table(self.spark, self.warehouse(name), name))

    def item_messages(self) -> DataFrame:
        """Each line as an order message whose ``items`` array has that line; of the stored messages only
        the fields asked for are parsed."""
        lines = self.order_lines()
        item = F.struct(*[c for c in lines.columns if c != "order_id"])
        orders = lines.select("order_id", F.array(item).alias("items"))
        messages = self.stored("item_messages", lambda: to_envelope(orders, "orders", "order_id", orders.columns))
        return parse_envelope(messages, f"order_id string, items array<struct<{schemas.LINE_ITEM}>>", keep_source=False)

    def ingested(self, *topics: str) -> layers.Store:
        """The layers of these topics (all, if none are named), streamed side by side, each once per application."""
        store = layers.Store(f"{self.root}/streamed")
        with _writing:
            new = [t for t in topics or schemas.TOPICS if not self._is_written(store.raw(t))]
            for topic in new:
                self.envelope_folder(topic)
            if new:
                self.ingest(store, new)
                _written.update({store.raw(t): T.StructType() for t in new})
        return store

    # -- messages landing part by part -------------------------------------------
    def landing(self, folder: str, topic: str, messages: DataFrame, number: int, late: Column | None = None) -> None:
        """Add the landing of this number to a topic's folder: messages between two arrival times, and
        with the last one those that are ``late``."""
        number_of = self._landing_of(topic)
        if late is not None:
            number_of = F.when(late, len(LANDINGS[topic])).otherwise(number_of)
        messages.where(number_of == number).write.mode("append").options(**STORED).parquet(f"{folder}/{topic}")

    def _landing_of(self, topic: str) -> Column:
        later = [F.col("timestamp") >= F.lit(t).cast("timestamp") for t in LANDINGS[topic]]
        return sum((F.coalesce(x, F.lit(False)).cast("int") for x in later), F.lit(0))

    def _send(self, topic: str, records: DataFrame, files: int) -> str:
        """Folder of messages that are still to land: a folder per landing, its files in order of arrival."""
        folder = f"{self.root}/sent/{topic}"
        arrived = records.repartitionByRange(files, "kafka_timestamp", "kafka_partition", "kafka_offset")
        messages = testdata.envelope(arrived, topic).withColumn("landing", self._landing_of(topic))
        messages.write.mode("overwrite").options(**STORED).partitionBy("landing").parquet(folder)
        return folder

    def _land(self, sent: str, folder: str, number: int) -> bool:
        """Move the files of one landing to a stream's folder; whether the stream will see them in order of
        arrival, which it tells by the time of their last change."""
        files, now = Files(self.spark), int(time.time() * 1000)
        names = [n for n in files.names(f"{sent}/landing={number}") if n.endswith(".parquet")]
        kept = [files.move(f"{sent}/landing={number}/{n}", f"{folder}/{number}-{n}", now + i) for i, n in enumerate(names)]
        return all(kept)

    def delivered(self, topic: str) -> DataFrame:
        """A topic's valid records, each id once, to be delivered as messages."""
        columns = {
            "orders": ["order_id", "kafka_timestamp", "customer_id", "final_amount", "num_items", "timestamp", "date"],
            "payments": [c.split()[0] for c in schemas.PAYMENT.split(", ")] + ["kafka_timestamp"],
        }[topic]
        rows = self._curated(topic).select(*columns, "kafka_topic", "kafka_partition", "kafka_offset")
        amount = "final_amount" if topic == "orders" else "amount"  # rounded to nothing, but valid as it was sent
        sent = F.greatest(F.col(amount), F.lit(0.001))
        return quality.deduplicate(rows, layers.TOPICS[topic].key).withColumn(amount, sent)

    def unique_payments(self) -> layers.Store:
        """A store whose payments arrived in four landings, the query stopped after each.

        Failed payments are delivered again 20 days later, so many copies fall into a later landing.
        """
        store = layers.Store(f"{self.root}/unique")
        with _writing:
            if not self._is_written(store.root):
                first = self.delivered("payments")
                again = first.where("status <> 'SUCCESS'").withColumns(
                    {"kafka_timestamp": F.expr("kafka_timestamp + INTERVAL 20 DAYS"), "kafka_offset": F.col("kafka_offset") + 10**9}
                )
                messages = self.stored("deliveries", lambda: testdata.envelope(first.unionByName(again), "payments"))
                folder = f"{self.root}/landed_unique"
                for number in range(len(LANDINGS["payments"]) + 1):
                    self.landing(folder, "payments", messages, number)
                    source = read_envelope_files(self.spark, f"{folder}/payments")
                    topic = layers.TOPICS["payments"]
                    layers.await_all([stateful.start_unique(source, topic, store, "60 days", {"availableNow": True})])
                _written[store.root] = T.StructType()
        return store

    def reconciled_payments(self) -> layers.Store:
        """A store in which payments met their orders over four landings, the query stopped after each.

        Some payments never come, some come three days after their order, some are one unit off; some
        orders never come, some come twice. A last pair of messages moves both watermarks on. A landing is
        read in batches of about ``BATCH_ROWS`` in order of arrival, so what waits as state is a batch and
        the days before it, not a landing of years; where files keep no order, it is one batch.
        """
        store = layers.Store(f"{self.root}/reconciled_store")
        with _writing:
            if not self._is_written(store.root):
                cores = self.spark.sparkContext.defaultParallelism
                orders = testdata.table(self.spark, self.sf_dir, "orders").count()
                at_once = BATCH_FILES * cores
                files = at_once * max(1, -(-orders // BATCH_ROWS))  # as many of both, so that both streams keep step
                sent = {"orders": self._sent_orders(), "payments": self._sent_payments()}
                sent = {t: self._send(t, rows, files) for t, rows in sent.items()}
                folder = f"{self.root}/landed_reconciled"
                for number in range(len(LANDINGS["orders"]) + 1):
                    ordered = all([self._land(path, f"{folder}/{t}", number) for t, path in sent.items()])
                    source = lambda t: read_envelope_files(self.spark, f"{folder}/{t}", at_once if ordered else None)
                    layers.await_all([stateful.start_reconciliation(source, store, {"availableNow": True}, tasks=cores)])
                _written[store.root] = T.StructType()
        return store

    def nightly_runs(self, topic: str) -> layers.Store:
        """A store of this topic after four landings, each streamed in and followed by an incremental nightly run.

        Every 97th message lands with the last, whatever its day. After two of the runs the layer is compacted
        and the batches that a generation holds deleted. Topics share no state, so each has its runs by itself.
        """
        store = layers.Store(f"{self.root}/nightly/{topic}")
        with _writing:
            if not self._is_written(store.root):
                folder = f"{self.root}/landed_nightly"
                late = F.regexp_extract(F.col("key").cast("string"), "([0-9]+)", 1).cast("bigint") % 97 == 0
                for number, as_of in enumerate([*LANDINGS["orders"], AS_OF]):
                    self.landing(folder, topic, self.messages(topic), number, late)
                    source = lambda t: read_envelope_files(self.spark, f"{folder}/{t}")
                    cores = self.spark.sparkContext.defaultParallelism
                    layers.await_all(layers.start_all(source, store, [topic], {"availableNow": True}, tasks=cores))
                    incremental.run(self.spark, store, as_of)
                    if number in (0, 2):
                        layers.compact(self.spark, store.curated(topic), layers.TOPICS[topic].curated)
                        layers.drop_covered_batches(self.spark, store.curated(topic))
                _written[store.root] = T.StructType()
        return store

    def drifting_orders(self) -> layers.Store:
        """A store whose orders, from the second landing on, carry fields that nobody declared and some too
        large a number; compacted and tidied, with the last landing still open."""
        store = layers.Store(f"{self.root}/drifting")
        with _writing:
            if not self._is_written(store.root):
                raw, number = self.raw("orders"), F.regexp_extract("order_id", "([0-9]+)", 1).cast("bigint")
                late = lambda n: F.coalesce(F.col("kafka_timestamp") >= F.lit(LANDINGS["orders"][n]).cast("timestamp"), F.lit(False))
                gift = F.struct(F.format_string("n%d", number).alias("note"), (number % 2 == 0).alias("wrap"))
                sent = raw.withColumns(
                    {
                        "num_items": F.when((number % 31 == 0) & late(0), number + 3_000_000_000).otherwise(F.col("num_items")),
                        "coupon": F.when((number % 29 == 0) & late(0), F.format_string("C%d", number)),
                        "gift": F.when((number % 37 == 0) & late(1), gift),
                    }
                )
                messages = self.stored("sent_drifting", lambda: testdata.envelope(sent, "orders"))
                folder, topic = f"{self.root}/landed_drifting", layers.TOPICS["orders"]
                for landing in range(len(LANDINGS["orders"]) + 1):
                    self.landing(folder, "orders", messages, landing)
                    source = read_envelope_files(self.spark, f"{folder}/orders")
                    cores = self.spark.sparkContext.defaultParallelism  # a landing holds the dates of years
                    layers.await_all([layers.start_topic(source, topic, store, {"availableNow": True}, tasks=cores, note=drift.noted_schema)])
                layers.compact(self.spark, store.raw("orders"), topic.raw, open_batches=1, by_date=False)
                layers.drop_covered_batches(self.spark, store.raw("orders"))
                _written[store.root] = T.StructType()
        return store

    def by_order(self) -> integrity.ByOrder:
        """Orders, payments and lines stored by order id, each added in two runs."""
        tables = integrity.ByOrder(self.spark, layers.Store(f"{self.root}/stored"), self.spark.sparkContext.defaultParallelism)
        with _writing:
            done = f"{tables.store.root}/by_order"
            if not self._is_written(done):
                tables.forget()
                raw = self.raw("orders").withColumn("order_id", F.upper(F.trim("order_id")))
                early, order_lines = F.coalesce(F.col("kafka_timestamp") < F.lit(LANDINGS["orders"][1]).cast("timestamp"), F.lit(True)), self.order_lines()
                half = F.pmod(F.xxhash64("product_id"), F.lit(2)) == 0  # so that lines of an order come in both
                for run, (part, lines) in enumerate(((early, half), (~early, ~half)), 1):
                    tables.add_orders(raw.where(part), run)
                    tables.add_lines(order_lines.where(lines), run)
                    tables.add_sides(self.tables.orders.where(part), self.tables.payments.where(part), run)
                _written[done] = T.StructType()
        return tables

    def _sent_orders(self) -> DataFrame:
        orders = self.delivered("orders").where("cast(substr(order_id, 4) AS bigint) % 19 <> 0")
        twice = F.expr("timestamp IS NOT NULL AND cast(substr(order_id, 4) AS bigint) % 5 = 0")
        again = F.explode(F.when(twice, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False))))
        sent = orders.withColumn("again", again).withColumns(
            {
                "kafka_timestamp": F.when(F.col("again"), F.expr("kafka_timestamp + INTERVAL 6 HOURS")).otherwise(F.col("kafka_timestamp")),
                "kafka_offset": F.when(F.col("again"), F.col("kafka_offset") + 10**9).otherwise(F.col("kafka_offset")),
            }
        )
        return sent.drop("again").unionByName(self._heartbeat(orders))

    def _sent_payments(self) -> DataFrame:
        number = F.expr("cast(substr(order_id, 4) AS bigint)")
        late = number % 13 == 0
        after = F.expr("cast(timestamp AS timestamp) + INTERVAL 3 DAYS")
        payments = self.delivered("payments").where(number % 11 != 0).withColumns(
            {
                "timestamp": F.when(late, F.date_format(after, testdata.ISO_SECONDS)).otherwise(F.col("timestamp")),
                "date": F.when(late, F.date_format(after, "yyyy-MM-dd")).otherwise(F.col("date")),
                "kafka_timestamp": F.when(late, F.expr("kafka_timestamp + INTERVAL 3 DAYS")).otherwise(F.col("kafka_timestamp")),
                "amount": F.when(number % 17 == 0, F.round(F.col("amount") + 1, 2)).otherwise(F.col("amount")),
            }
        )
        return payments.unionByName(self._heartbeat(payments))

    def _heartbeat(self, like: DataFrame) -> DataFrame:
        values = {
            "order_id": HEARTBEAT, "payment_id": HEARTBEAT, "customer_id": HEARTBEAT, "num_items": 1, "final_amount": 1.0,
            "amount": 1.0, "timestamp": LAST_TIME, "date": LAST_TIME[:10], "kafka_timestamp": LAST_TIME,
        }
        row = [F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in like.schema]
        return self.spark.range(1).select(*row)

    def release(self) -> None:
        """Delete everything stored here; later queries build it anew."""
        Files(self.spark).delete(self.root)
        for path in [p for p in _written if p.startswith(self.root)]:
            del _written[path]
