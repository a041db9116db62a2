"""Topics to raw and curated layers.

Each micro-batch owns one folder per layer, named by the life of its checkpoint (``run``)
and its batch number, and overwrites exactly that folder. A replayed batch therefore
replaces its earlier attempt, in each layer by itself. Layout below a layer's folder::

    batches/run=<run>/batch_id=<n>/…            raw
    batches/run=<run>/batch_id=<n>/date=<d>/…   curated
    compacted/generation=<g>/date=<d>/…         closed batches, rewritten in few files
    covered/<g>                                 which batches generations up to g hold, and which
                                                of their folders a later generation has rewritten

Beside the layers, ``metrics/<topic>/batch/run=<run>-<n>.json`` has each batch's counts, replaced
with its batch; compaction folds them into ``metrics/<topic>/folded``.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from mercato import schemas
from mercato.operators.cleaning import CLEAN, is_valid
from mercato.session import STORED
from mercato.sources.envelope import parse_envelope
from mercato.sources.files import Files
from mercato.sources.layout import Layout


@dataclass(frozen=True)
class Topic:
    """What one topic carries and how its records are curated."""

    name: str
    record: str
    curated: str
    key: str
    clean: Callable[..., DataFrame]

    @property
    def raw(self) -> str:
        return f"{self.record}, {schemas.KAFKA_COLUMNS}, json_str string"


TOPICS = {
    "orders": Topic("orders", schemas.ORDER, schemas.CURATED_ORDERS, "order_id", CLEAN["orders"]),
    "payments": Topic("payments", schemas.PAYMENT, schemas.CURATED_PAYMENTS, "payment_id", CLEAN["payments"]),
    "user_events": Topic("user_events", schemas.USER_EVENT, schemas.CURATED_EVENTS, "event_id", CLEAN["user_events"]),
}


@dataclass(frozen=True)
class Store:
    """Folders of a platform below one root."""

    root: str

    def raw(self, topic: str) -> str:
        return f"{self.root}/raw/{topic}"

    def curated(self, topic: str) -> str:
        return f"{self.root}/curated/{topic}"

    def summary(self, name: str) -> str:
        return f"{self.root}/summaries/{name}"

    def unique(self, topic: str) -> str:
        return f"{self.root}/unique/{topic}"

    def reconciled(self) -> str:
        return f"{self.root}/reconciled"

    def metrics(self, topic: str) -> str:
        return f"{self.root}/metrics/{topic}"

    def checkpoint(self, topic: str) -> str:
        return f"{self.root}/checkpoints/{topic}"


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """Name of this checkpoint's life, kept beside it: batch numbers restart without it."""
    files, marker = Files(spark), f"{checkpoint}-run"
    if not files.exists(checkpoint) or not files.exists(marker):
        files.delete(marker)
        files.publish_text(marker, uuid.uuid4().hex[:12])
    return files.read_text(marker)


def batch_folder(layer: str, run: str, batch_id: int) -> str:
    return f"{layer}/batches/run={run}/batch_id={batch_id}"


#: Folder of rows whose date is none: one, however many texts producers send.
UNDATED = "undated"


def is_date(column: str = "date") -> Column:
    """An ISO date that the calendar has; never null."""
    text = F.col(column)
    return F.coalesce(text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & text.try_cast("date").isNotNull(), F.lit(False))


def into_partitions(rows: DataFrame) -> DataFrame:
    """Rows as they are stored by date: what is no date goes to ``UNDATED`` and keeps its text beside it."""
    return rows.withColumns(
        {"date": F.when(is_date(), F.col("date")).otherwise(UNDATED), "date_text": F.when(~is_date(), F.col("date"))}
    )


def out_of_partitions(rows: DataFrame) -> DataFrame:
    """The same rows with the dates they came with. A filter on ``date`` still prunes the folders of dates."""
    undated = F.coalesce(F.col("date") == UNDATED, F.lit(False))
    own = rows.where(undated).withColumn("date", F.col("date_text"))
    return rows.where(~undated).unionByName(own).drop("date_text")


def write_rows(rows: DataFrame, folder: str, by_date: bool) -> None:
    """Put the rows in exactly this folder, with a folder per date below."""
    writer = (into_partitions(rows) if by_date else rows).write.mode("overwrite").options(partitionOverwriteMode="static", **STORED)
    (writer.partitionBy("date") if by_date else writer).parquet(folder)


def scan_batch(spark: SparkSession, folder: str, ddl: str) -> DataFrame:
    return spark.read.schema(ddl).parquet(folder)


#: Slices of a task's share of a date that is dealt out: the more, the more even.
SLICES = 8


def dealt_by_date(rows: DataFrame, tasks: int, count: int) -> DataFrame:
    """So many rows dealt out over the tasks by the folder they go to, whether it gets one row or many,
    as a small file costs more than its rows. A folder that gets more rows than a task's share is dealt
    out by offset, too; there are fewer of these than tasks. Reads the rows once more to find them.

    Rows that lie so already, as those of messages in order of arrival do, stay where they are: when tasks
    share hardly more folders than they have ends, and none has much more than its share of the rows."""
    folder, share = F.when(is_date(), F.col("date")).otherwise(UNDATED), max(1, -(-count // tasks))
    parts = rows.groupBy(folder.alias("folder"), F.spark_partition_id().alias("task")).count()
    sums = parts.groupingSets([["folder"], ["task"]], "folder", "task").agg(F.sum("count").alias("rows"), F.count("*").alias("parts"))
    of_folder = F.col("task").isNull()
    lie = sums.agg(
        F.max(F.when(~of_folder, F.col("rows"))).alias("busiest"), F.count_if(of_folder).alias("folders"),
        F.sum(F.when(of_folder, F.col("parts"))).alias("files"),
        F.collect_list(F.when(of_folder & (F.col("rows") > share), F.struct("folder", "rows"))).alias("large"),
    ).first()
    if not lie["folders"] or (lie["files"] <= lie["folders"] + tasks and lie["busiest"] <= 2 * share):
        return rows
    slices = F.lit(1)
    if lie["large"]:
        listed = [F.lit(v) for r in lie["large"] for v in (r["folder"], SLICES * -(-r["rows"] // share))]
        slices = F.coalesce(F.element_at(F.create_map(*listed), folder), F.lit(1))
    return rows.repartition(tasks, folder, F.pmod(F.xxhash64("kafka_partition", "kafka_offset"), slices))


def write_batch(
    batch: DataFrame, batch_id: int, topic: Topic, store: Store, run: str, tasks: int | None = None,
    note: Callable[[DataFrame, str], dict] | None = None,
) -> dict[str, int]:
    """Write one batch to both layers; returns received, clean and dropped counts.

    The source is read once: the batch is kept for the second write, and the counts are
    observed while the raw layer is written.

    A live batch holds a date or two, and each source partition writes its own file per
    date without a shuffle. A backfill batch may hold many dates: ``tasks`` then deals
    the dates out over that many tasks, so a date spans as few files as possible, and shares
    out a date with most of the rows (``dealt_by_date``). What ``note`` says of the batch
    is stored with its counts.
    """
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if batch.isEmpty():
            return {"received": 0, "clean": 0, "dropped": 0}
        seen = Observation()
        counted = batch.observe(
            seen,
            F.count(F.lit(1)).alias("received"),
            F.count_if(is_valid(topic.name)).alias("clean"),
        )
        write_rows(counted, batch_folder(store.raw(topic.name), run, batch_id), by_date=False)
        curated = topic.clean(batch)
        if tasks is not None:
            curated = dealt_by_date(curated, tasks, seen.get["clean"])
        write_rows(curated, batch_folder(store.curated(topic.name), run, batch_id), by_date=True)
        counts = {**seen.get, "dropped": seen.get["received"] - seen.get["clean"]}
        files, path = Files(batch.sparkSession), f"{store.metrics(topic.name)}/batch/run={run}-{batch_id}.json"
        folder = batch_folder(store.curated(topic.name), run, batch_id)
        folders = [name for name in files.names(folder) if name.startswith("date=")]
        line = json.dumps({"topic": topic.name, "run": run, "batch_id": batch_id, **counts, "folders": folders, **(note(batch, topic.record) if note else {})})
        files.delete(path)
        files.publish_text(path, line + "\n")
        return counts
    finally:
        batch.unpersist()


def make_batch_writer(
    topic: Topic,
    store: Store,
    run: str,
    report: Callable[[str, int, dict], None] | None = None,
    tasks: int | None = None,
    note: Callable[[DataFrame, str], dict] | None = None,
) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        counts = write_batch(batch, batch_id, topic, store, run, tasks, note)
        if report is not None:
            report(topic.name, batch_id, counts)

    return write


def start_topic(
    envelope: DataFrame,
    topic: Topic,
    store: Store,
    trigger: dict | None = None,
    report: Callable[[str, int, dict], None] | None = None,
    tasks: int | None = None,
    note: Callable[[DataFrame, str], dict] | None = None,
) -> StreamingQuery:
    """One continuous query: envelope -> raw and curated.

    Its jobs run in a scheduler pool of the topic's name, so with fair scheduling a large
    batch of one topic does not hold up the others.
    """
    spark = envelope.sparkSession
    checkpoint = store.checkpoint(topic.name)
    writer = make_batch_writer(topic, store, run_id(spark, checkpoint), report, tasks, note)
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", topic.name)
    query = (
        parse_envelope(envelope, topic.record)
        .writeStream.foreachBatch(writer)
        .option("checkpointLocation", checkpoint)
        .queryName(f"{topic.name}_{uuid.uuid4().hex[:8]}")
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
    return query


def start_all(
    envelope_of: Callable[[str], DataFrame],
    store: Store,
    topics: list[str] | None = None,
    trigger: dict | None = None,
    report: Callable[[str, int, dict], None] | None = None,
    tasks: int | None = None,
    note: Callable[[DataFrame, str], dict] | None = None,
) -> list[StreamingQuery]:
    """All topics side by side, each with its own checkpoint."""
    names = list(TOPICS) if topics is None else topics
    return [start_topic(envelope_of(n), TOPICS[n], store, trigger, report, tasks, note) for n in names]


def await_all(queries: list[StreamingQuery], poll_seconds: float = 1.0) -> None:
    """Wait until every query has ended; when one fails or the user interrupts, stop all."""
    try:
        running = list(queries)
        while running:
            for query in list(running):
                if query.awaitTermination(poll_seconds):
                    running.remove(query)
    finally:
        for query in queries:
            if query.isActive:
                query.stop()


# -- reading ------------------------------------------------------------------
def _covered(spark: SparkSession, layer: str) -> dict:
    """Last generation, last batch of each run it covers, and folders that are rewritten: by
    generation the names of its date folders, or ``*`` for all of it."""
    files = Files(spark)
    generations = [n for n in files.names(f"{layer}/covered") if n.isdigit()]
    if not generations:
        return {"generation": 0, "runs": {}, "gone": {}}
    return {"generation": int(generations[-1]), **json.loads(files.read_text(f"{layer}/covered/{generations[-1]}"))}


_NO_DATE = "date=__HIVE_DEFAULT_PARTITION__"


def _current(df: DataFrame, covered: dict) -> DataFrame:
    """Only rows of valid folders; a filter on partition folders."""
    df = df.filter(F.col("generation") <= covered["generation"])
    for generation, names in covered["gone"].items():
        of = F.col("generation") == int(generation)
        if names != "*":
            dates = [unquote(n.split("=", 1)[1]) for n in names if n != _NO_DATE]
            gone = F.coalesce(F.col("date").isin(dates), F.lit(False))
            of &= gone | F.col("date").isNull() if _NO_DATE in names else gone
        df = df.filter(~of)
    return df


def _open_batches(df: DataFrame, covered: dict) -> DataFrame:
    """Only batches that no compacted generation holds; a filter on partition folders."""
    closed = [
        (F.col("run") == run) & (F.col("batch_id") <= last) for run, last in covered["runs"].items()
    ]
    return df.filter(~reduce(lambda a, b: a | b, closed)) if closed else df


def _batch_numbers(files: Files, layer: str) -> dict[str, list[int]]:
    """Batch folders of each run, in order."""
    return {
        run.split("=", 1)[1]: sorted(
            int(n.split("=", 1)[1])
            for n in files.names(f"{layer}/batches/{run}")
            if n.startswith("batch_id=")
        )
        for run in files.names(f"{layer}/batches")
        if run.startswith("run=")
    }


def _has_open_batches(spark: SparkSession, layer: str, covered: dict) -> bool:
    return any(
        numbers and numbers[-1] > covered["runs"].get(run, -1)
        for run, numbers in _batch_numbers(Files(spark), layer).items()
    )


def read_layer(spark: SparkSession, layer: str, ddl: str, evolve: bool = False, by_date: bool = False) -> DataFrame:
    """All rows of a layer, compacted and not, in the declared column order. ``by_date``: it is stored by date.

    ``evolve`` also returns columns that later batches added, at the price of reading
    every file's footer.
    """
    covered = _covered(spark, layer)
    declared = StructType.fromDDL(ddl).names
    parts, ddl = [], f"{ddl}, date_text string" if by_date else ddl
    if covered["generation"]:
        folder = f"{layer}/compacted"
        done = _scan(spark, folder, f"{ddl}, generation bigint", evolve, ["generation"])
        parts.append(_current(done, covered).drop("generation"))
    if _has_open_batches(spark, layer, covered):
        folder = f"{layer}/batches"
        tail = _scan(spark, folder, f"{ddl}, run string, batch_id bigint", evolve, ["run", "batch_id"])
        parts.append(_open_batches(tail, covered).drop("run", "batch_id"))
    if not parts:
        raise FileNotFoundError(f"nothing written at {layer}")
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if by_date:
        rows = out_of_partitions(rows if "date_text" in rows.columns else rows.withColumn("date_text", F.lit(None).cast("string")))
    return rows.select(*declared, *[c for c in rows.columns if c not in declared])


def _scan(spark: SparkSession, folder: str, ddl: str, evolve: bool, folders: list[str]) -> DataFrame:
    if not evolve:
        return spark.read.schema(ddl).parquet(folder)
    merged = spark.read.option("mergeSchema", "true").parquet(folder)
    kinds = {"run": "string", "batch_id": "bigint", "generation": "bigint", "date": "string"}
    return merged.withColumns(
        {c: F.col(c).cast(kinds[c]) for c in [*folders, "date"] if c in merged.columns}
    )


def read_raw(spark: SparkSession, store: Store, topic: str, evolve: bool = False) -> DataFrame:
    return read_layer(spark, store.raw(topic), TOPICS[topic].raw, evolve)


def read_curated(spark: SparkSession, store: Store, topic: str, evolve: bool = False) -> DataFrame:
    return read_layer(spark, store.curated(topic), TOPICS[topic].curated, evolve, by_date=True)


_KEPT = "folders array<string>, schema string, large array<string>"  # notes besides the counts
_COUNTS = "topic string, run string, batch_id bigint, received bigint, clean bigint, dropped bigint"


def _date_of(folder: str) -> str | None:
    return None if folder == _NO_DATE else unquote(folder.split("=", 1)[1])


def read_notes(spark: SparkSession, store: Store, topic: str, ddl: str) -> DataFrame:
    """Fields of the notes that batches left when they were written, a row per batch."""
    folder = store.metrics(topic)
    if not Files(spark).exists(folder):
        return spark.createDataFrame([], ddl)
    lines = spark.read.schema(ddl).option("recursiveFileLookup", "true").json(folder)
    return lines.dropDuplicates(["run", "batch_id"])  # folded, and not deleted yet


def batch_counts(spark: SparkSession, store: Store, topic: str) -> DataFrame:
    """Received, clean and dropped per batch, as counted when the batch was written."""
    return read_notes(spark, store, topic, _COUNTS)


def _noted(spark: SparkSession, store: Store, topic: str) -> DataFrame:
    """The names of the date folders that each batch made."""
    return read_notes(spark, store, topic, "run string, batch_id bigint, folders array<string>")


def committed_batches(spark: SparkSession, store: Store, topic: str) -> dict[str, int]:
    """Last committed batch of each run of a curated layer, compacted and tidied ones included."""
    layer = store.curated(topic)
    return {**_covered(spark, layer)["runs"], **_committed(spark, layer)}


@dataclass(frozen=True)
class Changes:
    """What a curated layer got since some batch of each run; ``UNDATED`` among the dates for rows without."""

    rows: DataFrame
    dates: list[str | None]
    upto: dict[str, int]


def changes(spark: SparkSession, store: Store, topic: str, seen: dict[str, int]) -> Changes | None:
    """Rows and dates of the committed batches after those in ``seen`` (run -> last batch).

    None if there are no new ones. Reads the new batches' folders only; their dates come from the
    stored batch counts. Raises if some of them have been tidied away unseen.
    """
    layer, files = store.curated(topic), Files(spark)
    upto = {run: last for run, last in _committed(spark, layer).items() if last > seen.get(run, -1)}
    if not upto:
        return None
    new = reduce(
        lambda a, b: a | b,
        [(F.col("run") == run) & F.col("batch_id").between(seen.get(run, -1) + 1, last) for run, last in upto.items()],
    )
    noted = _noted(spark, store, topic).where(new).select("run", "batch_id", F.explode_outer("folders").alias("folder"))
    numbers = _batch_numbers(files, layer)
    there = {(run, n) for run in upto for n in numbers[run] if seen.get(run, -1) < n <= upto[run]}
    dates = [_date_of(r["folder"]) for r in noted.select("folder").distinct().collect() if r["folder"]]
    known = {(r["run"], r["batch_id"]) for r in noted.select("run", "batch_id").distinct().collect()}
    if not known <= there:
        raise FileNotFoundError(f"{len(known - there)} batches of {topic} were tidied away before they were read")
    folders = [f"{layer}/batches/run={run}/batch_id={n}" for run, n in sorted(there)]
    ddl = f"{TOPICS[topic].curated}, date_text string, run string, batch_id bigint"
    rows = spark.read.schema(ddl).option("basePath", f"{layer}/batches").parquet(*folders).drop("run", "batch_id")
    return Changes(out_of_partitions(rows), dates, {**seen, **upto})


def fold_counts(spark: SparkSession, store: Store, topic: str) -> int:
    """Gather the files of single batches in one; returns how many there were.

    The newest batch of a run stays, as a replay would write it anew.
    """
    files, folder = Files(spark), store.metrics(topic)
    by_run: dict[str, list[tuple[int, str]]] = {}
    for name in files.names(f"{folder}/batch"):
        if name.endswith(".json"):
            run, number = name.removesuffix(".json").rsplit("-", 1)
            by_run.setdefault(run, []).append((int(number), f"{folder}/batch/{name}"))
    closed = [path for batches in by_run.values() for _, path in sorted(batches)[:-1]]
    if closed:
        spark.read.schema(f"{_COUNTS}, {_KEPT}").json(closed).coalesce(1).write.json(f"{folder}/folded/{uuid.uuid4().hex}")
        for path in closed:
            files.delete(path)
    return len(closed)


# -- compaction ---------------------------------------------------------------
#: Bytes that one task rewrites, as adaptive execution sees it by default.
ONE_TASK = 64 << 20


def _committed(spark: SparkSession, layer: str) -> dict[str, int]:
    """Last batch per run up to which every batch of the run has been committed."""
    files, last = Files(spark), {}
    for run, numbers in _batch_numbers(files, layer).items():
        # Only the newest folder can still be in writing: a stream runs one batch at a time.
        if numbers and not files.exists(f"{layer}/batches/run={run}/batch_id={numbers[-1]}/_SUCCESS"):
            numbers.pop()
        if numbers:
            last[run] = numbers[-1]
    return last


def compact(
    spark: SparkSession, layer: str, ddl: str, open_batches: int = 0, by_date: bool = True, layout: Layout | None = None
) -> int:
    """Rewrite a layer's closed batches into few files; returns the generation.

    Columns that batches added stay. Folders of earlier generations that hold dates of these
    batches are rewritten with them, so a date ends up in one folder; without dates
    (``by_date=False``, the raw layer) a generation is rewritten once those after it are as large,
    so their number stays small and a row is rewritten a few times only. Rows of a curated layer
    are dealt out by date; beyond ``ONE_TASK`` they are rebalanced by it, where adaptive execution splits a date that is too large for one task.
    The marker file is written last, so readers move to the new folders in one step.
    ``open_batches`` leaves the newest batches of each run alone (they may be replayed). With a
    ``layout`` the rows of a date are stored so that few of them are found quickly.
    """
    covered = _covered(spark, layer)
    closing = {
        run: last - open_batches
        for run, last in _committed(spark, layer).items()
        if last - open_batches > covered["runs"].get(run, -1)
    }
    if not closing:
        return covered["generation"]
    files = Files(spark)
    batches = [
        f"{layer}/batches/run={run}/batch_id={n}"
        for run, numbers in _batch_numbers(files, layer).items() if run in closing
        for n in numbers if covered["runs"].get(run, -1) < n <= closing[run]
    ]
    rows = _merged(spark, batches, f"{layer}/batches", ddl).drop("run", "batch_id")
    size, generations = sum(map(files.size, batches)), _generations(files, layer, covered)
    if by_date:
        dates = {name for batch in batches for name in files.names(batch) if name.startswith("date=")}
        again = [(g, name) for g, name in _folders(files, layer, covered) if name in dates]
    else:
        again, held = [], size
        for g in reversed(generations):
            own = files.size(f"{layer}/compacted/generation={g}")
            if own > held:
                break
            again.append((g, "*"))
            held += own
    if again:
        folders = [f"{layer}/compacted/generation={g}" + (f"/{name}" if name != "*" else "") for g, name in again]
        earlier = _merged(spark, folders, f"{layer}/compacted", ddl).drop("generation")
        rows = rows.unionByName(earlier, allowMissingColumns=True)
    size += sum(files.size(f"{layer}/compacted/generation={g}") for g in {g for g, _ in again})
    return _publish_generation(spark, layer, rows, covered, again, closing, by_date, layout, size)


def redate(spark: SparkSession, layer: str, ddl: str, rule: Column, layout: Layout | None = None) -> dict[str, int]:
    """Give dates to compacted rows that have none, by a rule on their own text (``date_text``) and other
    columns; returns how many rows moved to which date.

    Those rows move to the folders of their dates, which are rewritten with them as compaction does it;
    the others stay undated. Rows of open batches are out of reach until they are compacted. Incremental
    nights have these rows in without a date; rebuild them afterwards.
    """
    covered, files = _covered(spark, layer), Files(spark)
    folders = _folders(files, layer, covered)
    undated = [(g, name) for g, name in folders if name == f"date={UNDATED}"]
    if not undated:
        return {}
    path = lambda g, name: f"{layer}/compacted/generation={g}/{name}"
    base = f"{layer}/compacted"
    rows = _merged(spark, [path(*f) for f in undated], base, ddl).drop("generation")
    ruled = rows.withColumn("ruled", rule)
    moved = ruled.where(is_date("ruled"))
    found = {r["ruled"]: r["count"] for r in moved.groupBy("ruled").count().collect()}
    if not found:
        return {}
    again = [f for f in folders if f[1].removeprefix("date=") in found]
    out = ruled.where(~is_date("ruled")).drop("ruled").unionByName(
        moved.withColumns({"date": F.col("ruled"), "date_text": F.lit(None).cast("string")}).drop("ruled")
    )
    if again:
        out = out.unionByName(_merged(spark, [path(*f) for f in again], base, ddl).drop("generation"), allowMissingColumns=True)
    _publish_generation(spark, layer, out, covered, undated + again, {}, True, layout)
    return found


def _publish_generation(
    spark: SparkSession, layer: str, rows: DataFrame, covered: dict, again: list[tuple[int, str]], closing: dict[str, int], by_date: bool,
    layout: Layout | None = None, size: int | None = None,
) -> int:
    """Write rows as the next generation, which replaces the folders in ``again`` and closes batches.

    Rows of known ``size`` (bytes) that would fit into one task hold no date too large for one. Their
    files cost more than they do, so their dates are dealt out over all cores.
    """
    files, generation = Files(spark), covered["generation"] + 1
    if layout is not None:
        rows = layout.arrange(rows)
    elif not by_date:
        rows = in_few_files(rows, size)
    elif size is not None and size <= ONE_TASK:
        rows = rows.repartition(spark.sparkContext.defaultParallelism, "date")
    else:
        rows = rows.hint("rebalance", "date")
    writer = rows.write.options(**STORED, **layout.options() if layout is not None else {})
    writer = writer.mode("overwrite").option("partitionOverwriteMode", "static")
    writer = writer.partitionBy("date") if by_date else writer
    writer.parquet(f"{layer}/compacted/generation={generation}")
    gone = {g: names for g, names in covered["gone"].items() if files.exists(f"{layer}/compacted/generation={g}")}
    for g, name in again:
        gone[str(g)] = "*" if name == "*" else [*gone.get(str(g), []), name]
    marker = {"runs": {**covered["runs"], **closing}, "gone": gone}
    files.publish_text(f"{layer}/covered/{generation:012d}", json.dumps(marker))
    return generation


def in_few_files(rows: DataFrame, size: int | None) -> DataFrame:
    """Rows of so many bytes, a task for each ``ONE_TASK`` of them. Without dates any task may write any
    row, so none has to move."""
    return rows.hint("rebalance") if size is None else rows.coalesce(max(1, -(-size // ONE_TASK)))


def _merged(spark: SparkSession, folders: list[str], base: str, ddl: str) -> DataFrame:
    """Some folders below ``base``, with all columns that any of their files has."""
    kinds = {"run": "string", "batch_id": "bigint", "generation": "bigint", "date": "string"}
    rows = spark.read.option("mergeSchema", "true").option("basePath", base).parquet(*folders)
    rows = rows.withColumns({c: F.col(c).cast(k) for c, k in kinds.items() if c in rows.columns})
    declared = StructType.fromDDL(ddl)
    rows = rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in declared if f.name not in rows.columns})
    return rows.select(*declared.names, *[c for c in rows.columns if c not in declared.names])


def _generations(files: Files, layer: str, covered: dict) -> list[int]:
    """Generations whose folder is there and not rewritten as a whole."""
    there = sorted(int(n.split("=", 1)[1]) for n in files.names(f"{layer}/compacted") if n.startswith("generation="))
    return [g for g in there if g <= covered["generation"] and covered["gone"].get(str(g)) != "*"]


def _folders(files: Files, layer: str, covered: dict) -> list[tuple[int, str]]:
    """(generation, folder name) of the date folders that are valid."""
    return [
        (g, name)
        for g in _generations(files, layer, covered)
        for name in files.names(f"{layer}/compacted/generation={g}")
        if name.startswith("date=") and name not in covered["gone"].get(str(g), [])
    ]


def date_folders(spark: SparkSession, layer: str) -> list[tuple[str, int, str]]:
    """(date, generation, folder) of every date folder in the valid generations.

    Folder names hold escaped characters; the date is the value itself.
    """
    return [
        (unquote(name.split("=", 1)[1]), g, f"{layer}/compacted/generation={g}/{name}")
        for g, name in _folders(Files(spark), layer, _covered(spark, layer))
    ]


def open_dates(spark: SparkSession, store: Store, topic: str) -> DataFrame:
    """(dt, part, folder) of the date folders of committed batches that no generation holds, from the
    stored batch notes: no folder is listed but the newest of each run."""
    layer = store.curated(topic)
    covered, committed = _covered(spark, layer), _committed(spark, layer)
    open_ = [
        (F.col("run") == run) & F.col("batch_id").between(covered["runs"].get(run, -1) + 1, last)
        for run, last in committed.items()
    ]
    noted = _noted(spark, store, topic).where(reduce(lambda a, b: a | b, open_, F.lit(False)))
    batch = F.format_string("%s/batches/run=%s/batch_id=%d", F.lit(layer), F.col("run"), F.col("batch_id"))
    each = noted.select(F.format_string("b%s-%d", "run", "batch_id").alias("part"), batch.alias("batch"), F.explode("folders").alias("name"))
    return each.select(F.url_decode(F.regexp_replace(F.substring("name", 6, 1 << 20), r"\+", "%2B")).alias("dt"), "part", F.concat("batch", F.lit("/"), "name").alias("folder"))


def drop_covered_batches(spark: SparkSession, layer: str) -> int:
    """Delete batch folders that a generation holds, and folders that a later one has rewritten;
    returns how many batches went."""
    files, dropped, covered = Files(spark), 0, _covered(spark, layer)
    for run, numbers in _batch_numbers(files, layer).items():
        for number in numbers:
            if number <= covered["runs"].get(run, -1):
                files.delete(f"{layer}/batches/run={run}/batch_id={number}")
                dropped += 1
    for generation, names in covered["gone"].items():
        folder = f"{layer}/compacted/generation={generation}"
        for path in [folder] if names == "*" else [f"{folder}/{name}" for name in names]:
            files.delete(path)
        if not any(name.startswith("date=") for name in files.names(folder)):
            files.delete(folder)
    return dropped
