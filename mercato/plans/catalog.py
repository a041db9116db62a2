"""The platform as a warehouse database: external tables by date, and views on summaries.

Each topic has two tables of partitions, of which its view shows one. A refresh brings the other up to
date by adding and dropping only the partitions that differ, then replaces the view in one statement. So
a reader sees all of one state or all of the next, and a query that has begun keeps its own.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mercato import schemas
from mercato.plans import incremental
from mercato.sources.files import Files
from mercato.sources.snapshots import snapshot_exists, snapshot_folder
from mercato.sources.tables import named_table
from mercato.streaming import layers
from mercato.streaming.layers import TOPICS, Store

# The warehouse's names for columns that the files hold under other names.
RENAMED = {
    "orders": {"timestamp": "order_timestamp"},
    "payments": {"timestamp": "payment_timestamp"},
    "user_events": {"timestamp": "event_time"},
    "daily_sales": {"date": "sale_date", "computed_at": "computed_date"},
    "payment_analysis": {"date": "analysis_date"},
}
SUMMARY_VIEWS = {
    "daily_sales": "daily_sales_summary",
    "customer_rfm": "customer_rfm",
    "churn_candidates": "churn_candidates",
    "payment_analysis": "payment_analysis",
}
_PARTITIONS_PER_STATEMENT = 200


def create_database(spark: SparkSession, database: str, location: str) -> None:
    spark.sql(
        f"CREATE DATABASE IF NOT EXISTS {database} "
        f"COMMENT 'Shop analytics: curated tables and summaries' LOCATION '{location}'"
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _shown(spark: SparkSession, database: str, view: str) -> str | None:
    """Name of the table that a view shows, without its database."""
    if not spark.catalog.tableExists(f"{database}.{view}"):
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {database}.{view}").where("col_name = 'View Text'")
    return re.search(rf"FROM {re.escape(database)}\.(\w+)", described.first()["data_type"])[1]


def _wanted(spark: SparkSession, topic: str, store: Store) -> DataFrame:
    """(dt, part, folder) of every date folder of the layer: of a compacted generation ``g<n>`` or of an
    open batch ``b<run>-<n>``. Those of open batches follow from the stored batch notes."""
    done = [(d, f"g{g}", folder) for d, g, folder in layers.date_folders(spark, store.curated(topic))]
    found = spark.createDataFrame(done, "dt string, part string, folder string")
    return found.unionByName(layers.open_dates(spark, store, topic))


def refresh_topic(spark: SparkSession, database: str, topic: str, store: Store) -> tuple[int, int]:
    """Let a topic's view show what the layer holds now; returns how many partitions were added and dropped.

    Rows without a date, which share a folder, have their own text as ``dt`` in the view. A folder ``date=…`` becomes partition ``dt=…``, one per compacted generation or open batch that holds
    the date. What is there and what should be are joined; only differences reach the driver. The view
    carries the warehouse's column names; Parquet finds columns by name, so the tables keep the files' own.
    """
    now = _shown(spark, database, topic)
    name = f"{topic}_files_{'b' if now == f'{topic}_files_a' else 'a'}"
    table = f"{database}.{name}"
    fields = StructType.fromDDL(TOPICS[topic].curated).fields
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields if f.name != "date")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, date_text STRING, dt STRING, part STRING) USING parquet "
        f"OPTIONS ('compression'='snappy') PARTITIONED BY (dt, part) LOCATION '{store.curated(topic)}/compacted'"
    )
    there = [_partition(r["partition"]) for r in spark.sql(f"SHOW PARTITIONS {table}").toLocalIterator()]
    known = spark.createDataFrame(there, "dt string, part string")
    wanted = _wanted(spark, topic, store)
    gone = known.join(wanted, ["dt", "part"], "left_anti").collect()
    new = wanted.join(known, ["dt", "part"], "left_anti").collect()
    for i in range(0, len(new), _PARTITIONS_PER_STATEMENT):
        added = " ".join(
            f"PARTITION (dt={_quoted(r['dt'])}, part={_quoted(r['part'])}) LOCATION {_quoted(r['folder'])}"
            for r in new[i : i + _PARTITIONS_PER_STATEMENT]
        )
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {added}")
    for i in range(0, len(gone), _PARTITIONS_PER_STATEMENT):
        dropped = ", ".join(
            f"PARTITION (dt={_quoted(r['dt'])}, part={_quoted(r['part'])})" for r in gone[i : i + _PARTITIONS_PER_STATEMENT]
        )
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {dropped}")
    _show(spark, database, topic, table, RENAMED[topic])
    return len(new), len(gone)


def _partition(shown: str) -> tuple[str, str]:
    dt, part = shown.removeprefix("dt=").rsplit("/part=", 1)
    return unquote(dt), unquote(part)


def _show(spark: SparkSession, database: str, view: str, table: str, renamed: dict[str, str]) -> None:
    """Make the view one of this table, in one statement."""
    columns = spark.table(table).columns
    listed = ", ".join(f"`{c}` AS `{renamed.get(c, c)}`" for c in columns if c not in ("part", "dt", "date_text"))
    body = f"SELECT {listed} FROM {table}"
    if "dt" in columns:
        body = (
            f"SELECT {listed}, dt FROM {table} WHERE dt <> '{layers.UNDATED}' "
            f"UNION ALL SELECT {listed}, date_text AS dt FROM {table} WHERE dt = '{layers.UNDATED}'"
        )
    spark.sql(f"CREATE OR REPLACE VIEW {database}.{view} AS {body}")


def refresh_summary(spark: SparkSession, database: str, summary: str, path: str) -> bool:
    """Let a summary's view show its current snapshot, under the warehouse's table and column names."""
    if not snapshot_exists(spark, path):
        return False
    folder, view = snapshot_folder(spark, path), SUMMARY_VIEWS[summary]
    before, name = _shown(spark, database, view), f"{summary}_files_{folder.rsplit('-', 1)[1]}"
    if name == before:
        return True
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} USING parquet LOCATION '{folder}'")
    _show(spark, database, view, f"{database}.{name}", RENAMED.get(summary, {}))
    for r in spark.sql(f"SHOW TABLES IN {database} LIKE '{summary}_files_*'").collect():
        if r["tableName"] not in (name, before):  # what was shown last may still be read
            spark.sql(f"DROP TABLE IF EXISTS {database}.{r['tableName']}")
    return True


def show_days(spark: SparkSession, database: str, summary: str, store: Store) -> bool:
    """Let a summary's view show the daily folders that incremental nights keep, if there are any. The view
    reads the folder itself, so it needs no refresh after further nights."""
    folder = incremental.daily_folder(store, summary)
    if not Files(spark).exists(folder):
        return False
    renamed = RENAMED.get(summary, {})
    columns = incremental.read_days(spark, store, summary).columns
    day = f"CASE WHEN CAST(`date` AS STRING) = '{layers.UNDATED}' THEN date_text ELSE CAST(`date` AS STRING) END"
    listed = ", ".join(f"{day if c == 'date' else f'`{c}`'} AS `{renamed.get(c, c)}`" for c in columns)
    spark.sql(f"CREATE OR REPLACE VIEW {database}.{SUMMARY_VIEWS[summary]} AS SELECT {listed} FROM parquet.`{folder}`")
    return True


def create_warehouse(
    spark: SparkSession, database: str, store: Store, topics: tuple[str, ...] = schemas.TOPICS, anew: bool = False
) -> None:
    """The whole database: the topic tables and whichever summaries exist. What it has already is brought
    up to date; ``anew`` drops it first, which readers notice."""
    if anew:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    create_database(spark, database, f"{store.root}/warehouse/{database}")
    files = Files(spark)
    for topic in topics:
        if files.exists(store.curated(topic)):
            refresh_topic(spark, database, topic, store)
    for summary in SUMMARY_VIEWS:
        if not show_days(spark, database, summary, store):
            refresh_summary(spark, database, summary, store.summary(summary))


def refresh_warehouse(spark: SparkSession, database: str, store: Store) -> bool:
    """Let an existing database show what the store holds now."""
    if not spark.catalog.databaseExists(database):
        return False
    create_warehouse(spark, database, store)
    return True


def warehouse_table(spark: SparkSession, database: str, name: str) -> DataFrame:
    """A warehouse view with the column names the analyses use."""
    df = named_table(spark, database, SUMMARY_VIEWS.get(name, name))
    back = {new: old for old, new in RENAMED.get(name, {}).items()}
    if name in schemas.TOPICS:
        back["dt"] = "date"
    return df.withColumnsRenamed(back)


def list_partitions(spark: SparkSession, database: str, topic: str) -> DataFrame:
    shown = spark.sql(f"SHOW PARTITIONS {database}.{_shown(spark, database, topic)}")
    return shown.select(F.regexp_extract("partition", "^dt=([^/]*)", 1).alias("dt")).distinct()


def describe_table(spark: SparkSession, database: str, name: str) -> DataFrame:
    described = spark.sql(f"DESCRIBE {database}.{name}")
    return described.select("col_name", "data_type").filter("col_name not like '#%' and col_name != ''")


def list_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """The database's own tables and views; Spark also lists the temporary views of the session."""
    return spark.sql(f"SHOW TABLES IN {database}").where("NOT isTemporary")
