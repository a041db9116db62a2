"""Tables stored by key: bucketed and sorted, so that joins and aggregates on the key move nothing.

Rows are added by runs, each in a partition of its own, without reading what is there; a run that is
repeated replaces its partition. A task then reads one bucket of all runs. The catalog entry, which
holds the number of buckets, is made anew where an application does not find it.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from mercato.sources.files import Files


def table_name(folder: str) -> str:
    return f"bucketed_{hashlib.sha1(folder.encode()).hexdigest()[:20]}"


def open_buckets(spark: SparkSession, folder: str, ddl: str, key: str, buckets: int) -> DataFrame:
    """The table of a folder, rows of all runs, with its buckets known to the planner."""
    name = table_name(folder)
    if not spark.catalog.tableExists(name):
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({ddl}, run BIGINT) USING parquet PARTITIONED BY (run) "
            f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{folder}'"
        )
        if Files(spark).exists(folder):
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return spark.table(name)


def add_run(rows: DataFrame, folder: str, ddl: str, key: str, buckets: int, run: int) -> None:
    """Store the rows as those of a run, a file per bucket at most."""
    spark = rows.sparkSession
    columns = open_buckets(spark, folder, ddl, key, buckets).drop("run").columns
    view = f"rows_{uuid.uuid4().hex}"
    rows.select(*columns).repartition(buckets, key).createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {table_name(folder)} PARTITION (run = {int(run)}) SELECT {', '.join(columns)} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def forget(spark: SparkSession, folder: str) -> None:
    """Drop the table, its catalog entry and its files."""
    spark.sql(f"DROP TABLE IF EXISTS {table_name(folder)}")
    Files(spark).delete(folder)
