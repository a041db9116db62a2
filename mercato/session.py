"""Session settings this package relies on, and the shared folder for staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from mercato.sources.files import Files

TIME_ZONE = "UTC"
#: Writer options of stored layers and messages, which are mostly text: about half of Spark's default in bytes.
STORED = {"compression": "zstd"}


def local_session(cores: str = "8", memory: str = "8g", **conf: str) -> SparkSession:
    """A local session for tests and the bench. On a cluster use spark-submit settings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("mercato")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", TIME_ZONE)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.adaptive.enabled", "true")
        # list many date folders with a task per core instead of a task per folder
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", cores)
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin_time_zone(spark: SparkSession) -> SparkSession:
    """Event times are zone-less ISO text; hours and dates are read in one fixed zone."""
    if spark.conf.get("spark.sql.session.timeZone") != TIME_ZONE:
        spark.conf.set("spark.sql.session.timeZone", TIME_ZONE)
    return spark


def list_with_cores(spark: SparkSession) -> SparkSession:
    """Layers have a folder per date. Spark lists more than a few of them with a task each, up to a limit
    of 10,000; unless the session sets a limit of its own, that is a task per core."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    if int(spark.conf.get(key)) == 10_000:
        spark.conf.set(key, max(spark.sparkContext.defaultParallelism, 1))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="mercato-"))
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, unique per call."""
    return f"{shared_folder(spark)}/mercato/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage through a table in the shared folder.

    It survives the loss of any executor, is read column by column, and is computed
    once however many later steps use it.
    """
    return _store(df, fresh_path(df.sparkSession, label))


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """A staged table that goes when the block ends."""
    path = fresh_path(df.sparkSession, label)
    try:
        yield _store(df, path)
    finally:
        Files(df.sparkSession).delete(path)


def _store(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
