"""Stored tables: guarded loading, registration as views, emptiness checks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class TableEntry:
    """One table of the platform and how to load it."""

    view: str
    layer: str
    load: Callable[[], DataFrame]
    sheet: str = ""
    description: str = ""


def scan(spark: SparkSession, path: str, ddl: str | None = None, evolve: bool = False) -> DataFrame:
    """A Parquet table by path. ``evolve`` merges the columns of files with different schemas.

    ``date`` folders come back as text, the type the records carry.
    """
    if ddl is not None:
        return spark.read.schema(ddl).parquet(path)
    df = spark.read.option("mergeSchema", str(evolve).lower()).parquet(path)
    return df.withColumn("date", df["date"].cast("string")) if "date" in df.columns else df


def named_table(spark: SparkSession, database: str, name: str) -> DataFrame:
    return spark.table(f"{database}.{name}")


def has_rows(df: DataFrame) -> bool:
    """Stops at the first row found; never a full count."""
    return not df.isEmpty()


def try_load(entry: TableEntry) -> DataFrame | None:
    """The table, or None when it is missing or unreadable."""
    try:
        df = entry.load()
        df.schema  # resolves the plan, so a missing path shows here
        return df
    except (PySparkException, FileNotFoundError):
        return None


def register_tables(spark: SparkSession, entries: list[TableEntry]) -> DataFrame:
    """Register every available table as a temp view; missing ones are reported, not fatal."""
    rows = []
    for entry in entries:
        df = try_load(entry)
        if df is None:
            rows.append((entry.view, entry.layer, False, 0))
            continue
        try:
            rows.append((entry.view, entry.layer, True, df.count()))
        except Exception:  # files that no task can read
            rows.append((entry.view, entry.layer, False, 0))
            continue
        df.createOrReplaceTempView(entry.view)
    return spark.createDataFrame(
        rows, "table_name string, layer string, available boolean, row_count bigint"
    )
