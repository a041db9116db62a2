"""Reports written by the executors: one folder of CSV per sheet, and a manifest."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from mercato.operators.export import export_safe
from mercato.plans.tables import Tables
from mercato.sources.tables import TableEntry, try_load


CONCURRENT_SHEETS = 4  # sheets are independent jobs; small ones then share the cluster


def _folder(out_dir: str, sheet: str) -> str:
    return f"{out_dir}/{sheet.replace(' ', '_')}"


def _write_csv(df: DataFrame, folder: str) -> int:
    """Write with a header and count on the way."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").option("header", "true").option("escape", '"').csv(folder)
    return seen.get["rows"]


def write_sheet(
    build: Callable[[], DataFrame], sheet: str, out_dir: str, limit: int | None = None
) -> tuple[str, int, str]:
    """Write one sheet; a sheet that fails is reported and the report goes on."""
    try:
        df = build()
        rows = _write_csv(export_safe(df if limit is None else df.limit(limit)), _folder(out_dir, sheet))
        return sheet, rows, "written"
    except Exception as problem:  # a failed task is no PySparkException
        return sheet, 0, f"skipped: {type(problem).__name__}"


def write_report(
    spark: SparkSession,
    tables: Tables,
    sheets: dict[str, Callable[[Tables], DataFrame]],
    out_dir: str,
    limits: dict[str, int] | None = None,
) -> DataFrame:
    """Write every sheet; returns (sheet, rows, status)."""
    limits = limits or {}
    with ThreadPoolExecutor(CONCURRENT_SHEETS) as pool:
        manifest = list(
            pool.map(
                lambda item: write_sheet(lambda: item[1](tables), item[0], out_dir, limits.get(item[0])),
                sheets.items(),
            )
        )
    return spark.createDataFrame(manifest, "sheet string, rows bigint, status string")


def described(df: DataFrame, layer: str) -> str:
    """A line on a table, made from its schema."""
    return f"{layer} table of {len(df.columns)} columns: {', '.join(df.columns)}"


def export_tables(spark: SparkSession, entries: list[TableEntry], out_dir: str) -> DataFrame:
    """Export whole tables; returns the index of what was exported.

    Each table is written where its rows are; none passes through the driver.
    """
    stamp = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S UTC")

    def export(entry: TableEntry) -> tuple:
        sheet, df = entry.sheet or entry.view, try_load(entry)
        available, rows, columns = False, 0, 0
        if df is not None:
            columns = len(df.columns)
            _, rows, status = write_sheet(lambda: df, sheet, out_dir)
            available = status == "written" and rows > 0
        return (
            sheet, entry.layer, entry.view,
            entry.description or (described(df, entry.layer) if df is not None else None), available,
            rows if available else None, columns if available else None, stamp,
        )

    with ThreadPoolExecutor(CONCURRENT_SHEETS) as pool:
        index = list(pool.map(export, entries))
    return spark.createDataFrame(
        index,
        "sheet string, layer string, table_name string, description string, available boolean, "
        "row_count bigint, column_count int, exported_at string",
    )


def exported_rows(index: DataFrame) -> DataFrame:
    """Rows over all available tables of an export index."""
    return index.filter("available").agg(
        F.count("*").alias("tables"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_rows")
    )
