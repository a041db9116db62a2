"""Summary tables replaced as a whole, without readers ever seeing half of one.

Each write goes to its own version folder; a small numbered marker file then names it.
Readers follow the highest marker, so a failed write leaves the last good version in
place, and a job may read the table it is about to replace.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from mercato.sources.files import Files


def _markers(files: Files, path: str) -> list[str]:
    return [n for n in files.names(f"{path}/current") if n.isdigit()]


def snapshot_exists(spark: SparkSession, path: str) -> bool:
    return bool(_markers(Files(spark), path))


def write_snapshot(df: DataFrame, path: str) -> int:
    """Store ``df`` as the new content of the table at ``path``; returns its row count."""
    spark = df.sparkSession
    files = Files(spark)
    version = f"version-{uuid.uuid4().hex}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{path}/{version}")
    markers = _markers(files, path)
    number = int(markers[-1]) + 1 if markers else 1
    files.publish_text(f"{path}/current/{number:012d}", version)
    return seen.get["rows"]


def snapshot_folder(spark: SparkSession, path: str) -> str:
    """Folder of the version that is current now."""
    files = Files(spark)
    markers = _markers(files, path)
    if not markers:
        raise FileNotFoundError(f"no snapshot at {path}")
    return f"{path}/{files.read_text(f'{path}/current/{markers[-1]}')}"


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(snapshot_folder(spark, path))


def refresh_snapshot(new: DataFrame, path: str, column: str, values: list[str]) -> int:
    """Replace only the rows whose ``column`` is in ``values``; keep the others."""
    spark = new.sparkSession
    if not snapshot_exists(spark, path):
        return write_snapshot(new, path)
    kept = read_snapshot(spark, path).filter(~F.coalesce(F.col(column).isin(values), F.lit(False)))
    return write_snapshot(kept.unionByName(new, allowMissingColumns=True), path)


def prune_snapshots(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete all but the latest ``keep`` versions; returns how many went."""
    files = Files(spark)
    old = _markers(files, path)[:-keep]
    for marker in old:
        files.delete(f"{path}/{files.read_text(f'{path}/current/{marker}')}")
        files.delete(f"{path}/current/{marker}")
    return len(old)
