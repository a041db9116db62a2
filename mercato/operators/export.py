"""Forms of a table that plain-text and spreadsheet readers accept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Control characters a spreadsheet cell cannot hold, and texts meaning "no value".
CONTROL_CHARACTERS = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"
EMPTY_TEXTS = ["None", "nan"]

_NESTED = (T.ArrayType, T.StructType, T.MapType)
_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)
_FRACTIONS = (T.DoubleType, T.FloatType)


def _cell(field: T.StructField, cell_limit: int | None) -> Column:
    value = F.col(f"`{field.name}`")
    kind = field.dataType
    if isinstance(kind, _FRACTIONS):
        return F.when(~F.isnan(value), value)
    if isinstance(kind, _TIMES):
        return value.cast("string")
    if not isinstance(kind, (T.StringType, *_NESTED)):
        return value
    text = F.to_json(value) if isinstance(kind, _NESTED) else value
    if isinstance(kind, T.StringType):
        text = F.when(~text.isin(*EMPTY_TEXTS), text)
    # almost no text needs the rewrite, and asking first is twice as fast as always rewriting
    text = F.when(text.rlike(CONTROL_CHARACTERS), F.regexp_replace(text, CONTROL_CHARACTERS, "")).otherwise(text)
    return text if cell_limit is None else F.substring(text, 1, cell_limit)


def export_safe(df: DataFrame, cell_limit: int | None = None) -> DataFrame:
    """Same rows and column names; times and nested values as text, unsafe characters out.

    Texts stay whole. A spreadsheet caller may cut them with ``cell_limit=schemas.CELL_LIMIT``.
    """
    return df.select(*[_cell(f, cell_limit).alias(f.name) for f in df.schema.fields])


def file_inventory(spark, root: str) -> DataFrame:
    """Data files and bytes per folder below ``root``.

    The binary reader lists files in parallel and, with its content column pruned, opens none.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(root)
        .select("path", "length")
    )
    folder = F.regexp_replace("path", r"/[^/]*$", "")
    return files.groupBy(folder.alias("folder")).agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes")
    )
