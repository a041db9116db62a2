"""What messages carry beyond their declared shape: noted per batch, merged, and readable.

While a batch is written, its messages are also parsed to VARIANT and their common schema is noted with
the batch's counts: every field there is, nested ones included, and whole numbers as INT or BIGINT by
their size. Schemas of batches merge field by field, widening types, on the driver: there are as many as
unlike batches, not messages. The raw layer keeps every message's text, so fields that nobody had
declared can be read from batches written before anyone noticed them, compacted or not.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.streaming import layers
from mercato.streaming.layers import TOPICS, Store

REPORT = "field string, declared string, found string, first_run string, first_batch bigint"
_INT_MAX = 2**31 - 1


# -- types ------------------------------------------------------------------------
def parsed(schema: str) -> T.DataType:
    """A schema as ``schema_of_variant_agg`` words it; a value of no common type is text."""
    words = re.sub(r"\bOBJECT<", "STRUCT<", schema)
    words = re.sub(r"\bVARIANT\b", "STRING", words)
    if words.startswith("STRUCT<"):
        return T.StructType([T.StructField(f.name, f.dataType) for f in _fields(words[7:-1])])
    return T.StructType.fromDDL(f"v {words}")[0].dataType


def _fields(body: str) -> Iterator[T.StructField]:
    """Fields of ``name: TYPE, …``; types nest in angle brackets and parentheses."""
    depth, start, quoted = 0, 0, False
    for i, c in enumerate(body + ","):
        quoted ^= c == "`"
        depth += (c in "<(") - (c in ">)") if not quoted else 0
        if c == "," and not depth and not quoted:
            if part := body[start:i].strip():
                name, kind = re.match(r"(`(?:[^`]|``)*`|[^:]*):\s*(.*)$", part, re.S).groups()
                name = name[1:-1].replace("``", "`") if name.startswith("`") else name.strip()
                yield T.StructField(name, parsed(kind))
            start = i + 1


_NUMBERS = [T.IntegerType(), T.LongType(), T.DoubleType()]


def widened(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds the values of both; text, if nothing less does."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        other = {f.name: f.dataType for f in b}
        merged = [T.StructField(f.name, widened(f.dataType, other.pop(f.name)) if f.name in other else f.dataType) for f in a]
        return T.StructType(merged + [T.StructField(f.name, f.dataType) for f in b if f.name in other])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widened(a.elementType, b.elementType))
    plain = [T.DoubleType() if isinstance(t, T.DecimalType) else t for t in (a, b)]
    if all(t in _NUMBERS for t in plain):
        return max(plain, key=_NUMBERS.index)
    return T.StringType()


def _leaves(kind: T.DataType, path: str = "") -> Iterator[tuple[str, T.DataType]]:
    """(path, type) of every field that is no object; elements of arrays are marked ``[]``."""
    if isinstance(kind, T.StructType):
        for f in kind:
            yield from _leaves(f.dataType, f"{path}.{f.name}" if path else f.name)
    elif isinstance(kind, T.ArrayType):
        yield from _leaves(kind.elementType, f"{path}[]")
    else:
        yield path, kind


# -- noting ------------------------------------------------------------------------
def _whole(record: T.DataType) -> list[str]:
    return [path for path, kind in _leaves(record) if isinstance(kind, T.IntegerType)]


def _mapped(kind: T.DataType, leaf: Callable[[str, T.DataType], T.DataType], path: str = "") -> T.DataType:
    """The type with every leaf replaced."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _mapped(f.dataType, leaf, f"{path}.{f.name}" if path else f.name)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_mapped(kind.elementType, leaf, f"{path}[]"))
    return leaf(path, kind)


def _largest(path: str) -> Column:
    """The largest whole number at a path of the widely parsed record ``wide``, without sign."""
    value = F.col("wide." + path.replace("[]", ""))
    for _ in range(path.count("[]") - 1):
        value = F.flatten(value)
    return F.array_max(F.transform(value, F.abs)) if "[]" in path else F.abs(value)


def noted_schema(batch: DataFrame, record: str) -> dict:
    """Schema of a batch's messages, and the declared whole-number fields whose numbers exceed INT."""
    declared = T.StructType.fromDDL(record)
    wide = _mapped(declared, lambda _, kind: T.LongType() if isinstance(kind, T.IntegerType) else kind)
    messages = batch.select(F.try_parse_json("json_str").alias("v"), F.from_json("json_str", wide).alias("wide"))
    messages = messages.where(F.schema_of_variant("v").startswith("OBJECT<"))
    large = [F.max(F.when(_largest(path) > _INT_MAX, F.lit(path))) for path in _whole(declared)]
    found = messages.agg(
        F.schema_of_variant_agg("v").alias("schema"), F.array_compact(F.array(*large, F.lit(None).cast("string"))).alias("large")
    ).first()
    return {"schema": found["schema"], "large": found["large"]}


_NOTES = "run string, batch_id bigint, schema string, large array<string>"


def _notes(spark: SparkSession, store: Store, topic: str) -> list[tuple[T.DataType, tuple[str, int]]]:
    """Each unlike schema and the first batch that had it."""
    kept = layers.read_notes(spark, store, topic, _NOTES).where("schema IS NOT NULL")
    first = kept.groupBy("schema", "large").agg(F.min(F.struct("run", "batch_id")).alias("b")).collect()
    out = []
    for r in first:
        kind = parsed(r["schema"])
        if isinstance(kind, T.StructType):
            out.append((_sized(kind, set(r["large"] or ()), TOPICS[topic].record), (r["b"]["run"], r["b"]["batch_id"])))
    return sorted(out, key=lambda n: n[1])


def _sized(kind: T.StructType, large: set[str], record: str) -> T.StructType:
    """Whole numbers of fields declared INT are INT, unless one was too large."""
    small = set(_whole(T.StructType.fromDDL(record))) - large
    return _mapped(kind, lambda path, leaf: T.IntegerType() if path in small and leaf == T.LongType() else leaf)


# -- reporting and reading -----------------------------------------------------------
def _beyond(found: T.DataType, declared: T.DataType) -> bool:
    return widened(declared, found) != declared


def report(spark: SparkSession, store: Store, topic: str) -> DataFrame:
    """(field, declared, found, first_run, first_batch): fields that messages have and nobody declared, or
    with values that the declared type does not hold, their type over all batches and the first batch."""
    declared = dict(_leaves(T.StructType.fromDDL(TOPICS[topic].record)))
    seen: dict[str, tuple[T.DataType, tuple[str, int]]] = {}
    for kind, batch in _notes(spark, store, topic):
        for path, found in _leaves(kind):
            known = declared.get(path)
            if isinstance(found, T.NullType) or (known is not None and not _beyond(found, known)):
                continue
            before = seen.get(path)
            seen[path] = (widened(before[0], found), before[1]) if before else (found, batch)
    rows = [
        (path, declared[path].simpleString() if path in declared else None,
         (widened(declared[path], kind) if path in declared else kind).simpleString(), *batch)
        for path, (kind, batch) in sorted(seen.items())
    ]
    return spark.createDataFrame(rows, REPORT)


def full_schema(spark: SparkSession, store: Store, topic: str) -> T.StructType:
    """The declared record, widened by everything that was noted."""
    kind: T.DataType = T.StructType.fromDDL(TOPICS[topic].record)
    for found, _ in _notes(spark, store, topic):
        kind = widened(kind, found)
    return kind


def read_raw(spark: SparkSession, store: Store, topic: str) -> DataFrame:
    """The raw layer with every noted field, in the type that holds all its values: from the message's
    text for fields that are new or wider than declared, as stored for the others."""
    rows = layers.read_raw(spark, store, topic)
    declared = {f.name: f.dataType for f in T.StructType.fromDDL(TOPICS[topic].record)}
    other = [f for f in full_schema(spark, store, topic) if declared.get(f.name) != f.dataType]
    if not other:
        return rows
    text = F.from_json("json_str", T.StructType(other))
    rows = rows.withColumn("beyond", text)
    return rows.withColumns({f.name: F.col("beyond")[f.name] for f in other}).drop("beyond")
