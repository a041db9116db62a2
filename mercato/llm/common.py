"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import mercato

#: Rows of a key list that may be broadcast: at most about 16 MB of 8-byte keys with overhead.
BROADCAST_KEYS = 200_000
#: Bits of a filter: 16 per entry, but no more than this (16 MB).
FILTER_BITS = 1 << 27
#: Bytes of rows that go to a Python worker at a time.
BATCH_BYTES = 4 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it (else: ``--py-files``)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(mercato.__file__)))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark


def in_small_batches(spark: SparkSession) -> SparkSession:
    """Whole texts reach Python workers a few megabytes at a time, unless the session sets a limit of its own.
    Spark's is 64 MB, held several times over on both sides, beyond the heap; narrow rows stay below either."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return in_small_batches(importable(spark)).read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) and nothing else, so that no other column can clash; null text is empty."""
    return docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def hash_split(id_col: Column, folds: int) -> Column:
    """Fold of a row: crc32 of its id as text, modulo ``folds``; a null id is in fold 0."""
    return F.coalesce(F.crc32(id_col.cast("string")) % folds, F.lit(0))


def unused(df: DataFrame, name: str) -> str:
    """``name``, longer by underscores until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_rows(df: DataFrame, rows: Callable[[Iterator[dict]], Iterator[tuple]], schema: str, batch: int = 4096) -> DataFrame:
    """``mapInArrow`` over dicts: at most ``batch`` result rows are held at a time. A result may
    also be a list of columns, for many rows at once."""

    kinds = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def source() -> Iterator[dict]:
            for b in batches:
                names = b.schema.names
                for start in range(0, b.num_rows, 256):  # few Python objects at a time
                    part = b.slice(start, 256)
                    for values in zip(*(c.to_pylist() for c in part.columns), strict=True):
                        yield dict(zip(names, values, strict=True))

        held: list[tuple] = []
        for row in rows(source()):
            if isinstance(row, list):  # whole columns
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, arrow, strict=True)], schema=arrow)
                continue
            held.append(row)
            if len(held) >= batch:
                yield _batch(held, arrow)
                held = []
        if held:
            yield _batch(held, arrow)

    return df.mapInArrow(run, kinds)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(values, type=field.type) for values, field in zip(zip(*rows, strict=True), schema, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def with_keys(df: DataFrame, keys: DataFrame, on: list[str], how: str = "left_semi") -> DataFrame:
    """Semi or anti join with a list of keys, counted first: broadcast while it is small, shuffled beyond."""
    small = keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    return df.join(F.broadcast(keys) if small else keys, on, how)


class BitFilter:
    """Two bits per entry in a fixed number of bits: no entry is missed, few others pass."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words

    @staticmethod
    def of(entries: DataFrame, column: str, max_bits: int = FILTER_BITS) -> BitFilter:
        """Of 64-bit hashes, built by the executors; what reaches the driver has at most ``max_bits``."""
        count = entries.agg(F.approx_count_distinct(column)).first()[0]
        bits = 1 << 12
        while bits < min(max_bits, 16 * count):
            bits *= 2
        spots = F.explode(F.array(F.col(column), F.shiftrightunsigned(column, 32)))
        at = entries.select(spots.alias("h")).select(F.expr(f"h & {bits - 1}L").alias("at"))
        rows = at.groupBy(F.shiftright("at", 6).alias("word")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")
        ).toArrow()
        words = np.zeros(bits // 64, np.uint64)
        words[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
        return BitFilter(words)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        bits = np.uint64(len(self.words) * 64 - 1)
        found = np.ones(len(hashes), bool)
        for h in (hashes, hashes >> np.uint64(32)):
            at = h & bits
            found &= (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0
        return found


def only_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """At least the rows whose doc_id is among ``ids``, for a join that follows. No row is shuffled.

    A short list is broadcast; a long one becomes a bit filter, which lets some other rows pass.
    """
    if ids.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        return rows.join(F.broadcast(ids), "doc_id", "left_semi")
    known = rows.sparkSession.sparkContext.broadcast(BitFilter.of(ids.select(F.xxhash64("doc_id").alias("h")), "h"))

    @F.pandas_udf("boolean")
    def listed(hashes: pd.Series) -> pd.Series:
        return pd.Series(known.value.has(hashes.to_numpy(np.int64).view(np.uint64)))

    return rows.where(listed(F.xxhash64("doc_id")))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


#: For ``bytes.translate``: lower-cases A-Z and turns ASCII white space, or all ASCII but letters and
#: digits, into blanks. Bytes of other characters stay.
SPACED = bytes(32 if 9 <= b <= 13 else b + 32 if 65 <= b <= 90 else b for b in range(256))
ALPHANUMERIC = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))
_BASE, _PIECE = 0x9E3779B97F4A7C15 | 1, 1 << 20


def _byte_values() -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64))
    values[32] = 0
    return values


_VALUES = _byte_values()
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the hash base and of its inverse, up to the longest piece so far."""

    up = down = np.empty(0, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > _PIECE:
            return _powers(_BASE, n), _powers(_INVERSE, n)
        if n > len(cls.up):
            size = min(_PIECE, 2 * n)
            cls.up, cls.down = _powers(_BASE, size), _powers(_INVERSE, size)
        return cls.up[:n], cls.down[:n]


def hashed_words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every run of bytes but blanks: a polynomial in the run's bytes, scrambled.

    Long data is taken in pieces of about a megabyte, cut at blanks.
    """
    if len(data) > _PIECE:
        found, start = [], 0
        while start < len(data):
            end = data.find(b" ", start + _PIECE)
            end = len(data) if end < 0 else end
            h, a, b = _hashed_words(data[start:end])
            found.append((h, a + start, b + start))
            start = end
        return tuple(map(np.concatenate, zip(*found, strict=True)))  # type: ignore[return-value]
    return _hashed_words(data)


def _hashed_words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = raw != 32
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _Powers.to(len(raw))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_VALUES[raw] * up, out=sums[1:])
        return mix((sums[ends] - sums[starts]) * (down[starts] if len(starts) else np.uint64(1))), starts, ends


def spans_at(words: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each start on."""
    total = np.full(len(starts), np.uint64(size), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            total = mix(total * np.uint64(0x100000001B3) + words[starts + i])
    return total


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words; of the whole sequence if it is shorter; none of none."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    total = np.full(n, np.uint64(size), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            total = mix(total * np.uint64(0x100000001B3) + words[i : i + n])
    return total
