"""Document fingerprints by content-defined chunking.

A gear hash rolls over the UTF-8 bytes; it depends on the last 32 bytes only. A chunk ends where
the hash has zero bits under a mask: a strict one until the chunk reaches its normal size, a loose
one after it (normalised chunking), at ``LARGEST`` bytes in any case. Cuts follow the content, so an
insertion changes the chunks around it and shifts the rest. A fingerprint is the set of chunk
digests with their lengths; containment is the share of one set's length that the other has too.

Per document, on whole texts. ``neighbours`` brings each document the next one by id: ids are cut
into ranges of about ``RANGE_BYTES``, one shuffle sorts each range, and a copy of the next range's
first document closes it. No task holds more than two documents.

Rows: null text is empty; an empty text has the empty fingerprint, contains the empty one fully and
any other not at all, and is contained in all; rows without id come first; equal ids are ordered by
text; repeated rows follow one another. The last row is followed by the first.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.common import id_text, map_rows, mix, table

#: Sizes of a chunk in bytes. LARGEST fits one byte of a fingerprint.
LEAST, NORMAL, LARGEST = 6, 14, 64
STRICT, LOOSE = np.uint32(0x1F << 27), np.uint32(0x07 << 27)
GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
RANGE_BYTES, MAX_RANGES = 8 << 20, 20_000


def cuts(data: bytes, start: int = 0) -> list[int]:
    """Ends of the chunks from ``start``, where a chunk begins, to the end of the data."""
    if start >= len(data):
        return []
    lead = max(0, start - 31)
    rolled = GEAR[np.frombuffer(data, np.uint8)[lead:]]
    for span in (1, 2, 4, 8, 16):  # sums over 2, 4, ... 32 bytes, each older byte shifted once more
        rolled[span:] += rolled[:-span] << np.uint32(span)
    loose = np.flatnonzero((rolled & LOOSE) == 0) + (lead + 1)
    strict = loose[(rolled[loose - (lead + 1)] & STRICT) == 0].tolist()
    loose, size, out = loose.tolist(), len(data), []
    while size - start > LEAST:
        i = bisect_left(strict, start + LEAST)
        end = strict[i] if i < len(strict) and strict[i] < start + NORMAL else None
        if end is None:
            i = bisect_left(loose, start + NORMAL)
            end = min(loose[i] if i < len(loose) else size, start + LARGEST, size)
        out.append(end)
        start = end
    return out if start == size else [*out, size]


def chunks(data: bytes, ends: list[int]) -> dict[bytes, int]:
    """Digest to length, of distinct chunks."""
    return {xxhash.xxh3_64_digest(data[a:b])[:5]: b - a for a, b in zip([0, *ends], ends, strict=False)}


def text_form(found: dict[bytes, int]) -> str:
    """Digests (5 bytes) and lengths (1 byte) in order, as base64."""
    return base64.b64encode(b"".join(d + bytes((n,)) for d, n in sorted(found.items()))).decode()


def from_text(fingerprint: str) -> dict[bytes, int]:
    raw = base64.b64decode(fingerprint)
    return {raw[i : i + 5]: raw[i + 5] for i in range(0, len(raw), 6)}


def containment(a: dict[bytes, int], b: dict[bytes, int]) -> float:
    """Share of a's length that b has too."""
    if not a:
        return 0.0 if b else 1.0
    return sum(a[d] for d in a.keys() & b.keys()) / sum(a.values())


def fingerprint(text: str | None) -> dict[bytes, int]:
    data = (text or "").encode()
    return chunks(data, cuts(data))


def fingerprinted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, fingerprint)."""

    def rows(source: Iterator[dict]) -> Iterator[tuple]:
        for r in source:
            yield r["doc_id"], len(r["text"]), text_form(fingerprint(r["text"]))

    named = id_text(docs, id_col, text_col)
    return map_rows(named, rows, f"doc_id {named.schema['doc_id'].dataType.simpleString()}, n_chars long, fingerprint string")


def neighbours(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(doc_id, text, range, closes) sorted within ranges; ``closes`` marks the copy of the next range's first row."""
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, min(MAX_RANGES, total // range_bytes))
    bounds = docs.approxQuantile("doc_id", [i / n for i in range(1, n)], 1 / (4 * n)) if n > 1 else []
    edges = np.unique(np.array(bounds, dtype=np.float64))

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        found = np.searchsorted(edges, ids.to_numpy(dtype=np.float64, na_value=-np.inf), side="left")
        return pd.Series(found.astype(np.int32))

    ranged = docs.withColumn("range", range_of("doc_id"))
    firsts = ranged.groupBy("range").agg(F.min("doc_id").alias("first"), F.min(F.col("doc_id").isNotNull()).alias("known")).orderBy("range").collect()
    # at most MAX_RANGES rows; the first row of a range closes the range before it, that of the first range the last
    key = docs.schema["doc_id"].dataType.simpleString()
    heads = docs.sparkSession.createDataFrame(
        [(r["first"] if r["known"] else None, firsts[i - 1]["range"]) for i, r in enumerate(firsts)], f"first {key}, range int"
    )
    closing = (
        docs.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("first")))
        .groupBy("range", "doc_id").agg(F.min("text").alias("text"))
        .select("doc_id", "text", "range", F.lit(True).alias("closes"))
    )
    rows = ranged.withColumn("closes", F.lit(False)).unionByName(closing)
    return rows.repartition(len(firsts) or 1, "range").sortWithinPartitions("range", "closes", "doc_id", "text")


def edited_chain(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document beside its edit, whose last quarter comes from the next document's start."""
    ordered = neighbours(id_text(docs, id_col, text_col))

    def rows(source: Iterator[dict]) -> Iterator[tuple]:
        last = None
        for r in source:
            data = r["text"].encode()
            ends = cuts(data)
            now = r["doc_id"], r["text"], data, ends, chunks(data, ends)
            if last is not None and last[0] == r["range"]:
                yield compared(*last[1], now[1], now[4])
            last = None if r["closes"] else (r["range"], now)

    def compared(doc_id, text: str, data: bytes, ends: list[int], own: dict, following: str, theirs: dict) -> tuple:
        n = len(text) // 4
        kept = text[: len(text) - n]
        edit = (kept + following[:n]).encode()
        # a cut depends on the bytes before it, and a chunk that ends before the edit ends there too
        same = ends[: bisect_left(ends, len(kept.encode()))]
        edit_ends = same + cuts(edit, same[-1] if same else 0)
        other = chunks(edit, edit_ends)
        return (
            doc_id, len(text), hashlib.sha256(edit).hexdigest(), text_form(own), text_form(other),
            containment(own, other), containment(own, theirs),
        )

    key = ordered.schema["doc_id"].dataType.simpleString()
    return map_rows(
        ordered, rows,
        f"doc_id {key}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_chain(table(spark, sf_dir, "documents"))
