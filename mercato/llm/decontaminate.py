r"""Benchmark decontamination by winnowing.

Both sides are cut into word k-grams; of every ``WINDOW - K + 1`` consecutive k-gram hashes the
least (the rightmost of equals) is kept. Any shared span of ``WINDOW`` words holds a whole such
window, so both sides keep the same k-gram of it: no shared span of that length is missed. Items
shorter than ``WINDOW`` are one window and one k-gram of their own length.

Fingerprints meet in two steps. Those of the benchmark fill a bit filter whose size is fixed by a
parameter, whatever the benchmark's size; a document's kept hashes are looked up in it. A hit is
extended to all windows that cover it, and those the benchmark may hold (a second such filter) are
joined with the benchmark's windows by their words. The filters only save work; the join decides.
Each distinct window is one row of the benchmark side, so a window that many items and many
documents share makes one row per occurrence, not one per pair.

Rows: a null or empty text has no words and is not contaminated; repeated document rows give
repeated results; items with equal ids count as one, items without id or without words are
ignored. An empty benchmark leaves every document clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.common import ALPHANUMERIC, BitFilter, hashed_words, id_text, map_rows, shingle_hashes, spans_at, table
from mercato.session import stage

WINDOW, K = 13, 5


class Words:
    """The words of a text, as hashes and as places in its lower-cased bytes."""

    def __init__(self, text: str) -> None:
        self.data = text.encode().translate(ALPHANUMERIC)
        self.hashes, self.starts, self.ends = hashed_words(self.data)

    def between(self, first: int, size: int) -> str:
        return b" ".join(self.data[self.starts[first] : self.ends[first + size - 1]].split()).decode()


def winnow(hashes: np.ndarray, width: int) -> np.ndarray:
    """Positions of the rightmost least hash of every ``width`` neighbours (of all, if they are fewer)."""
    n = len(hashes)
    if n == 0 or width == 1:
        return np.arange(n)
    width = min(width, n)
    places = n - width + 1
    least = hashes[:places].copy()
    for step in range(1, width):
        np.minimum(least, hashes[step : step + places], out=least)
    best = np.zeros(places, np.int64)
    for step in range(width):
        best[hashes[step : step + places] == least] = step
    return np.unique(best + np.arange(places))


def windows_of(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW, k: int = K) -> DataFrame:
    """(item, size, words, hash, kept) per window of an item; ``kept``: the fingerprints it holds."""

    def rows(source: Iterator[dict]) -> Iterator[tuple]:
        for r in source:
            words = Words(r["text"])
            whole = words.hashes
            size = min(window, len(whole))
            gram = k if size == window else size
            spans, grams = shingle_hashes(whole, size), shingle_hashes(whole, gram)
            for i in range(len(spans)):
                kept = grams[i : i + size - gram + 1]
                least = kept[winnow(kept, len(kept))]
                yield r["doc_id"], size, words.between(i, size), int(spans[i].view(np.int64)), least.view(np.int64).tolist()

    named = id_text(items, id_col, text_col).where("doc_id IS NOT NULL").select(F.col("doc_id").cast("string"), "text")
    return map_rows(named, rows, "item string, size int, words string, hash long, kept array<long>")


def candidates(docs: DataFrame, sizes: list[int], grams: BitFilter, spans: BitFilter, window: int = WINDOW, k: int = K) -> DataFrame:
    """(doc_id, n_words, hits): hits are (start, size, words) of windows that the benchmark may hold."""
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast((grams, spans))

    def rows(source: Iterator[dict]) -> Iterator[tuple]:
        known_grams, known_spans = shipped.value
        for r in source:
            words = Words(r["text"])
            whole, hits = words.hashes, []
            for size in sizes:
                if len(whole) < size:
                    continue
                gram = k if size == window else size
                kgrams = shingle_hashes(whole, gram)
                kept = winnow(kgrams, size - gram + 1)
                kept = kept[known_grams.has(kgrams[kept])]
                if not len(kept):
                    continue
                near = np.unique(kept[:, None] - np.arange(size - gram + 1)[None, :])
                near = near[(near >= 0) & (near <= len(whole) - size)]
                found = spans_at(whole, near, size)
                hits += [(int(s), size, words.between(s, size)) for s in near[known_spans.has(found)]]
            yield r["doc_id"], len(whole), [{"start": a, "size": b, "words": c} for a, b, c in hits]

    key = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(docs, rows, f"doc_id {key}, n_words long, hits array<struct<start:int,size:int,words:string>>")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, k: int = K) -> DataFrame:
    """(doc_id, n_words, n_hit, items): words inside any occurrence of an item's window, and whose."""
    windows = stage(windows_of(items, window=window, k=k), "benchmark-windows")
    sizes = sorted(r[0] for r in windows.select("size").distinct().collect())
    grams = BitFilter.of(windows.select(F.explode("kept").alias("hash")), "hash")
    spans = BitFilter.of(windows, "hash")
    named = id_text(docs, id_col, text_col)
    found = stage(
        candidates(named, sizes, grams, spans, window, k).withColumn("row", F.monotonically_increasing_id()),
        "window-candidates",
    )
    owners = windows.groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("items"))
    hits = found.where(F.size("hits") > 0).select("row", F.inline("hits")).join(owners, "words")
    step = lambda done, s: F.struct(  # noqa: E731  words covered so far, and up to where
        (done["n"] + F.greatest(F.lit(0), s["start"] + s["size"] - F.greatest(done["end"], s["start"]))).alias("n"),
        F.greatest(done["end"], s["start"] + s["size"]).alias("end"),
    )
    by_row = hits.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "size"))).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    ).select(
        "row", "items",
        F.aggregate("spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), step)["n"].cast("bigint").alias("n_hit"),
    )
    return found.join(by_row, "row", "left").select(
        "doc_id", "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def is_contaminated() -> Column:
    """One word in twenty, or more, lies in benchmark windows."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


_TEXT_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
ORACLE_SQL = f"""
WITH item AS (SELECT item_id::VARCHAR AS item, {_TEXT_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
item_window AS (
  SELECT DISTINCT item, size, array_to_string(w[i:i + size - 1], ' ') AS words
  FROM (SELECT *, least({WINDOW}, len(w)) AS size FROM item WHERE len(w) > 0) t, generate_series(1, len(w) - size + 1) s(i)),
doc AS (SELECT doc_id, {_TEXT_WORDS} AS w FROM documents),
doc_window AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS words
  FROM doc, (SELECT DISTINCT size FROM item_window) z, generate_series(1, len(w) - size + 1) s(i)),
hit AS (SELECT DISTINCT doc_id, i, d.size, item FROM doc_window d JOIN item_window USING (words)),
n_hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM hit, generate_series(i, i + size - 1) s(p) GROUP BY doc_id),
owner AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM hit GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
  coalesce(n, 0) > 0 AND 20 * coalesce(n, 0) >= len(w) AS contaminated
FROM doc d LEFT JOIN n_hit USING (doc_id) LEFT JOIN owner USING (doc_id)"""
