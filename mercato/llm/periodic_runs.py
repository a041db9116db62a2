r"""Periodic runs of words: multi-scale minimizers as seeds, direct lag scans for short periods.

A run is a stretch of consecutive words with smallest period q (words q apart are identical), at
least ``max(LEAST, 3 * q)`` words long, that no neighbouring word extends.

1. Periods up to ``SHORT`` are found by comparing all words with those that many places on.
2. Longer periods are dealt to scales, from one to the next 1.5 times as long: scale P takes the
   periods above the scale before, up to P. A
   gram of P words occurs inside a run of such a period q only at multiples of q, since it holds the
   period whole. Of every P // 3 neighbouring grams the least hash is kept. A run holds P // 3 grams,
   and the same q places on, so both keep the same gram: two equal minimizers, one after the other
   among those of that hash, lie exactly q apart. Each such pair whose distance is of the scale is a
   seed, so every run has one at its scale.
3. Seeds are extended to both sides by binary search over hashes of word spans; what that finds is
   compared word by word, and a lag for which it does not hold is scanned directly. Stretches found
   for several periods belong to the least.

Texts of a batch (``WORDS`` words or one text, whichever is more) are laid end to end with a word
between them that equals no other, longest first, so that a scale reads only the texts long enough
for it.

Rows: words are split at ASCII white space, letters as they are. A null, empty or blank text has no
words, no runs and an empty collapsed text. Every row gives a row, rows with equal or no ids, too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.common import id_text, map_rows, mix, table

#: Least length of a run in words; longest period that is scanned for directly; words of a batch.
LEAST, SHORT, WORDS = 24, 16, 1 << 18
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """All words as numbers, equal for equal words, a number of its own after each text; where each text starts."""
    known: dict[bytes, int] = {}
    sizes = np.array([len(w) for w in texts], np.int64)
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(sizes + 1, out=starts[1:])
    out = np.empty(starts[-1], np.int64)
    for words, start in zip(texts, starts, strict=False):
        out[start : start + len(words)] = [known.setdefault(w, len(known)) for w in words]
    out[starts[1:] - 1] = len(known) + np.arange(len(texts))
    return out, starts


def stretches(words: np.ndarray, lag: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 place of maximal stretches in which words ``lag`` apart are equal, if long enough."""
    same = np.flatnonzero(words[lag:] == words[:-lag]) if len(words) > lag else np.empty(0, np.int64)
    if not len(same):
        return same, same
    cut = np.flatnonzero(np.diff(same) != 1)
    first, last = same[np.r_[0, cut + 1]], same[np.r_[cut, len(same) - 1]]
    ends = last + 1 + lag
    long = ends - first >= max(LEAST, 3 * lag)
    return first[long], ends[long]


class Spans:
    """Hashes of word spans, from sums of powers."""

    def __init__(self, words: np.ndarray) -> None:
        with np.errstate(over="ignore"):
            up, down = np.full(len(words) + 1, np.uint64(_BASE)), np.full(len(words) + 1, np.uint64(_INVERSE))
            up[0] = down[0] = 1
            self.down = np.multiply.accumulate(down)
            self.sums = np.zeros(len(words) + 1, np.uint64)
            np.cumsum(mix(words.astype(np.uint64) + np.uint64(1)) * np.multiply.accumulate(up)[:-1], out=self.sums[1:])

    def at(self, starts: np.ndarray, sizes: np.ndarray | int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[starts + sizes] - self.sums[starts]) * self.down[starts]


def minimizers(hashes: np.ndarray, width: int) -> np.ndarray:
    """Places of the least hash (the first of equals) of every ``width`` neighbours."""
    best, size = np.arange(len(hashes)), 1
    while size < width:
        step = min(size, width - size)
        left, right = best[: len(best) - step], best[step:]
        best, size = np.where(hashes[right] < hashes[left], right, left), size + step
    return best[np.r_[True, best[1:] != best[:-1]]]


def extended(spans: Spans, total: int, places: np.ndarray, lags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far words ``lag`` apart stay equal, before and from each place on."""

    def reach(limit: np.ndarray, holds) -> np.ndarray:
        good, bad = np.zeros_like(limit), limit + 1
        while (open_ := bad - good > 1).any():
            middle = (good + bad) // 2
            yes = np.zeros(len(limit), bool)
            yes[open_] = holds(middle, open_)
            good, bad = np.where(open_ & yes, middle, good), np.where(open_ & ~yes, middle, bad)
        return good

    after = reach(total - places - lags, lambda m, o: spans.at(places[o], m[o]) == spans.at(places[o] + lags[o], m[o]))
    before = reach(places, lambda m, o: spans.at((places - m)[o], m[o]) == spans.at((places + lags - m)[o], m[o]))
    return before, after


def _verified(words: np.ndarray, first: int, end: int, lag: int) -> bool:
    inside = np.array_equal(words[first : end - lag], words[first + lag : end])
    left = first == 0 or words[first - 1] != words[first - 1 + lag]
    return inside and left and (end == len(words) or words[end] != words[end - lag])


def seeded(words: np.ndarray, spans: Spans, scale: int, above: int) -> list[tuple[int, int, int]]:
    """(start, end, period) of the runs with a period from ``above`` (not itself) to ``scale``, by minimizer pairs."""
    grams = spans.at(np.arange(len(words) - scale + 1), scale)
    kept = minimizers(mix(grams), scale // 3)
    order = np.argsort(grams[kept], kind="stable")
    kept, hashes = kept[order], grams[kept][order]
    lags = np.diff(kept)
    seed = (hashes[1:] == hashes[:-1]) & (lags <= scale) & (lags > above)
    places, lags = kept[:-1][seed], lags[seed]
    if not len(places):
        return []
    before, after = extended(spans, len(words), places, lags)
    found = np.unique(np.stack([places - before, places + lags + after, lags], axis=1), axis=0)
    found = found[found[:, 1] - found[:, 0] >= np.maximum(LEAST, 3 * found[:, 2])]
    good = [_verified(words, *row) for row in found.tolist()]
    out = [tuple(row) for row, ok in zip(found.tolist(), good, strict=True) if ok]
    for lag in {row[2] for row, ok in zip(found.tolist(), good, strict=True) if not ok}:  # unequal spans of equal hash
        out += [(a, b, lag) for a, b in zip(*stretches(words, lag), strict=True)]
    return out


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of each text, by start, then period."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    words, starts = numbered([texts[i] for i in order])
    sizes = np.diff(starts) - 1
    found: list[tuple[int, int, int]] = []
    part = words[: starts[int((sizes >= LEAST).sum())]]
    for lag in range(1, SHORT + 1):
        found += [(a, b, lag) for a, b in zip(*stretches(part, lag), strict=True)]
    above, spans = SHORT, None
    while (enough := int((sizes >= 3 * (above + 1)).sum())) > 0:
        spans, scale = spans or Spans(words[: starts[enough]]), above * 3 // 2
        found += seeded(words[: starts[enough]], spans, scale, above)
        above = scale
    least: dict[tuple[int, int], int] = {}
    for first, end, lag in found:
        key = first, end
        least[key] = min(lag, least.get(key, lag))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for (first, end), lag in least.items():
        at = int(np.searchsorted(starts, first, side="right")) - 1
        out[order[at]].append((int(first - starts[at]), int(end - first), int(lag)))
    for rows in out:
        rows.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words without what repeats a run's first period, joined by one space."""
    if runs:
        step = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            step[start + period] += 1
            step[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0)]
    return b" ".join(words).decode()


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs: array of (start, length, period), collapsed) per row."""

    def done(held: list[tuple[object, list[bytes]]]) -> Iterator[tuple]:
        for (key, words), runs in zip(held, runs_of([w for _, w in held]), strict=True):
            named = [{"start": a, "length": b, "period": c} for a, b, c in runs]
            yield key, len(words), named, collapsed(words, runs)

    def rows(source: Iterator[dict]) -> Iterator[tuple]:
        held, size = [], 0
        for r in source:
            words = r["text"].encode().split()  # of bytes: at ASCII white space
            if held and size + len(words) > WORDS:
                yield from done(held)
                held, size = [], 0
            held.append((r["doc_id"], words))
            size += len(words) + 1
        if held:
            yield from done(held)

    key = docs.schema[id_col].dataType.simpleString()
    return map_rows(
        id_text(docs, id_col, text_col), rows,
        f"doc_id {key}, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string", batch=256,
    )


def greatest(runs: Column) -> Column:
    """The run of greatest length / period, compared exactly; of equals the first, then of least period."""
    less = lambda a, b: a["length"] * b["period"] < b["length"] * a["period"]
    first = F.get(runs, F.lit(0))
    return F.aggregate(runs, first, lambda best, r: F.when(less(best, r), r).otherwise(best))


def with_periodic_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): of every tenth document by crc32 of its id, words from a on repeat with period p."""
    rows = id_text(docs, id_col, text_col)
    h = F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(1))  # rows without id stay as they are
    chosen = rows.withColumn("h", h)
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    g = F.expr("h div 10")
    chosen = chosen.withColumn("w", F.when(F.col("h") % 10 == 0, words))
    n = F.size("w").cast("long")
    chosen = chosen.withColumn("a", F.when(n > 0, g % n))
    # one period is repeated as a whole and cut: no look-up per word
    chosen = chosen.withColumn("p", F.expr("1 + (size(w) - a) div (3 + (h div 10) % 8)"))
    tail = F.expr("slice(flatten(array_repeat(slice(w, cast(a + 1 as int), cast(p as int)), cast((size(w) - a) div p + 1 as int))), 1, cast(size(w) - a as int))")
    text = F.array_join(F.concat(F.expr("slice(w, 1, cast(a as int))"), tail), " ")
    return chosen.select("doc_id", F.when(F.col("a").isNull(), F.col("text")).otherwise(text).alias("text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_periodic_tails(table(spark, sf_dir, "documents")))
    best = greatest(F.col("runs"))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
