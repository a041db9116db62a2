"""Quality classifier: Naive Bayes support vectors.

Features are indicators of word n-grams (one and two words) and of n-grams of word shapes (one to
three), hashed into ``BUCKETS``. A shape keeps the order of character classes and punctuation
(``Xx``, ``xx***``) and whether the word repeats one of the two before it. Each indicator is scaled by its
class log-count ratio, rows get unit length, and dual coordinate descent fits a linear hinge-loss
model. A logistic curve fitted on rows that the descent has not seen turns margins into scores.

The model is fitted on a bounded sample of labelled rows: the ``max_rows`` ids of least hash among
those a caller allows. That sample reaches the driver as sparse indices; a row of it counts
``max_features`` features at most while fitting (the least of a hash order, so from its whole text).
Scoring is a column function on whole texts: no shuffle, and no column is lost.

Rows: null and empty texts have no features and get the score of the bias. Repeated rows get equal
scores. Label rows that contradict each other count as their mean, ties as good; null labels and
ids are ignored. Without labelled rows every score is 1; with labels of one class only, every
score is that class.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.common import hash_split, id_text, map_rows, mix, table

BUCKETS = 1 << 18
#: Bounds of the fit.
MAX_ROWS, MAX_FEATURES = 20_000, 4_000
#: Smoothing of counts, cost of a margin violation, passes over the rows.
ALPHA, COST, PASSES = 1.0, 1.0, 12


def shape_of(word: str) -> str:
    """Character classes in order, runs of a class once: X upper, x lower or caseless, 9 digit; others stay."""
    out, last = [], ""
    for c in word[:64]:
        kind = "9" if c.isdigit() else c if not c.isalpha() else "X" if c.isupper() else "x"
        if kind != last:
            out.append(kind)
        last = kind
    return "".join(out) + ("+" if len(word) > 64 else "")


class Features:
    """Distinct feature buckets of texts; remembers hashes of a bounded number of words."""

    def __init__(self, buckets: int = BUCKETS, remembered: int = 200_000) -> None:
        self.buckets, self.remembered = np.uint64(buckets), remembered
        self.seen: dict[str, tuple[int, int]] = {}
        self.mark = np.zeros(buckets, np.int64)

    def _word(self, word: str) -> tuple[int, int]:
        if len(self.seen) >= self.remembered:
            self.seen.clear()
        pair = self.seen[word] = (
            xxhash.xxh3_64_intdigest(word.lower().encode()), xxhash.xxh3_64_intdigest(shape_of(word).encode(), seed=1)
        )
        return pair

    def of(self, text: str | None) -> np.ndarray:
        words = (text or "").split()
        n = len(words)
        if not n:
            return np.empty(0, np.int64)
        get, make = self.seen.get, self._word
        flat = np.array([get(w) or make(w) for w in words], dtype=np.uint64)
        word, shape = flat[:, 0], flat[:, 1]
        again = np.zeros(n, np.uint64)
        for back in (1, 2):
            again[back:] += np.uint64(back) * (word[back:] == word[:-back]).astype(np.uint64)
        shape = mix(shape + again)
        grams = [mix(word + np.uint64(11)), mix(shape + np.uint64(21))]
        if n > 1:
            grams += [mix(mix(word[:-1]) + word[1:]), mix(mix(shape[:-1]) + shape[1:] + np.uint64(22))]
        if n > 2:
            grams.append(mix(mix(mix(shape[:-2]) + shape[1:-1]) + shape[2:] + np.uint64(23)))
        found = (np.concatenate(grams) % self.buckets).astype(np.int64)
        at = np.arange(len(found))
        self.mark[found] = at
        return found[self.mark[found] == at]  # each bucket once


@dataclass
class Model:
    """``weights`` hold hinge weight times ratio; ``ratios`` give the length that rows are divided by."""

    weights: np.ndarray
    ratios: np.ndarray
    bias: float
    slope: float
    offset: float

    def margins(self, rows: list[np.ndarray]) -> np.ndarray:
        out = np.full(len(rows), self.bias)
        for i, f in enumerate(rows):
            if len(f) and (size := math.sqrt(float(np.square(self.ratios[f]).sum()))) > 0:
                out[i] += self.weights[f].sum() / size
        return out

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(rows) + self.offset, -700, 700)))


def constant(score: int) -> Model:
    zero = np.zeros(BUCKETS)
    return Model(zero, zero, 0.0, 0.0, 30.0 if score else -30.0)


def log_count_ratios(rows: list[np.ndarray], good: np.ndarray, alpha: float = ALPHA) -> np.ndarray:
    counts = np.full((2, BUCKETS), alpha)
    for f, y in zip(rows, good, strict=True):
        counts[int(y), f] += 1
    seen = counts.sum(axis=0) > 2 * alpha + 1  # a bucket that one row alone has says nothing of others
    share = counts / counts.sum(axis=1, keepdims=True)
    return np.where(seen, np.log(share[1] / share[0]), 0.0)


def descend(rows: list[np.ndarray], good: np.ndarray, ratios: np.ndarray, cost: float = COST, passes: int = PASSES) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model, by dual coordinate descent with box [0, cost of the class].

    The rarer class costs more, in proportion.
    """
    y = np.where(good, 1.0, -1.0)
    costs = cost * len(y) / (2 * np.where(good, good.sum(), (~good).sum()))
    sizes = np.array([math.sqrt(float(np.square(ratios[f]).sum())) for f in rows])
    diagonal = 1.0 + (sizes > 0)  # rows of unit length, and the bias
    sizes[sizes == 0] = 1.0
    dual, weights, bias = np.zeros(len(y)), np.zeros(len(ratios)), 0.0
    order, rng = np.arange(len(y)), np.random.default_rng(7)
    for _ in range(passes):
        rng.shuffle(order)
        moved = 0.0
        for i in order:
            f = rows[i]
            v = ratios[f] / sizes[i]
            slack = y[i] * (float(weights[f] @ v) + bias) - 1.0
            new = min(max(dual[i] - slack / diagonal[i], 0.0), costs[i])
            step = (new - dual[i]) * y[i]
            if step:
                dual[i] = new
                weights[f] += step * v
                bias += step
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weights, bias


def _curve(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and offset of a logistic curve, by Newton steps on smoothed targets."""
    n1, n0 = good.sum(), (~good).sum()
    target = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(good, 0.5 / max(n1, 1), 0.5 / max(n0, 1))  # both classes alike: 0.5 is the even point
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        e, h = weight * (p - target), weight * p * (1 - p) + 1e-12
        gradient = np.array([e @ margins + 1e-4 * a, e.sum()])
        hessian = np.array([[h @ margins**2 + 1e-4, h @ margins], [h @ margins, h.sum() + 1e-9]])
        step = np.linalg.solve(hessian, gradient)
        a, b = a - float(np.clip(step[0], -2, 2)), b - float(np.clip(step[1], -2, 2))
        if np.abs(step).max() < 1e-7:
            break
    return max(a, 0.0), b


def fit(rows: list[np.ndarray], good: np.ndarray) -> Model:
    """``rows`` in hash order. Every fifth row is kept from the descent for the curve."""
    if not len(rows) or good.all() or not good.any():
        return constant(1 if not len(rows) else int(good[0]))
    aside = np.arange(len(rows)) % 5 == 4
    if not all(good[m].any() and not good[m].all() for m in (aside, ~aside)):
        aside = np.zeros(len(rows), bool)
    fitted = [f for f, out in zip(rows, aside, strict=True) if not out]
    ratios = log_count_ratios(fitted, good[~aside])
    weights, bias = descend(fitted, good[~aside], ratios)
    model = Model(weights * ratios, ratios, bias, 1.0, 0.0)
    kept = [f for f, out in zip(rows, aside, strict=True) if out or not aside.any()]
    model.slope, model.offset = _curve(model.margins(kept), good[aside] if aside.any() else good)
    return model


def train(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, max_rows: int = MAX_ROWS) -> Model:
    """A model from the labelled rows that ``allowed`` (on doc_id) admits."""
    spark = docs.sparkSession
    known = (
        labels.select(F.col("doc_id"), F.col(label).cast("double").alias("label"))
        .where("doc_id IS NOT NULL AND label IS NOT NULL").where(allowed)
        .groupBy("doc_id").agg((F.avg("label") >= 0.5).alias("good"))
    )
    order = F.xxhash64("doc_id")
    picked = known.orderBy(order, "doc_id").limit(max_rows).collect()
    if not picked:
        return constant(1)
    sample = spark.createDataFrame(picked, known.schema)

    def rows(source: Iterator[dict]) -> Iterator[tuple]:
        features = Features()
        for r in source:
            found = features.of(r["text"])
            if len(found) > MAX_FEATURES:
                found = found[np.argsort(mix(found.astype(np.uint64)))[:MAX_FEATURES]]
            yield r["doc_id"], r["good"], found.tolist()

    read = map_rows(
        id_text(docs).join(F.broadcast(sample), "doc_id").select("doc_id", "text", "good"), rows,
        "doc_id long, good boolean, found array<int>", batch=256,
    ).toArrow().combine_chunks()
    ids, lists = read.column("doc_id").to_numpy(), read.column("found").combine_chunks()
    flat, ends = lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())
    found = np.split(flat, ends[:-1])  # views: the sample is held once, four bytes a feature
    good = np.array(read.column("good").to_pylist(), dtype=bool)
    rank = np.lexsort((ids, mix(ids.view(np.uint64))))
    return fit([found[i] for i in rank], good[rank])


def scorer(spark: SparkSession, model: Model):
    """Column function: text to its score from 0 to 1."""
    shipped = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features, own = Features(), shipped.value
        for texts in parts:
            yield pd.Series(np.concatenate([own.scores([features.of(t)]) for t in texts]) if len(texts) else np.empty(0))

    return score


def trained_here() -> Column:
    """Two of three folds; the other is held out."""
    return hash_split(F.col("doc_id"), 3) != 1


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"), "quality", trained_here())
    scored = id_text(docs).select("doc_id", scorer(spark, model)("text").alias("score"))
    return scored.select(
        "doc_id", (~trained_here()).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
