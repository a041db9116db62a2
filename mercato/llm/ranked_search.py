r"""Ranked lexical search: the best documents of each query by the Best Position Algorithm.

1. One pass over the documents counts, per task and then in all: documents with terms, their terms,
   and per query term the documents that hold it. Term weights follow from these counts.
2. A second pass cuts its documents into blocks of ``BLOCK`` bytes of terms (or one text). A block has
   one impact list per query term: its documents by falling impact. For each query the lists of its
   terms are read from the top. A document met in one list is looked up directly in all others, which
   gives its score and its place in each list. In each list the best position is the last place up to
   which all places have been seen, by reading or by look-up; what comes after it bounds the list's
   share in the score of any document not yet seen. Reading stops once the sum of these bounds is
   strictly below the score of the k-th document found so far, in this block or before it in the
   task, so documents of equal score are never missed.
3. The at most k documents of each query and task are ranked over all tasks.

Queries are shipped in parts of at most ``QUERY_TERMS`` terms (or one query), a pass for each part, so
what a task holds of them is bounded; the weights of the part's terms go along.

Score: a document's normaliser m is ``100 - 75 + (75 * n * N) div L``, a term adds
``w * ((10^9 * tf) div (1000 * tf + 8 * m))`` for each time it is in the query, where
w = floor(1000 * ln((2N + 2) / (2 df + 1))). All but the logarithm is exact in 64 bits.

Rows: terms are runs of letters, digits and characters above 127, A-Z in lower case. Terms are
compared by 64-bit hashes. A null or empty text has no terms, is not counted and never found; a query
without terms, without matches or without id gives no rows. Each row is a document or a query of its
own, also if ids repeat (equal query ids: their texts are one query each, numbered apart). Documents
without id rank behind others of equal score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.llm.common import ALPHANUMERIC, hashed_words, importable, map_rows, table
from mercato.session import stage

#: Bytes of query terms in a block of documents; terms (with repeats) of the queries that one pass serves; first depth of reading.
BLOCK, QUERY_TERMS, DEPTH = 1 << 24, 1 << 20, 16


def terms_of(text: str) -> np.ndarray:
    return hashed_words(text.encode().translate(ALPHANUMERIC))[0]


class Vocabulary:
    """Places of known term hashes; a small table of bits rules most other terms out first."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes = np.unique(hashes)
        bits = 12
        while 1 << bits < 16 * len(self.hashes):
            bits += 1
        self.mask = np.uint64((1 << bits) - 1)
        self.maybe = np.zeros(1 << bits, bool)
        self.maybe[(self.hashes & self.mask).astype(np.int64)] = True

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash that is known; others are left out."""
        hashes = hashes[self.maybe[(hashes & self.mask).astype(np.int64)]]
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        return at[self.hashes[at] == hashes] if len(self.hashes) else at[:0]


def counted(docs: DataFrame, known: Vocabulary) -> DataFrame:
    """(term, n): documents that hold each known term; under -1 all documents with terms, under -2 their terms."""
    shipped = docs.sparkSession.sparkContext.broadcast(known)

    def rows(source: Iterator[dict]) -> Iterator[tuple]:
        known = shipped.value
        held, total, df = 0, 0, np.zeros(len(known.hashes), np.int64)
        for r in source:
            found = terms_of(r["text"])
            if len(found):
                held, total = held + 1, total + len(found)
                df[np.unique(known.places(found))] += 1
        yield -1, held
        yield -2, total
        some = np.flatnonzero(df)
        if len(some):
            yield [some, df[some]]

    return map_rows(docs.select("text"), rows, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


class Block:
    """Impact lists of a block of documents, and direct access to them."""

    def __init__(self, rows: list[tuple[object, np.ndarray, int]], weights: np.ndarray, documents: int, terms: int) -> None:
        self.ids, self.width = [r[0] for r in rows], max(1, len(weights))
        where = np.concatenate([np.full(len(r[1]), i, np.int64) for i, r in enumerate(rows)] or [np.empty(0, np.int64)])
        what = np.concatenate([r[1] for r in rows] or [np.empty(0, np.int64)])
        keys, tf = np.unique(where * self.width + what, return_counts=True)
        doc, term = keys // self.width, keys % self.width
        m = np.array([25 + 75 * r[2] * documents // terms for r in rows], np.int64)
        impact = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
        order = np.lexsort((doc, -impact, term))
        self.impact, self.doc = impact[order], doc[order]  # by list, by falling impact
        self.starts = np.searchsorted(term[order], np.arange(self.width + 1))
        self.keys, self.entry = keys, np.empty(len(keys), np.int64)
        self.entry[order] = np.arange(len(keys))  # where in the lists each (document, term) is

    def best(self, terms: np.ndarray, times: np.ndarray, k: int, known: list[int]) -> list[tuple[int, int]]:
        """(score, document) of at most k documents that can be among the best k; ``known``: scores found before."""
        low, high = self.starts[terms], self.starts[terms + 1]
        some = high > low
        terms, times, low, high = terms[some], times[some], low[some], high[some]
        if not len(terms):
            return []
        best, depth = low.copy(), 0
        seen, met = np.zeros(int((high - low).sum()), bool), np.zeros(len(self.ids), bool)
        base = np.r_[0, np.cumsum(high - low)[:-1]] - low  # entry + base: place in ``seen``
        scores: list[np.ndarray] = []
        found: list[np.ndarray] = []
        before = np.array(known, np.int64)
        while True:
            depth = depth * 2 or DEPTH
            read = np.concatenate([self.doc[a:b] for a, b in zip(low, np.minimum(low + depth, high), strict=True)])
            new = np.unique(read[~met[read]])
            met[new] = True
            # direct access: each new document in every list
            keys = new[:, None] * self.width + terms[None, :]
            at = np.searchsorted(self.keys, keys)
            at[at == len(self.keys)] = 0
            there = self.keys[at] == keys
            entry = self.entry[at]
            scores.append((np.where(there, self.impact[entry], 0) * times).sum(axis=1))
            found.append(new)
            seen[(entry + base)[there]] = True
            bound = 0
            for j in range(len(terms)):
                a, b = best[j] + base[j], high[j] + base[j]
                ahead = seen[a:b]
                best[j] += len(ahead) if ahead.all() else int(ahead.argmin())
                if best[j] < high[j]:
                    bound += int(self.impact[best[j]] * times[j])
            score, doc = np.concatenate(scores), np.concatenate(found)
            reached = np.concatenate([before, score])
            kth = int(np.partition(reached, -k)[-k]) if len(reached) >= k else 0
            if bound == 0 or bound < kth:
                break
        keep = score >= max(1, kth)
        return list(zip(score[keep].tolist(), doc[keep].tolist(), strict=True))


def _ranked(rows: list[tuple], k: int) -> list[tuple]:
    """The best k of (score, id): falling score, then rising id, none last."""
    return sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] if r[1] is not None else 0))[:k]


def searched(docs: DataFrame, queries: list[tuple[int, np.ndarray]], weights: np.ndarray, known: Vocabulary, documents: int, terms: int, k: int) -> DataFrame:
    """(query, doc_id, score): the best k documents of each query in each task."""
    parts = [(q, *np.unique(t, return_counts=True)) for q, t in queries]
    shipped = docs.sparkSession.sparkContext.broadcast((parts, weights, known))

    def rows(source: Iterator[dict]) -> Iterator[tuple]:
        parts, weights, known = shipped.value
        best: list[list[tuple]] = [[] for _ in parts]
        held: list[tuple[object, np.ndarray, int]] = []

        def search() -> None:
            block = Block(held, weights, documents, terms)
            for i, (_, which, times) in enumerate(parts):
                found = block.best(which, times, k, [s for s, _ in best[i]])
                if found:
                    best[i] = _ranked(best[i] + [(s, block.ids[d]) for s, d in found], k)

        size = 0
        for r in source:
            found = terms_of(r["text"])
            places = known.places(found)
            places = places[weights[places] > 0]
            if len(places):
                held.append((r["doc_id"], places, len(found)))
                size += 8 * len(places) + 100
                if size > BLOCK:
                    search()
                    held, size = [], 0
        if held:
            search()
        for (query, _, _), found in zip(parts, best, strict=True):
            for score, doc in found:
                yield query, doc, score

    key = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(docs, rows, f"query long, doc_id {key}, score long")


def _parts(queries: DataFrame) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Queries (query, text) in parts of bounded size, one at a time on the driver."""
    held, size = [], 0
    for r in queries.toLocalIterator():
        found = terms_of(r["text"])
        if len(found):
            held.append((r["query"], found))
            size += len(found)
            if size >= QUERY_TERMS:
                yield held
                held, size = [], 0
    if held:
        yield held


def search(docs: DataFrame, queries: DataFrame, k: int = 10, doc_id: str = "doc_id", query_id: str = "item_id", text: str = "text") -> DataFrame:
    """(<query_id>, rank, <doc_id>, score) of the best k documents of each row of ``queries``."""
    spark = importable(docs.sparkSession)
    docs = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).where("text IS NOT NULL")
    numbered = queries.where(queries[query_id].isNotNull() & queries[text].isNotNull()).select(
        F.monotonically_increasing_id().alias("query"), queries[query_id].alias("name"), queries[text].alias("text")
    )
    numbered = stage(numbered, "search-queries")
    found = None
    for part in _parts(numbered):
        known = Vocabulary(np.concatenate([t for _, t in part]))
        counts = {r["term"]: r["n"] for r in counted(docs, known).toLocalIterator()}
        documents, terms = counts.pop(-1, 0) or 0, counts.pop(-2, 0) or 0
        if not terms:
            break
        weights = np.zeros(len(known.hashes), np.int64)
        for term, n in counts.items():
            weights[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1)))
        placed = [(q, known.places(t)) for q, t in part]
        one = stage(searched(docs, placed, weights, known, documents, terms, k), "search-results")
        found = one if found is None else found.unionByName(one)
    if found is None:
        found = spark.createDataFrame([], f"query long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, score long")
    place = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    return ranked.join(numbered.select("query", "name"), "query").select(
        F.col("name").alias(query_id), "rank", F.col("doc_id").alias(doc_id), "score"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)
ORACLE_SQL = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
size AS (SELECT r, doc_id, len(w)::BIGINT AS n FROM doc WHERE len(w) > 0),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM size),
item AS (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS w FROM benchmark WHERE item_id IS NOT NULL),
item_term AS (SELECT q, t, count(*)::BIGINT AS times FROM (SELECT q, unnest(w) AS t FROM item) GROUP BY q, t),
entry AS (
  SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS t FROM doc)
  WHERE t IN (SELECT t FROM item_term) GROUP BY r, t),
weight AS (
  SELECT t, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM entry, total GROUP BY t),
scored AS (
  SELECT q, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))))::BIGINT AS score
  FROM entry JOIN size USING (r) JOIN weight USING (t) JOIN item_term USING (t), total GROUP BY q, r),
ranked AS (
  SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM scored JOIN size USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked JOIN item USING (q) WHERE rank <= 10"""
