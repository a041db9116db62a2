"""Language-model scoring over a subword lattice.

The pieces of a public subword vocabulary, bytes included, and the end of the text make a unigram
model. The probability of a text is the sum over all its segmentations, by a forward recursion in
log space. A piece never goes past a white-space boundary, so the recursion runs once per distinct
word (with the vocabulary's word-start mark) and a text is the sum of its words and the end.

Piece scores start from the vocabulary's ranks and are re-estimated by forward-backward on the
counts of all distinct training words: each word shares its count over its segmentations. Only
piece scores, bounded by the vocabulary, reach the driver; word counts stay in a table.

Scoring needs each word's training count, too, for the smoothed word model it is compared with. The
words of a bounded list (``FREQUENT``, those above a count) go to every task; each text's other
words are joined with the counts by shuffle. No word holds more of these than the list's threshold
says, so no key is hot. Nothing is cut: every word has its exact count.

Rows: null and empty texts are one end token; rows without id are trained on and scored as their
fold says (``hash_split``); repeated rows count as often as they occur and get equal scores.
Without training rows all counts are 0 and the pieces keep their starting scores.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import batched, repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.common import hash_split, id_text, map_rows, table
from mercato.session import stage

VOCABULARY = "piece_bpe_32k.model"
START = "▁"
#: Words that tasks hold with their counts; words held while counting.
FREQUENT, COUNTED = 300_000, 300_000
#: Rounds of re-estimation, and what every piece gets before them.
ROUNDS, SMOOTHING = 3, 0.05
#: Longest word in the vectorised recursion; longer ones run alone.
SHORT = 48


def words_of(text: str) -> list[bytes]:
    """Runs of anything but blanks, tabs, line feeds and the like (0x09-0x0D, 0x20), A-Z lower-cased."""
    return text.encode().lower().split()


def load_pieces(path: str) -> list[str]:
    """Pieces in rank order; a byte piece is written ``<0x..>``; control pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i))]
_BASIS, _PRIME, _ALL = 0xCBF29CE484222325, 0x100000001B3, (1 << 64) - 1


def _slots(hashes: np.ndarray, bits: int) -> np.ndarray:
    return ((hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


class Lattice:
    """Piece scores (natural logarithms) and the recursions over them."""

    def __init__(self, pieces: list[str], scores: np.ndarray, end: float) -> None:
        self.pieces, self.scores, self.end = pieces, scores, end
        self.index = {p: i for i, p in enumerate(pieces) if not re.fullmatch(r"<0x[0-9A-F]{2}>", p)}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(pieces) if p not in self.index}
        self.longest = max(map(len, self.index), default=1)
        self.single = {p for p in self.index if len(p) == 1}
        self.padded = np.append(scores, -np.inf)  # -1 is no piece
        self.table: tuple[np.ndarray, np.ndarray] | None = None

    @staticmethod
    def initial(pieces: list[str]) -> Lattice:
        """Ranks as a power law."""
        weight = 1 / (np.arange(len(pieces)) + 10.0)
        share = weight / weight.sum()
        return Lattice(pieces, np.log(0.9 * share), math.log(0.1))

    def _table(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of pieces by hash, two to a slot at most, and the whole hashes."""
        hashes = np.zeros(len(self.pieces) + 1, np.uint64)
        for piece, i in self.index.items():
            h = _BASIS
            for c in piece:
                h = (h ^ ord(c)) * _PRIME & _ALL
            hashes[i] = h
        known = np.array(sorted(self.index.values()), np.int64)
        bits = 16
        while True:  # until no slot is wanted by three
            slots = _slots(hashes[known], bits)
            order = np.argsort(slots, kind="stable")
            nth = np.arange(len(order)) - np.searchsorted(slots[order], slots[order])
            if nth.max(initial=0) < 2:
                break
            bits += 1
        table = np.full((2, 1 << bits), -1, np.int32)
        table[nth, slots[order]] = known[order]
        return table, hashes

    def _edges(self, words: list[str], n: int) -> dict[tuple[int, int], np.ndarray]:
        """Of words with n characters: piece of every span that is one in some word, -1 where it is none."""
        if self.table is None:
            self.table = self._table()
        table, hashes = self.table
        bits = int(table.shape[1]).bit_length() - 1
        codes = np.array(words, dtype=f"<U{n}").view(np.uint32).reshape(len(words), n).astype(np.uint64)
        found = {}
        for i in range(n):
            h = np.full(len(words), _BASIS, np.uint64)
            for j in range(i, min(n, i + self.longest)):
                h = (h ^ codes[:, j]) * np.uint64(_PRIME)
                slots = _slots(h, bits)
                first, second = table[0, slots], table[1, slots]
                ids = np.where(hashes[first] == h, first, np.where(hashes[second] == h, second, -1))
                if ids.max() >= 0:
                    found[i, j + 1] = ids
        return found

    def _forward(self, edges: dict, n: int, m: int) -> np.ndarray:
        reach = np.full((n + 1, m), -np.inf)
        reach[0] = 0.0
        into = defaultdict(list)
        for (i, j), ids in edges.items():
            into[j].append((i, ids))
        for j in range(1, n + 1):
            for i, ids in into[j]:
                reach[j] = np.logaddexp(reach[j], reach[i] + self.padded[ids])
        return reach

    def _alone(self, word: str) -> tuple[list[tuple[int, int, list[int]]], list[float]]:
        """Spans (start, end, pieces) of one word, unknown characters by their bytes, and the forward scores."""
        n, spans, reach = len(word), [], [0.0] + [-math.inf] * len(word)
        by_end = defaultdict(list)
        for i in range(n):
            if word[i] not in self.single:
                by_end[i + 1].append((i, [self.bytes[b] for b in word[i].encode() if b in self.bytes]))
            for j in range(i + 1, min(n, i + self.longest) + 1):
                if (k := self.index.get(word[i:j])) is not None:
                    by_end[j].append((i, [k]))
        for j in range(1, n + 1):
            terms = [reach[i] + sum(self.scores[k] for k in ids) for i, ids in by_end[j]]
            most = max(terms, default=-math.inf)
            if most > -math.inf:
                reach[j] = most + math.log(sum(math.exp(t - most) for t in terms))
            spans += [(i, j, ids) for i, ids in by_end[j]]
        return spans, reach

    def _groups(self, words: list[str]) -> tuple[dict[int, list[int]], list[int]]:
        """Positions of words by their marked length, and of those that run alone."""
        groups, alone = defaultdict(list), []
        for at, w in enumerate(words):
            if len(w) <= SHORT and self.single.issuperset(w):
                groups[len(w) + 1].append(at)
            else:
                alone.append(at)
        return groups, alone

    def log_probabilities(self, words: list[str]) -> np.ndarray:
        """Of each word (given without its mark), summed over all segmentations."""
        out = np.empty(len(words))
        groups, alone = self._groups(words)
        for n, members in groups.items():
            for part in (members[i : i + 4096] for i in range(0, len(members), 4096)):
                marked = [START + words[at] for at in part]
                out[part] = self._forward(self._edges(marked, n), n, len(part))[n]
        for at in alone:
            out[at] = self._alone(START + words[at])[1][-1]
        return out

    def expected(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """How often each piece is used by words that occur ``counts`` times, on average over segmentations."""
        total = np.zeros(len(self.pieces) + 1)
        groups, alone = self._groups(words)
        for n, members in groups.items():
            for part in (members[i : i + 4096] for i in range(0, len(members), 4096)):
                edges = self._edges([START + words[at] for at in part], n)
                ahead = self._forward(edges, n, len(part))
                back = np.full((n + 1, len(part)), -np.inf)
                back[n] = 0.0
                out_of = defaultdict(list)
                for (i, j), ids in edges.items():
                    out_of[i].append((j, ids))
                for i in range(n - 1, -1, -1):
                    for j, ids in out_of[i]:
                        back[i] = np.logaddexp(back[i], back[j] + self.padded[ids])
                whole, weight = ahead[n], counts[part]
                for (i, j), ids in edges.items():
                    share = np.exp(ahead[i] + self.padded[ids] + back[j] - whole) * weight
                    np.add.at(total, ids, share)  # -1 is the entry of no piece
        for at in alone:
            spans, ahead = self._alone(START + words[at])
            back = [-math.inf] * (len(ahead) - 1) + [0.0]
            for i, j, ids in sorted(spans, reverse=True):
                back[i] = float(np.logaddexp(back[i], back[j] + sum(self.scores[k] for k in ids)))
            for i, j, ids in spans:
                for k in ids:
                    total[k] += counts[at] * math.exp(ahead[i] + sum(self.scores[x] for x in ids) + back[j] - ahead[-1])
        return total[:-1]

    def reestimated(self, used: np.ndarray, ends: float) -> Lattice:
        weight = used + SMOOTHING
        whole = weight.sum() + ends + SMOOTHING
        return Lattice(self.pieces, np.log(weight / whole), math.log((ends + SMOOTHING) / whole))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts; the word "" stands for the end of a text. Counted in the tasks first."""

    def rows(source: Iterator[dict]) -> Iterator[tuple]:
        held: Counter[bytes] = Counter()

        def counted() -> Iterator[tuple]:
            yield from ((w.decode(), n) for w, n in held.items())
            held.clear()

        for r in source:
            held.update(words_of(r["text"]))
            held[b""] += 1
            if len(held) > COUNTED:
                yield from counted()
        yield from counted()

    return map_rows(docs.select("text"), rows, "word string, n long", batch=20_000).groupBy("word").agg(F.sum("n").alias("n"))


def _words_and_counts(rows: Iterator[dict], size: int = 20_000) -> Iterator[tuple[list[str], np.ndarray]]:
    for part in batched(rows, size):
        yield [r["word"] for r in part], np.array([r["n"] for r in part], dtype=np.float64)


def train(counts: DataFrame, pieces: list[str], ends: int, rounds: int = ROUNDS) -> Lattice:
    """Piece scores from a staged table of word counts; each round is one pass over it."""
    lattice = Lattice.initial(pieces)
    words = counts.where("word <> ''")
    for _ in range(rounds if ends else 0):
        shipped = counts.sparkSession.sparkContext.broadcast(lattice)

        def rows(source: Iterator[dict], shipped=shipped) -> Iterator[tuple]:
            use, total = shipped.value, np.zeros(len(pieces))
            for part, n in _words_and_counts(source):
                total += use.expected(part, n)
            at = np.flatnonzero(total)
            yield from zip(at.tolist(), total[at].tolist(), strict=True)

        used = np.zeros(len(pieces))
        # one row per piece
        for piece, amount in map_rows(words, rows, "piece int, used double").groupBy("piece").agg(F.sum("used")).collect():
            used[piece] = amount
        lattice = lattice.reestimated(used, float(ends))
    return lattice


def _listed(counts: DataFrame, limit: int) -> int:
    """Least count such that no more than ``limit`` words have it or more."""
    words, least = 0, None
    for n, many in counts.groupBy("n").count().orderBy(F.desc("n")).toLocalIterator():
        if words + many > limit:
            break
        words, least = words + many, n
    return least if least is not None else 1 << 62


def scored(docs: DataFrame, trained_on: Column, pieces: list[str], rounds: int = ROUNDS, frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of (doc_id, text) rows."""
    spark = docs.sparkSession
    counts = stage(word_counts(docs.where(trained_on)), "word-counts")
    tokens, kinds, ends = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.when(F.col("word") == "", F.col("n"))), F.lit(0))
    ).first()
    lattice = train(counts, pieces, ends, rounds)
    model = spark.sparkContext.broadcast(lattice)
    least, whole = _listed(counts, frequent), math.log10(tokens + kinds + 1)

    def with_scores(source: Iterator[dict]) -> Iterator[tuple]:
        for part, n in _words_and_counts(source):
            yield from zip(part, n.astype(np.int64).tolist(), model.value.log_probabilities(part).tolist(), strict=True)

    listed = map_rows(
        counts.where((F.col("n") >= least) & (F.col("word") != "")), with_scores, "word string, n long, log_p double", batch=20_000
    ).toArrow()
    known = spark.sparkContext.broadcast((
        {w.encode(): i for i, w in enumerate(listed.column("word").to_pylist())},
        np.append(np.log10(listed.column("n").to_numpy() + 1.0) - whole, 0.0),
        np.append(listed.column("log_p").to_numpy(), 0.0),
    ))

    def rows(source: Iterator[dict]) -> Iterator[tuple]:
        index, base, log_p = known.value
        get = index.get
        for r in source:
            words = words_of(r["text"])
            at = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
            other = Counter(words[i] for i in np.flatnonzero(at < 0).tolist())
            yield (
                r["doc_id"], len(words), int((at >= 0).sum()), float(base[at].sum()), float(log_p[at].sum()),
                [{"word": w.decode(), "times": n} for w, n in other.items()],
            )

    key = docs.schema["doc_id"].dataType.simpleString()
    found = stage(
        map_rows(
            docs, rows,
            f"doc_id {key}, words long, known long, base double, log_p double, other array<struct<word:string,times:int>>", batch=512,
        ).withColumn("row", F.monotonically_increasing_id()),
        "listed-word-scores",
    )

    @F.pandas_udf("double")
    def log_probability(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        last: dict[str, float] = {}  # the rows of a word follow one another, batch by batch
        for words in parts:
            new = [w for w in dict.fromkeys(words) if w not in last]
            last = {w: last[w] for w in dict.fromkeys(words) if w in last} | dict(zip(new, model.value.log_probabilities(new).tolist(), strict=True))
            yield words.map(last)

    other = (
        found.where(F.size("other") > 0).select("row", F.inline("other"))
        .join(counts.where(F.col("n") < least), "word", "left")
        .select("row", "times", F.coalesce("n", F.lit(0)).alias("n"), log_probability("word").alias("log_p"))
        .groupBy("row").agg(
            F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("known2"),
            F.sum(F.col("times") * (F.log10(F.col("n") + 1.0) - whole)).alias("base2"),
            F.sum(F.col("times") * F.col("log_p")).alias("log_p2"),
        )
    )
    zero = lambda name: F.coalesce(name, F.lit(0))
    return found.join(other, "row", "left").select(
        "doc_id",
        (F.col("words") + 1).alias("n_tokens"),
        (F.col("known") + zero("known2") + F.lit(int(ends > 0))).cast("bigint").alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + zero("base2") + F.lit(math.log10(ends + 1) - whole)).alias("base_score"),
        ((F.col("log_p") + zero("log_p2") + F.lit(lattice.end)) / F.lit(math.log(10))).alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = id_text(table(spark, sf_dir, "documents"))
    held_out = hash_split(F.col("doc_id"), 7) == 2
    result = scored(docs, ~held_out, load_pieces(public_tokenizers.path(VOCABULARY)))
    return result.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
