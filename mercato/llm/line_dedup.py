r"""Line dedup: an exact set-similarity join of lines; later matches go.

A line is the set of its words (split at ASCII white space, A-Z lower-cased). A line goes if an
earlier one, by (document id, line number), has a set of Jaccard similarity ``THRESHOLD`` percent
or more, whether that one stays or not. So of a chain of similar lines only the first stays.

1. One pass over the texts counts words by hash in a table of fixed size (the rarity that orders
   them; ties by hash) and gathers equal sets: in each task first, then by digest.
2. A second pass sends, for each set of a task, once and with its least place there, its rarest ``n - ceil(0.8 n) + 1``
   words (its prefix) to where lines with that word meet. Similar lines share a prefix word. Words that
   the table knows of one set only stay at home: no other set has them.
3. There, lines of a word are compared in one vectorised sweep: length filter, positional filter
   (what the ranks of the shared word leave possible), and a parity filter: the 128-bit parities of
   two sets differ in no more bits than the sets differ in words. A line keeps its ``FIRST``
   earliest candidates per word.
4. Candidates are verified on the lines' words, read again from their documents. A line that has
   more candidates than it kept, and no match among those, is swept again for all of them.

Words that may stand in more than ``HOT`` lines do not meet in one task: their rows are spread,
counted, and compared in blocks. Sets of fewer than four words match equal sets only.

Rows: lines are split at "\n"; a line without words always stays; null and empty texts have one
such line. Rows without id neither lose lines nor make others lose any. Rows that repeat an id are
one document: lines at equal places do not count as earlier, and lose the same places.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import batched

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.common import BROADCAST_KEYS, SPACED, BitFilter, hashed_words, id_text, map_rows, mix, table
from mercato.session import stage

ANY_WORD = r"[^\x20\x09-\x0D]"
#: Similarity in percent; slots of the rarity table (4 bytes each); lines of a word in one task and in
#: a block; candidates that a line keeps per word; sets remembered per task; prefix words held per task;
#: pairs compared at a time.
THRESHOLD, SLOTS, HOT, BLOCK, FIRST, REMEMBERED, HELD, PAIRS = 80, 1 << 21, 8192, 2048, 8, 150_000, 1 << 20, 1 << 18
#: Documents whose texts are split at a time.
TOGETHER = 128


class Lines:
    """Word sets of the lines of some documents, side by side: the distinct words of each line by hash."""

    def __init__(self, docs: list[dict]) -> None:
        texts = [r["text"].encode() for r in docs]
        self.counts = [t.count(b"\n") + 1 for t in texts]
        data = b"\n".join(texts)
        hashes, starts, _ = hashed_words(data.translate(SPACED))
        ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
        line = np.searchsorted(ends, starts)  # over all documents
        order = np.lexsort((hashes, line))
        hashes, line = hashes[order], line[order]
        new = np.ones(len(line), bool)
        new[1:] = (line[1:] != line[:-1]) | (hashes[1:] != hashes[:-1])
        self.words, line = hashes[new], line[new]
        self.starts = np.flatnonzero(np.append(True, line[1:] != line[:-1])) if len(line) else line
        self.sizes = np.diff(np.append(self.starts, len(line)))
        self.owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        line, first = line[self.starts], np.cumsum([0, *self.counts])
        at = np.searchsorted(first, line, side="right") - 1
        self.doc = [docs[i]["doc_id"] for i in at]
        self.line = (line - first[at]).tolist()

    def digests(self) -> list[tuple[int, int]]:
        """128 bits of each set, the same in any order."""
        if not len(self.sizes):
            return []
        with np.errstate(over="ignore"):
            pair = [np.add.reduceat(mix(self.words + np.uint64(k)), self.starts) + self.sizes.astype(np.uint64) for k in (1, 2)]
        return list(zip(*(p.view(np.int64).tolist() for p in pair), strict=True))

    def parities(self) -> tuple[np.ndarray, np.ndarray]:
        bit = self.words >> np.uint64(57)
        one = np.uint64(1) << (bit & np.uint64(63))
        zero = np.uint64(0)
        return (
            np.bitwise_xor.reduceat(np.where(bit < 64, one, zero), self.starts),
            np.bitwise_xor.reduceat(np.where(bit < 64, zero, one), self.starts),
        )

    def prefixes(self, rarity: np.ndarray, threshold: int, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(line, word, rank, rarity) of the prefix words of chosen lines, rarest first, without those of one set."""
        count = rarity[(self.words & np.uint64(len(rarity) - 1)).astype(np.int64)].astype(np.uint64)
        # rarity and hash in one number; words whose numbers are equal are equal in all that orders them
        order = np.argsort((np.minimum(count, np.uint64((1 << 24) - 1)) << np.uint64(40)) | (self.words >> np.uint64(24)), kind="stable")
        order = order[np.argsort(self.owner[order], kind="stable")]
        rank = np.arange(len(order)) - self.starts[self.owner[order]]
        n = self.sizes
        length = n - -(-threshold * n // 100) + 1
        keep = (rank < length[self.owner[order]]) & chosen[self.owner[order]] & (count[order] != 1)
        return self.owner[order][keep], self.words[order][keep], rank[keep], count[order][keep]


def _survey(docs: DataFrame) -> DataFrame:
    """Rows of three kinds: 0 (a, b, doc_id, line): a set and its first place in a task; 1 (doc_id, line):
    a later place of a set in that task; 2 (a, b): slot of the rarity table and its lines; 3 (doc_id, a): lines."""

    def rows(source: Iterator[dict]) -> Iterator[tuple]:
        slots = np.zeros(SLOTS, np.int32)
        first: dict[tuple[int, int], tuple] = {}
        for part in batched(source, TOGETHER):
            lines = Lines(part)
            for r, n in zip(part, lines.counts, strict=True):
                yield 3, n, None, r["doc_id"], None
            new = np.zeros(len(lines.sizes), bool)
            for i, (d, doc, at) in enumerate(zip(lines.digests(), lines.doc, lines.line, strict=True)):
                if doc is None:
                    continue
                place, known = (doc, at), first.get(d)
                if known is None:
                    if len(first) >= REMEMBERED:
                        for (a, b), (x, y) in first.items():
                            yield 0, a, b, x, y
                        first.clear()
                    first[d], new[i] = place, True
                elif place != known:
                    first[d] = min(place, known)
                    yield 1, None, None, *max(place, known)
            np.add.at(slots, (lines.words[new[lines.owner]] & np.uint64(SLOTS - 1)).astype(np.int64), 1)
        for (a, b), (x, y) in first.items():
            yield 0, a, b, x, y
        at = np.flatnonzero(slots)
        none = pa.nulls(len(at))
        yield [np.full(len(at), 2, np.int32), at, slots[at].astype(np.int64), none, none]

    key = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(docs, rows, f"kind int, a long, b long, doc_id {key}, line int", batch=10_000)


def _rarity(survey: DataFrame) -> np.ndarray:
    """The table of fixed size."""
    rows = survey.where("kind = 2").groupBy("a").agg(F.least(F.sum("b"), F.lit(2**31 - 1)).cast("int").alias("b"))
    rows = rows.select(F.col("a").cast("int"), "b").toArrow()  # at most SLOTS rows of 8 bytes
    table = np.zeros(SLOTS, np.uint32)
    table[rows.column("a").to_numpy()] = rows.column("b").to_numpy()
    return table


_POSTING = "word long, p long, q long, n int, rank int, doc_id {key}, line int"


def _place(doc, line):
    """A number of each line, from the hash of its document's id and its number; of columns or of arrays."""
    if isinstance(doc, Column):
        line = line.cast("bigint")
        return doc.bitwiseXOR(line.bitwiseOR(F.shiftleft(line, 32)))
    return doc ^ (line | (line << np.uint64(32)))


def _postings(docs: DataFrame, rarity, threshold: int, key: str, words=None, ids=None) -> DataFrame:
    """A row per prefix word of each set in a task, with the set's least place there, and whether the
    word may be hot. In any order of the rows a set posts once, as the survey counts it, until
    ``REMEMBERED`` sets or ``HELD`` rows are held.

    ``words``: a broadcast bit filter; other words are left out. ``ids``: one of hashes of ids; other
    documents are left out.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = rarity.value
        first: dict[tuple[int, int], int] = {}  # number of each set
        places: list[tuple] = []
        held: list[tuple[np.ndarray, ...]] = []

        def take(part: list[dict]) -> None:
            lines = Lines(part)
            number = np.full(len(lines.sizes), -1, np.int32)  # of sets that are new
            for i, (d, doc, at) in enumerate(zip(lines.digests(), lines.doc, lines.line, strict=True)):
                if doc is None or lines.sizes[i] <= 3:
                    continue
                known = first.setdefault(d, len(places))
                if known == len(places):
                    places.append((doc, at))
                    number[i] = known
                elif (doc, at) < places[known]:
                    places[known] = doc, at
            chosen = number >= 0
            if not chosen.any():
                return
            owner, word, rank, count = lines.prefixes(counts, threshold, chosen)
            if words is not None:
                kept = words.value.has(word)
                owner, word, rank, count = owner[kept], word[kept], rank[kept], count[kept]
            if not len(word):
                return
            nth = (np.cumsum(chosen) - 1).astype(np.int32)[owner]
            p, q = lines.parities()
            held.append((
                word, rank.astype(np.int32), count > HOT, nth,
                number[chosen], p[chosen], q[chosen], lines.sizes[chosen].astype(np.int32),
            ))

        def posted() -> Iterator[pa.RecordBatch]:
            for word, rank, hot, nth, number, p, q, n in held:
                doc = pa.array([places[k][0] for k in number.tolist()])
                line = np.array([places[k][1] for k in number.tolist()], np.int32)
                yield pa.record_batch([
                    pa.array(word.view(np.int64)), pa.array(p[nth].view(np.int64)), pa.array(q[nth].view(np.int64)),
                    pa.array(n[nth]), pa.array(rank), doc.take(pa.array(nth)), pa.array(line[nth]), pa.array(hot),
                ], names=["word", "p", "q", "n", "rank", "doc_id", "line", "hot"])
            first.clear()
            places.clear()
            held.clear()

        for b in batches:
            if ids is not None:
                b = b.filter(pa.array(ids.value.has(b.column("h").to_numpy().view(np.uint64))))
            for start in range(0, b.num_rows, TOGETHER):
                take(b.slice(start, TOGETHER).to_pylist())
                if len(places) >= REMEMBERED or sum(len(h[0]) for h in held) >= HELD:
                    yield from posted()
        yield from posted()

    docs = docs if ids is None else docs.withColumn("h", F.xxhash64("doc_id"))
    return docs.mapInArrow(rows, _POSTING.format(key=key) + ", hot boolean")


def _possible(part: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray, threshold: int) -> np.ndarray:
    """Which pairs of rows pass the length, positional and parity filters."""
    a, b = part["n"][i].astype(np.int64), part["n"][j].astype(np.int64)
    need = -(-threshold * (a + b) // (100 + threshold))  # words in common
    x, y = part["rank"][i], part["rank"][j]
    ok = (100 * np.minimum(a, b) >= threshold * np.maximum(a, b)) & (np.minimum(x, y) + np.minimum(a - x, b - y) >= need)
    apart = np.bitwise_count(part["p"][i] ^ part["p"][j]).astype(np.int64) + np.bitwise_count(part["q"][i] ^ part["q"][j])
    return ok & (apart <= a + b - 2 * need)


def _sweep(part: dict[str, np.ndarray], threshold: int, first: int | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs (later, earlier) of rows with equal words that may match: of each row the ``first``
    earliest (all, if None). Rows are sorted by word, then place; only ``open`` ones are the later
    of a pair. Third: whether a row had more. ``PAIRS`` are compared at a time, or those of one row."""
    word = part["word"]
    starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
    begin = np.repeat(starts, np.diff(np.append(starts, len(word))))  # first row of each row's word
    rows = np.flatnonzero(part["open"] & (begin < np.arange(len(word))))
    before = rows - begin[rows]
    total, at = np.cumsum(before), 0
    while at < len(rows):
        end = max(at + 1, int(np.searchsorted(total, total[at] - before[at] + PAIRS, side="right")))
        n = before[at:end]
        x = np.repeat(rows[at:end], n)
        y = np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n) + begin[x]
        a, b = part["n"][x].astype(np.int64), part["n"][y].astype(np.int64)
        close = 100 * np.minimum(a, b) >= threshold * np.maximum(a, b)
        x, y = x[close], y[close]
        ok = _possible(part, x, y, threshold)
        x, y = x[ok], y[ok]
        apart = (part["doc"][x] != part["doc"][y]) | (part["line"][x] != part["line"][y])
        yield _earliest(x[apart], y[apart], first)
        at = end


def _earliest(x: np.ndarray, y: np.ndarray, first: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    if first is None or not len(x):
        return x, y, np.zeros(len(x), bool)
    starts = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
    sizes = np.diff(np.append(starts, len(x)))
    nth = np.arange(len(x)) - np.repeat(starts, sizes)
    keep = nth < first
    return x[keep], y[keep], np.repeat(sizes > first, sizes)[keep]


def _columns(table: pa.Table) -> dict[str, np.ndarray]:
    get = lambda name: table.column(name).combine_chunks().to_numpy(zero_copy_only=False)
    part = {name: get(name) for name in ("word", "n", "rank", "line", "open")}
    part |= {name: get(name).astype(np.int64).view(np.uint64) for name in ("p", "q")}
    part["doc"] = get("doc_id")
    return part


def _pairs(part: dict[str, np.ndarray], found: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pd.DataFrame:
    x, y, more = found
    return pd.DataFrame({
        "x_doc": part["doc"][x], "x_line": part["line"][x], "y_doc": part["doc"][y], "y_line": part["line"][y], "more": more,
    })


_PAIR = "x_doc {key}, x_line int, y_doc {key}, y_line int, more boolean"


def _pair_schema(kind: pa.DataType) -> pa.Schema:
    return pa.schema([("x_doc", kind), ("x_line", pa.int32()), ("y_doc", kind), ("y_line", pa.int32()), ("more", pa.bool_())])


def _met(rows: DataFrame, threshold: int, first: int | None, key: str, wanted=None) -> DataFrame:
    """Staged candidate pairs among the rows of each word, which meet in one task. Spark sorts by word
    alone, which is cheaper than by three keys; those of a word are put in order here. Rows of a
    word that may be hot are spread over all tasks and come out as they are, ``word`` not null.

    ``wanted``: a broadcast bit filter of the places that are open; all, if None. It is asked here, where
    a Python worker holds the rows anyway, as each kind of worker costs an executor its own memory.
    """
    names = ["word", "p", "q", "n", "rank", "open"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def swept(table: pa.Table) -> Iterator[pa.RecordBatch]:
            table = table.sort_by([(c, "ascending") for c in ("word", "doc_id", "line")])
            part, found = _columns(table), []

            def pairs() -> Iterator[pa.RecordBatch]:
                out = _pairs(part, tuple(map(np.concatenate, zip(*found, strict=True)))).drop_duplicates()
                made = pa.Table.from_pandas(out, schema=_pair_schema(table.schema.field("doc_id").type), preserve_index=False)
                for c in names:
                    made = made.append_column(table.schema.field(c).with_nullable(True), pa.nulls(len(out), table.schema.field(c).type))
                found.clear()
                yield from made.to_batches()

            for some in _sweep(part, threshold, first):
                found.append(some)
                if sum(len(f[0]) for f in found) >= PAIRS:
                    yield from pairs()
            if found:
                yield from pairs()

        for b in batches:
            is_open = np.ones(b.num_rows, bool) if wanted is None else wanted.value.has(b.column("at").to_numpy().view(np.uint64))
            b = b.append_column("open", pa.array(is_open))
            hot = b.filter(b.column("hot"))
            if hot.num_rows:
                kind = b.schema.field("doc_id").type
                none = [pa.nulls(hot.num_rows, kind), pa.nulls(hot.num_rows, pa.int32()), pa.nulls(hot.num_rows, pa.bool_())]
                yield pa.record_batch(
                    [hot.column("doc_id"), hot.column("line"), *none, *(hot.column(c) for c in names)],
                    names=[*_pair_schema(kind).names, *names],
                )
                b = b.filter(pc.invert(b.column("hot")))
            if not b.num_rows:
                continue
            words = b.column("word").to_numpy()
            cut = int(np.searchsorted(words, words[-1]))  # the last word's rows may go on
            if cut:
                yield from swept(pa.Table.from_batches([*held, b.slice(0, cut)]))
                held = []
            held.append(b.slice(cut))
        if held:
            yield from swept(pa.Table.from_batches(held))

    where = F.when(F.col("hot"), F.xxhash64("doc_id", "line")).otherwise(F.col("word"))
    met = rows.withColumn("at", where).repartition("at").drop("at").sortWithinPartitions("word")
    if wanted is not None:
        met = met.withColumn("at", F.xxhash64("doc_id", "line"))
    schema = _PAIR.format(key=key) + ", word long, p long, q long, n int, rank int, open boolean"
    return stage(met.mapInArrow(compare, schema), "met-lines")


def _met_in_blocks(rows: DataFrame, threshold: int, first: int | None, key: str) -> DataFrame:
    """The same for words with many lines: each pair of blocks of lines is a group of its own."""
    sizes = rows.groupBy("word").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("doc_id", "line"), F.col("blocks")).cast("int")
    spread = rows.join(sizes, "word").withColumn("own", own)
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = spread.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("line", "ascending")])
        part = _columns(table)
        own, i, j = (table.column(c).to_numpy() for c in ("own", "i", "j"))
        later, earlier = [], []
        for x in np.flatnonzero(part["open"]).tolist():
            y = np.arange(x)
            if i[0] != j[0]:
                y = y[own[:x] != own[x]]  # pairs inside a block meet in its own group
            y = y[_possible(part, np.full(len(y), x), y, threshold)]
            later.append(np.full(len(y), x))
            earlier.append(y)
        x = np.concatenate(later) if later else np.empty(0, np.int64)
        y = np.concatenate(earlier) if earlier else np.empty(0, np.int64)
        apart = (part["doc"][x] != part["doc"][y]) | (part["line"][x] != part["line"][y])
        out = _pairs(part, _earliest(x[apart], y[apart], first))
        return pa.Table.from_pandas(out, schema=_pair_schema(table.schema.field("doc_id").type), preserve_index=False)

    return spread.groupBy("word", "i", "j").applyInArrow(compare, _PAIR.format(key=key))


def _candidates(docs: DataFrame, rarity, threshold: int, first: int | None, key: str, only: DataFrame | None = None) -> DataFrame:
    """Staged (x_doc, x_line, y_doc, y_line, more); ``only``: for these lines x alone, by the words
    that prefixes in their documents have."""
    words, wanted = None, None
    if only is not None:
        wanted = docs.sparkSession.sparkContext.broadcast(BitFilter.of(only.select(F.xxhash64("x_doc", "x_line").alias("h")), "h"))
        ids = docs.sparkSession.sparkContext.broadcast(BitFilter.of(only.select(F.xxhash64("x_doc").alias("h")).distinct(), "h"))
        own = _postings(docs, rarity, threshold, key, ids=ids)
        words = docs.sparkSession.sparkContext.broadcast(BitFilter.of(stage(own.select("word").distinct(), "open-words"), "word"))
    met = _met(_postings(docs, rarity, threshold, key, words), threshold, first, key, wanted)
    usual = met.where("word IS NULL").select("x_doc", "x_line", "y_doc", "y_line", "more")
    hot = met.where("word IS NOT NULL").select(F.col("x_doc").alias("doc_id"), F.col("x_line").alias("line"), "word", "p", "q", "n", "rank", "open")
    if hot.limit(1).count():
        usual = usual.unionByName(_met_in_blocks(hot, threshold, first, key))
    if only is not None:
        usual = usual.join(only, ["x_doc", "x_line"], "left_semi")
    return stage(usual.groupBy("x_doc", "x_line", "y_doc", "y_line").agg(F.max("more").alias("more")), "line-pairs")


def _verified(pairs: DataFrame, docs: DataFrame, threshold: int, key: str) -> DataFrame:
    """Staged places (doc_id, line) of lines whose candidate is as similar as the threshold says.

    Which lines are asked for, and their words, come out of one kind of Python worker: others would
    stay in an executor beside it.
    """
    places = pairs.select(F.explode(F.array(
        F.struct(F.col("x_doc").alias("doc_id"), F.col("x_line").alias("line")),
        F.struct(F.col("y_doc").alias("doc_id"), F.col("y_line").alias("line")),
    )).alias("s")).select("s.*").distinct()
    filtered = docs.sparkSession.sparkContext.broadcast(BitFilter.of(places.select(_place(F.xxhash64("doc_id"), F.col("line")).alias("h")), "h"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start in range(0, b.num_rows, TOGETHER):
                part = b.slice(start, TOGETHER)
                texts = [t.split("\n") for t in part.column("text").to_pylist()]
                sizes = np.array([len(t) for t in texts])
                doc = np.repeat(np.arange(len(texts)), sizes)
                line = np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                asked = filtered.value.has(_place(part.column("h").to_numpy().view(np.uint64)[doc], line.astype(np.uint64)))
                doc, line = doc[asked], line[asked]
                lines = Lines([{"doc_id": i, "text": texts[d][at]} for i, (d, at) in enumerate(zip(doc.tolist(), line.tolist(), strict=True))])
                at = np.array(lines.doc, np.int64)  # those with words
                found = pa.ListArray.from_arrays(pa.array(np.append(lines.starts, len(lines.words)).astype(np.int32)), pa.array(lines.words.view(np.int64)))
                yield pa.record_batch(
                    [part.column("doc_id").take(pa.array(doc[at])), pa.array(line[at].astype(np.int32)), found], names=["doc_id", "line", "found"]
                )

    near = docs.withColumn("h", F.xxhash64("doc_id"))
    ids = places.select("doc_id").distinct()
    if ids.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        near = near.join(F.broadcast(ids), "doc_id", "left_semi")
    sets = near.mapInArrow(rows, f"doc_id {key}, line int, found array<long>")
    sets = sets.dropDuplicates(["doc_id", "line"])
    for k in ("x", "y"):
        side = sets.select(F.col("doc_id").alias(f"{k}_doc"), F.col("line").alias(f"{k}_line"), F.col("found").alias(f"{k}_found"))
        pairs = pairs.join(side, [f"{k}_doc", f"{k}_line"])
    shared = F.size(F.array_intersect("x_found", "y_found"))
    whole = F.size("x_found") + F.size("y_found") - shared
    matched = pairs.where(shared * 100 >= threshold * whole)
    return stage(matched.select(F.col("x_doc").alias("doc_id"), F.col("x_line").alias("line")).distinct(), "matched-lines")


def repeated_lines(docs: DataFrame, threshold: int = THRESHOLD, first: int = FIRST, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(doc_id, lines) per row, and (doc_id, removed): sorted numbers of the lines that go, where any do."""
    docs = id_text(docs, id_col, text_col)
    key = docs.schema["doc_id"].dataType.simpleString()
    survey = stage(_survey(docs), "line-survey")
    sets = survey.where("kind = 0").select("a", "b", F.struct("doc_id", "line").alias("place"))
    least = sets.groupBy("a", "b").agg(F.min("place").alias("least"))
    gone = sets.join(least, ["a", "b"]).where("place <> least").select("place.*").unionByName(
        survey.where("kind = 1").select("doc_id", "line")
    )
    rarity = docs.sparkSession.sparkContext.broadcast(_rarity(survey))
    pairs = _candidates(docs, rarity, threshold, first, key)
    matched = _verified(pairs, docs, threshold, key)
    # lines with candidates beyond those kept, none of which matched
    place = [F.col("x_doc") == F.col("doc_id"), F.col("x_line") == F.col("line")]
    open_lines = stage(pairs.where("more").select("x_doc", "x_line").distinct().join(matched, place, "left_anti"), "open-lines")
    if open_lines.limit(1).count():
        rest = _candidates(docs, rarity, threshold, None, key, open_lines)
        matched = matched.unionByName(_verified(rest, docs, threshold, key))
    gone = gone.unionByName(matched).groupBy("doc_id").agg(F.sort_array(F.collect_set("line")).alias("removed"))
    return survey.where("kind = 3").select("doc_id", F.col("a").alias("lines")), gone


def without_lines(text: Column, removed: Column) -> Column:
    """The text without the lines of these numbers."""
    kept = F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains(removed, i))
    return F.when(removed.isNull(), text).otherwise(F.array_join(kept, "\n"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, gone = repeated_lines(table(spark, sf_dir, "documents"))
    return lines.join(gone, "doc_id", "left").select(
        "doc_id", F.col("lines").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce(F.array_join(F.col("removed").cast("array<string>"), ","), F.lit("")).alias("removed_lines"),
    )


_LINE_WORDS = (
    "list_distinct(regexp_extract_all(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x20\x09-\x0D]+'))"
)
ORACLE_SQL = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
line AS (SELECT doc_id, i - 1 AS line, ls[i] AS l FROM split, generate_series(1, len(ls)) t(i)),
worded AS (SELECT doc_id, line, list_sort({_LINE_WORDS}) AS w FROM line),
place AS (SELECT * FROM worded WHERE len(w) > 0 AND doc_id IS NOT NULL),
class AS (SELECT w, row_number() OVER () AS c, len(w) AS n, min((doc_id, line)) AS p FROM place GROUP BY w),
word AS (SELECT c, n, p, unnest(w) AS t FROM class),
rarity AS (SELECT t, count(*) AS df FROM word GROUP BY t),
ranked AS (SELECT c, n, p, t, row_number() OVER (PARTITION BY c ORDER BY df, t) AS r FROM word JOIN rarity USING (t)),
prefix AS (SELECT * FROM ranked WHERE r <= n - ceil(0.8 * n) + 1),
candidate AS (
  SELECT DISTINCT x.c AS x, y.c AS y, x.n AS xn, y.n AS yn FROM prefix x JOIN prefix y USING (t)
  WHERE y.p < x.p AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)),
matched AS (
  SELECT DISTINCT x FROM (
    SELECT x, y, xn, yn, count(*) AS s FROM candidate JOIN word a ON a.c = x JOIN word b ON b.c = y AND b.t = a.t GROUP BY ALL)
  WHERE 100 * s >= 80 * (xn + yn - s)),
gone AS (
  SELECT doc_id, line FROM place JOIN class USING (w)
  WHERE (doc_id, line) <> p OR c IN (SELECT x FROM matched)),
by_doc AS (SELECT doc_id, count(*) AS n, string_agg(line::VARCHAR, ',' ORDER BY line) AS listed FROM gone GROUP BY doc_id)
SELECT doc_id, len(ls)::BIGINT AS n_lines, coalesce(n, 0) AS n_removed, coalesce(listed, '') AS removed_lines
FROM split LEFT JOIN by_doc USING (doc_id)"""
