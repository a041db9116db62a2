"""Byte-level BPE encoding and decoding with the ranks of a public vocabulary.

Two tiers. A pre-token that is a vocabulary entry by itself is found through a minimal perfect
hash: as many slots as entries, one displacement per bucket, one comparison of bytes. A miss is
merged from its bytes: a heap of pair ranks over a doubly linked list, so a run of n bytes takes
O(n log n) however long it is. Each distinct pre-token is resolved once per task and remembered
up to a bound, its ids as four bytes each: objects for them would take several times that memory.

Per row, without a shuffle. The vocabulary file's size is bounded and checked.

Rows: a null or empty text has no ids and decodes to no bytes; repeated rows give repeated results.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator
from hashlib import sha256
from heapq import heapify, heappop, heappush
from itertools import batched, chain, islice

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.common import id_text, map_rows, mix, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: A vocabulary may be shipped with each task up to this size.
MAX_ENTRIES = 2_000_000
#: Pre-tokens remembered in each of two generations per task; characters (pre-tokens of a longer text) at a time.
REMEMBERED, SLICE = 250_000, 200_000


def load_ranks(path: str) -> list[bytes]:
    """Entries by id out of a rank file: base64 bytes, space, rank."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    if len(pairs) > MAX_ENTRIES:
        raise ValueError(f"{path} has {len(pairs)} entries; at most {MAX_ENTRIES} are shipped to tasks")
    entries: list[bytes] = [b""] * (max(int(rank) for _, rank in pairs) + 1)
    for text, rank in pairs:
        entries[int(rank)] = base64.b64decode(text)
    return entries


class PerfectHash:
    """Minimal perfect hash of byte strings to their ids, by hash and displace.

    Keys fall into n/4 buckets. From the largest bucket on, the first displacement that sends all
    keys of the bucket to free slots is kept; single keys take the slots that are left.
    """

    def __init__(self, keys: list[bytes], ids: list[int]) -> None:
        n = self.n = len(keys)
        self.buckets = max(1, n // 4)
        hashes = self._hash(keys)
        home = (hashes % np.uint64(self.buckets)).astype(np.int64)
        self.shift = np.zeros(self.buckets, np.int64)
        slot_of = np.full(n, -1, np.int64)
        free = np.ones(n, bool)
        order = np.argsort(home, kind="stable")
        bounds = np.searchsorted(home[order], np.arange(self.buckets + 1))
        counts = np.diff(bounds)
        singles = []
        for b in np.argsort(-counts, kind="stable"):
            members = order[bounds[b] : bounds[b + 1]]
            if len(members) < 2:
                singles += [(b, members[0])] if len(members) else []
                continue
            first = 1
            while True:
                tries = np.arange(first, first + 64, dtype=np.uint64)
                slots = self._slot(hashes[members][None, :], tries[:, None])
                fits = free[slots].all(axis=1)
                ordered = np.sort(slots, axis=1)
                fits &= (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
                if fits.any():
                    k = int(fits.argmax())
                    self.shift[b], slot_of[members] = int(tries[k]), slots[k]
                    free[slots[k]] = False
                    break
                first += 64
        for (b, member), slot in zip(singles, np.flatnonzero(free), strict=False):
            self.shift[b], slot_of[member] = -slot - 1, slot
        self.keys: list[bytes] = [b""] * n
        self.ids = np.zeros(n, np.int64)
        for key, i, slot in zip(keys, ids, slot_of, strict=True):
            self.keys[slot], self.ids[slot] = key, i

    @staticmethod
    def _hash(keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))

    def _slot(self, hashes: np.ndarray, shift: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mix(hashes + shift * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(max(1, self.n))).astype(np.int64)

    def find(self, keys: list[bytes]) -> list[int]:
        """Id of each key, -1 for one that is no entry."""
        if not keys or not self.n:
            return [-1] * len(keys)
        hashes = self._hash(keys)
        shift = self.shift[(hashes % np.uint64(self.buckets)).astype(np.int64)]
        slots = np.where(shift < 0, -shift - 1, self._slot(hashes, np.maximum(shift, 0).astype(np.uint64)))
        own = self.keys
        return [int(i) if own[s] == k else -1 for k, s, i in zip(keys, slots.tolist(), self.ids[slots].tolist(), strict=True)]


class Codec:
    """Encoder and decoder; picklable, so that tasks get it as it is."""

    def __init__(self, entries: list[bytes], pattern: str) -> None:
        self.entries = entries
        known = [i for i, e in enumerate(entries) if e]
        rank = {entries[i]: i for i in known}
        self.hash = PerfectHash(list(rank), list(rank.values()))
        self.byte = [rank.get(bytes((b,)), -1) for b in range(256)]
        if min(self.byte) < 0:
            raise ValueError("a byte-level vocabulary has all 256 bytes")
        # what each entry makes with the one to its right
        self.makes: list[dict[int, int]] = [{} for _ in entries]
        for e, i in rank.items():
            for cut in range(1, len(e)):
                if (left := rank.get(e[:cut])) is not None and (right := rank.get(e[cut:])) is not None:
                    self.makes[left][right] = i
        # white space by the Unicode property; the regex module's \\s has four control characters more
        space = pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.matches = regex.compile(space)
        self.single = [array("i", (i,)).tobytes() for i in range(len(entries))]
        self.seen: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merge(self, word: bytes) -> tuple[int, ...]:
        """Ids of a pre-token: merge the pair of lowest rank, the leftmost of equals, until none is left.

        The heap holds rank and place in one number; ``due`` has the valid one of each place.
        """
        n, makes = len(word), self.makes
        bits = n.bit_length()
        place = (1 << bits) - 1
        ids = [self.byte[b] for b in word]
        after, before, due, heap = list(range(1, n + 1)), list(range(-1, n - 1)), [-1] * n, []
        for i, made in enumerate(map(dict.get, map(makes.__getitem__, ids), ids[1:])):
            if made is not None:
                due[i] = made << bits | i
                heap.append(due[i])
        heapify(heap)
        while heap:
            top = heappop(heap)
            i = top & place
            if due[i] != top:
                continue  # either side has been merged since
            j = after[i]
            now, right, left = top >> bits, after[j], before[i]
            ids[i], after[i], due[i], due[j], ids[j] = now, right, -1, -1, -1
            if right < n:
                before[right] = i
                if (made := makes[now].get(ids[right])) is not None:
                    due[i] = top = made << bits | i
                    heappush(heap, top)
            if left >= 0:
                if (made := makes[ids[left]].get(now)) is not None:
                    due[left] = top = made << bits | left
                    heappush(heap, top)
                else:
                    due[left] = -1
        return tuple(i for i in ids if i >= 0)

    def _resolve(self, words: set[str]) -> None:
        """Remember the ids of words; the older half of what is remembered goes first."""
        if len(self.seen) + len(words) > REMEMBERED:
            self.older, self.seen = self.seen, {}
        rest, older = [], self.older
        for w in words.difference(self.seen):
            if w in older:
                self.seen[w] = older[w]
            else:
                rest.append(w)
        raw = [w.encode() for w in rest]
        for word, b, i in zip(rest, raw, self.hash.find(raw), strict=True):
            self.seen[word] = self.single[i] if i >= 0 else array("i", self.merge(b)).tobytes()

    def _joined(self, words: Iterable[str]) -> list[int]:
        """Ids of remembered words, one after the other."""
        return array("i", b"".join(map(self.seen.__getitem__, words))).tolist()

    def _long(self, text: str) -> list[int]:
        out: list[int] = []
        found = (m.group() for m in self.matches.finditer(text))
        while words := list(islice(found, SLICE)):
            self._resolve(set(words))
            out.extend(self._joined(words))
        return out

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text; texts are taken together up to ``SLICE`` characters."""
        out: list[list[int]] = []
        start = 0
        while start < len(texts):
            end, size = start, 0
            while end < len(texts) and (end == start or size + len(texts[end]) <= SLICE):
                size += len(texts[end])
                end += 1
            if size > SLICE:
                out.append(self._long(texts[start]))
            else:
                words = list(map(self.matches.findall, texts[start:end]))
                self._resolve(set(chain.from_iterable(words)))
                out += map(self._joined, words)
            start = end
        return out

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.entries.__getitem__, ids))


def codec(path: str | None = None, pattern: str | None = None) -> Codec:
    import public_tokenizers

    return Codec(load_ranks(path or public_tokenizers.path(VOCABULARY)), pattern or public_tokenizers.PATTERN)


def encoder(spark: SparkSession, own: Codec):
    """Column function: text to its ids."""
    shipped = spark.sparkContext.broadcast(own)

    @F.pandas_udf("array<int>")
    def encode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        use = shipped.value
        for texts in parts:
            ids = use.encode_all([t or "" for t in texts])
            yield pd.Series([np.array(i, dtype=np.int32) for i in ids], dtype=object)

    return encode


def decoder(spark: SparkSession, own: Codec):
    """Column function: ids to the bytes they stand for."""
    shipped = spark.sparkContext.broadcast(own.entries)

    @F.pandas_udf("binary")
    def decode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        entries = shipped.value
        for lists in parts:
            yield pd.Series([b"".join(map(entries.__getitem__, () if ids is None else ids.tolist())) for ids in lists], dtype=object)

    return decode


def encoded(docs: DataFrame, own: Codec | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids)."""
    own = own or codec()
    return id_text(docs, id_col, text_col).select("doc_id", encoder(docs.sparkSession, own)("text").alias("ids"))


def digests(docs: DataFrame, own: Codec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: the count and digest of its ids, and of the bytes that they decode to.

    Encodes and decodes in the same task, a few texts at a time, so the ids of no batch are held.
    """
    named = id_text(docs, id_col, text_col)
    shipped = docs.sparkSession.sparkContext.broadcast(own)

    def rows(source: Iterator[dict]) -> Iterator[tuple]:
        use = shipped.value
        decimal = [str(i) for i in range(len(use.entries))]
        for part in batched(source, 128):
            for r, ids in zip(part, use.encode_all([r["text"] for r in part]), strict=True):
                listed = ",".join(map(decimal.__getitem__, ids)).encode()
                yield r["doc_id"], len(ids), sha256(listed).hexdigest(), sha256(use.decode(ids)).hexdigest()

    key = named.schema["doc_id"].dataType.simpleString()
    return map_rows(named, rows, f"doc_id {key}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def tokenized(docs: DataFrame, own: Codec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, intact): ``intact`` if the ids decode to the text's own bytes."""
    named = id_text(docs, id_col, text_col)
    shipped = docs.sparkSession.sparkContext.broadcast(own)

    def rows(source: Iterator[dict]) -> Iterator[tuple]:
        use = shipped.value
        for part in batched(source, 128):
            for r, ids in zip(part, use.encode_all([r["text"] for r in part]), strict=True):
                yield r["doc_id"], len(ids), ids, use.decode(ids) == r["text"].encode()

    key = named.schema["doc_id"].dataType.simpleString()
    return map_rows(named, rows, f"doc_id {key}, n_tokens long, ids array<int>, intact boolean", batch=256)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), codec())
