"""Near duplicates, repeated lines, benchmark passages, fingerprints."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given as sampled
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mercato.llm import common, components, decontaminate, fingerprints, line_dedup, near_dups
from mercato.llm.common import BitFilter, shingle_hashes
from tests.llm.conftest import LOWER, ODD_TEXTS, rows, words


def union(ids, links):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def sets(text, size):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute_groups(texts, size, threshold=80):
    found = {i: sets(t, size) for i, t in texts.items()}
    ids = sorted(found)
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
        if found[a] and found[b] and 100 * len(found[a] & found[b]) >= threshold * len(found[a] | found[b])
    ]
    return sorted((i, len(found[i]), c) for i, c in union(ids, links).items())


def test_components_equal_union_find(llm):
    rng = random.Random(4)
    links = [(rng.randrange(150), rng.randrange(150)) for _ in range(110)] + [(500, k) for k in range(501, 540)] + [(k, k + 1) for k in range(700, 740)]
    got = {r["id"]: r["component"] for r in components.components(llm.createDataFrame(links, "u long, v long")).collect()}
    want = union({i for e in links for i in e}, links)
    assert all(got.get(i, i) == c for i, c in want.items())
    assert components.components(llm.createDataFrame([], "u long, v long")).count() == 0


def test_near_duplicates_on_odd_rows(nameless, none):
    texts = {i: t for i, t in ODD_TEXTS}
    for size in (2, 5):
        assert rows(near_dups.duplicate_groups(nameless, size)) == sorted(brute_groups(texts, size), key=lambda r: [(False, str(v)) for v in r])
    assert near_dups.duplicate_groups(none, 2).count() == 0


def variants(n, seed, length=60, edits=4):
    """Copies of one text that differ from it by some words, and so more from each other."""
    rng = random.Random(seed)
    base = [f"b{rng.randrange(10**6)}" for _ in range(length)]
    out = []
    for _ in range(n):
        w = list(base)
        for at in rng.sample(range(length), rng.randrange(edits + 1)):
            w[at] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_large_groups_keep_every_link(llm, monkeypatch):
    """Groups whose members are chained by links at the threshold; blocks of few classes."""
    texts = dict(enumerate(variants(150, 1) + variants(150, 2, edits=7) + variants(40, 3, length=12, edits=2)))
    monkeypatch.setattr(near_dups, "BLOCK", 16)
    df = llm.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    assert sorted(tuple(r) for r in near_dups.duplicate_groups(df, 2).collect()) == brute_groups(texts, 2)


def test_pruning_keeps_similar_pairs():
    steps = near_dups.least_matches()
    rng = np.random.default_rng(0)
    a = rng.integers(0, 256, (4000, near_dups.BANDS * near_dups.ROWS)).astype(np.uint8)
    for share, least, most in ((0.8, 0.999, 1), (0.3, 0, 0.01)):
        b = np.where(rng.random(a.shape) < share, a, rng.integers(0, 256, a.shape).astype(np.uint8))
        assert least <= len(near_dups.passing(a, b, steps)) / len(a) <= most


@settings(max_examples=150, deadline=None)
@sampled(st.lists(st.integers(0, 5), max_size=60), st.integers(1, 9))
def test_winnowing_keeps_one_hash_of_every_window(values, width):
    h = np.array(values, np.uint64)
    kept = decontaminate.winnow(h, width)
    for i in range(len(h) - width + 1):
        window = h[i : i + width]
        assert (i + np.flatnonzero(window == window.min())[-1]) in kept


def brute_hits(texts, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    owners = {}
    for item, t in items:
        w = split(t)
        size = min(13, len(w))
        for i in range(len(w) - size + 1 if w and item is not None else 0):
            owners.setdefault(tuple(w[i : i + size]), set()).add(str(item))
    sizes = {len(k) for k in owners}
    out = []
    for doc, t in texts:
        w, hit, of = split(t), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if (found := owners.get(tuple(w[i : i + size]))) is not None:
                    hit |= set(range(i, i + size))
                    of |= found
        out.append((doc, len(w), len(hit), sorted(of)))
    return out


def test_contamination_equals_brute_force(llm, odd, none):
    rng = random.Random(9)
    vocabulary = [f"v{i}" for i in range(30)]
    passage = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, passage(rng.choice([3, 6, 12, 13, 14, 40]))) for k in range(25)]
    items += [(100, "Alpha BETA; gamma"), (101, None), (102, "..."), (None, passage(20)), (3, items[3][1]), (103, "word")]
    texts = list(ODD_TEXTS)
    for k in range(60):
        piece = rng.choice(items[:25])[1].split()
        start = rng.randrange(len(piece))
        texts.append((1000 + k, f"{passage(rng.randrange(30))} {', '.join(piece[start:])} {passage(rng.randrange(90))}"))
    docs = llm.createDataFrame(texts, "doc_id long, text string").repartition(3)
    bench = llm.createDataFrame(items, "item_id long, text string")
    key = lambda r: [(False, str(v)) for v in r]
    assert rows(decontaminate.contamination(docs, bench)) == sorted(brute_hits(texts, items), key=key)
    assert decontaminate.contamination(none, bench).count() == 0
    clean = decontaminate.contamination(odd, bench.where("false")).collect()
    assert len(clean) == len(ODD_TEXTS) and all(r["n_hit"] == 0 for r in clean)


def test_bit_filter_misses_nothing(llm):
    entries = llm.range(5000).selectExpr("xxhash64(id) AS h")
    values = np.array([r[0] for r in entries.collect()], np.int64).view(np.uint64)
    for bits in (1 << 14, 1 << 20):
        own = BitFilter.of(entries, "h", bits)
        assert own.has(values).all() and len(own.words) * 64 <= bits
    others = values * np.uint64(0x9E3779B97F4A7C15)
    assert own.has(others).mean() < 0.05


def brute_lines(texts):
    places = []
    for doc, t in texts:
        for i, line in enumerate((t or "").split("\n")):
            if doc is not None and words(line):
                places.append(((doc, i), frozenset(words(line))))
    places = sorted(set(places), key=lambda p: p[0])
    gone = {}
    for k, (place, s) in enumerate(places):
        if any(p != place and 100 * len(s & o) >= 80 * len(s | o) for p, o in places[:k]):
            gone.setdefault(place[0], []).append(place[1])
    return gone


@pytest.mark.parametrize("limits", [{}, {"HOT": 3, "BLOCK": 4, "REMEMBERED": 5}])
def test_repeated_lines_equal_brute_force(llm, nameless, none, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(line_dedup, name, value)
    texts = [(i, t) for i, t in ODD_TEXTS]
    more = variants(60, 5, length=9, edits=2) + variants(60, 6, length=25, edits=4)
    texts += [(200 + k, "\n".join(more[k : k + 2])) for k in range(0, 120, 2)]
    extra = llm.createDataFrame(texts[len(ODD_TEXTS):], "doc_id long, text string")
    docs = nameless.select("doc_id", "text").unionByName(extra).repartition(5)
    for first in (1, 3):
        lines, gone = line_dedup.repeated_lines(docs, first=first)
        assert {r["doc_id"]: r["removed"] for r in gone.collect()} == brute_lines(texts)
    assert lines.count() == len(texts) + 2
    lines, gone = line_dedup.repeated_lines(none)
    assert lines.count() == gone.count() == 0


@pytest.mark.parametrize("range_bytes", [1 << 20, 40_000])
def test_fingerprints_equal_brute_force(odd, none, range_bytes, monkeypatch):
    monkeypatch.setattr(fingerprints.neighbours, "__defaults__", (range_bytes,))
    texts = sorted(((i, t or "") for i, t in ODD_TEXTS))
    want = []
    for k, (i, t) in enumerate(texts):
        following = texts[(k + 1) % len(texts)][1]
        n = len(t) // 4
        edit = t[: len(t) - n] + following[:n]
        own, other, theirs = map(fingerprints.fingerprint, (t, edit, following))
        want.append((
            i, len(t), hashlib.sha256(edit.encode()).hexdigest(), fingerprints.text_form(own), fingerprints.text_form(other),
            fingerprints.containment(own, other), fingerprints.containment(own, theirs),
        ))
    assert rows(fingerprints.edited_chain(odd)) == sorted(want, key=lambda r: [(False, str(v)) for v in r])
    assert fingerprints.edited_chain(none).count() == 0
    whole = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprinted(odd).collect()}
    assert all(whole[i] == fingerprints.text_form(fingerprints.fingerprint(t)) for i, t in texts)


def test_cuts_shift_with_the_content():
    rng = random.Random(2)
    text = " ".join(f"w{rng.randrange(5000)}" for _ in range(3000))
    own = fingerprints.fingerprint(text)
    assert fingerprints.containment(own, fingerprints.fingerprint("an insertion " + text)) > 0.98
    assert fingerprints.from_text(fingerprints.text_form(own)) == own
    for data in (text[:2000].encode(), b"", b"abc", bytes(500)):
        ends = fingerprints.cuts(data)
        assert ends == sorted(set(ends)) and (ends[-1:] or [0]) == [len(data)]
        assert all(b - a <= fingerprints.LARGEST for a, b in zip([0, *ends], ends, strict=False))
        for start in ends[:5]:
            assert fingerprints.cuts(data, start) == [e for e in ends if e > start]


def test_hashed_words(monkeypatch):
    texts = ["", " \t\n", "a", "  B b\x0bB\x85 é\u2003x ", "w " * 300 + "longer" * 40, "x" * 500]
    texts = [t.encode().translate(common.SPACED) for t in texts]
    whole = [common.hashed_words(t) for t in texts]
    monkeypatch.setattr(common, "_PIECE", 64)
    seen = {}
    for t, found in zip(texts, whole, strict=True):
        for a, b in zip(found, common.hashed_words(t), strict=True):
            assert np.array_equal(a, b)
        own = [t[a:b] for a, b in zip(found[1], found[2], strict=True)]
        assert own == t.split()
        for h, w in zip(found[0].tolist(), own, strict=True):
            assert seen.setdefault(h, w) == w
    assert len(set(seen.values())) == len(seen)


def test_word_tables():
    for b in range(128):
        c = chr(b)
        assert (common.SPACED[b] == 32) == (c in " \t\n\x0b\x0c\r")
        assert (common.ALPHANUMERIC[b] == 32) == (re.fullmatch(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]", c.translate(LOWER)) is None)
        assert common.SPACED[b] in (32, ord(c.translate(LOWER)))


def test_shingles():
    h = common.hashed_words(b"a b c a b")[0]
    assert len(np.unique(shingle_hashes(h, 2))) == 3 and len(shingle_hashes(h, 9)) == 1 and len(shingle_hashes(h[:0], 2)) == 0


def test_a_set_posts_once_in_any_order(llm):
    line = "alpha beta gamma delta epsilon zeta eta theta"
    docs = llm.createDataFrame([(i, line + "\nshort one") for i in range(600)], "doc_id long, text string")
    docs = docs.coalesce(1).sortWithinPartitions(F.desc("doc_id"))
    rarity = llm.sparkContext.broadcast(np.zeros(line_dedup.SLOTS, np.uint32))
    got = line_dedup._postings(docs, rarity, 80, "bigint").collect()
    assert len(got) == 2 and {(r["doc_id"], r["line"], r["n"]) for r in got} == {(0, 0, 8)}


def test_words_of_one_set_are_not_posted(llm):
    texts = [(0, "alpha beta gamma delta epsilon zeta eta theta"), (1, "alpha beta gamma delta epsilon zeta eta iota"), (2, "one two three four five")]
    docs = llm.createDataFrame(texts, "doc_id long, text string")
    rarity = llm.sparkContext.broadcast(line_dedup._rarity(line_dedup._survey(docs)))
    got = line_dedup._postings(docs, rarity, 80, "bigint").collect()
    assert {r["doc_id"] for r in got} == {0, 1} and len(got) == 2  # the other rarest word, of two, has no other set
    _, gone = line_dedup.repeated_lines(docs, threshold=77)
    assert [tuple(r) for r in gone.collect()] == [(1, [0])]


def test_one_kind_of_python_worker_in_a_stage(llm, monkeypatch):
    plans, store = [], line_dedup.stage

    def noted(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df, label)

    monkeypatch.setattr(line_dedup, "stage", noted)
    for module in (line_dedup, common):
        monkeypatch.setattr(module, "BROADCAST_KEYS", 1)
    texts = [(k, t) for k, t in enumerate(variants(60, 5, length=9, edits=2) + variants(60, 6, length=25, edits=4))]
    _, gone = line_dedup.repeated_lines(llm.createDataFrame(texts, "doc_id long, text string"), first=1)
    assert {r["doc_id"]: r["removed"] for r in gone.collect()} == brute_lines(texts)
    assert sum("MapInArrow" in p for p in plans) >= 4 and not any("EvalPython" in p for p in plans)


def test_blocks_are_bounded_in_shingles(llm):
    """64 classes of a million shingles each: far fewer than a block of classes, 512 MB of sets."""
    met = near_dups.in_blocks(llm.range(64).selectExpr("1L AS key", "id", "id AS component", "64L AS n", "64000000L AS total"))
    rows = met.collect()
    blocks = {}
    for r in rows:
        blocks.setdefault((r["i"], r["j"]), set()).add(r["id"])
    assert max(map(len, blocks.values())) * 1_000_000 <= 4 * near_dups.BLOCK_SHINGLES
    together = {(a, b) for ids in blocks.values() for a in ids for b in ids}
    assert len(together) == 64 * 64
    few = near_dups.in_blocks(llm.range(3).selectExpr("1L AS key", "id", "id AS component", "3L AS n", "300L AS total"))
    assert {(r["own"], r["i"], r["j"]) for r in few.collect()} == {(0, 0, 0)}


def test_small_blocks_give_the_same_groups(llm, monkeypatch):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(60)]
    texts = [(k, " ".join(w if rng.random() > 0.06 else f"x{rng.randrange(40)}" for w in base)) for k in range(40)]
    df = llm.createDataFrame(texts, "doc_id long, text string")
    monkeypatch.setattr(near_dups, "BLOCK_SHINGLES", 100)
    assert sorted(tuple(r) for r in near_dups.duplicate_groups(df, 2).collect()) == brute_groups(dict(texts), 2)


@pytest.mark.parametrize("first", [3, None])
def test_a_word_of_many_similar_lines_is_swept_in_little_memory(first):
    """All pairs of 3,000 lines of a word, and the pairs of some small words, compared a part at a time."""
    import tracemalloc

    word = np.sort(np.r_[np.full(3000, 7), np.arange(100, 160).repeat(3)])
    count = len(word)
    rng = np.random.default_rng(1)
    part = {
        "word": word, "n": np.full(count, 20, np.int32), "rank": np.zeros(count, np.int32), "line": np.zeros(count, np.int32),
        "doc": np.arange(count), "open": rng.random(count) < 0.1,
        "p": rng.integers(0, 2**20, count).astype(np.uint64), "q": np.zeros(count, np.uint64),
    }
    want = {}
    for x in np.flatnonzero(part["open"]):
        y = np.flatnonzero(word[:x] == word[x])
        y = y[line_dedup._possible(part, np.full(len(y), x), y, 80)]
        if len(y):
            want[int(x)] = (y[:first].tolist(), first is not None and len(y) > first)
    tracemalloc.start()
    got, size = {}, 0
    for x, y, more in line_dedup._sweep(part, 80, first):
        size += len(x)
        for later in np.unique(x).tolist():
            got[later] = (y[x == later].tolist(), bool(more[x == later][0]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == want and size == sum(len(y) for y, _ in want.values())
    assert peak < 80 << 20
