"""Periodic runs of words against a scan of every period."""

import hashlib
import random
import zlib

import pytest
from hypothesis import given as sampled
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mercato.llm import periodic_runs
from mercato.llm.queries import build_llm_queries
from tests.llm.conftest import ODD_TEXTS, SF


def split(text):
    return (text or "").encode().split()


def brute(words):
    """All runs by comparing words at every distance."""
    n, least = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                least.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((a, b - a, q) for (a, b), q in least.items()), key=lambda r: (r[0], r[2]))


def kept(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone).decode()


def planted(rng):
    """Random words with stretches of some period, of several lengths and with broken places."""
    out = []
    for _ in range(rng.randrange(1, 6)):
        out += [rng.choice("abcdefgh") for _ in range(rng.randrange(0, 60))]
        unit = [rng.choice("abc" if rng.random() < 0.5 else "abcdefghijklmn") for _ in range(rng.choice([1, 2, 3, 7, 8, 16, 17, 18, 24, 25, 36, 37, 55, 90]))]
        out += (unit * 5)[: int(len(unit) * rng.uniform(1.5, 5))]
        if rng.random() < 0.3 and out:
            out[rng.randrange(len(out))] = "z"
    return [w.encode() for w in out]


def test_runs_equal_brute_force():
    rng = random.Random(11)
    texts = [planted(rng) for _ in range(150)] + [[], [b"a"], [b"a"] * 23, [b"a"] * 24, [b"a", b"b"] * 400]
    found = periodic_runs.runs_of(texts)
    for words, runs in zip(texts, found, strict=True):
        want = brute(words)
        assert runs == want
        assert periodic_runs.collapsed(words, runs) == kept(words, want)
    assert sum(map(len, found)) > 150


@settings(max_examples=200, deadline=None)
@sampled(st.lists(st.sampled_from([b"a", b"b"]), max_size=140), st.integers(1, 6))
def test_runs_of_two_words(unit, times):
    words = unit * times
    assert periodic_runs.runs_of([words, words[:-1]]) == [brute(words), brute(words[:-1])]


def test_long_periods_at_every_scale():
    rng = random.Random(5)
    for period in (17, 24, 25, 100, 121, 122, 1000, 4096):
        unit = [str(rng.randrange(10**6)).encode() for _ in range(period)]
        words = [b"x"] * 3 + (unit * 4)[: 3 * period] + [b"y"]
        assert (3, 3 * period, period) in periodic_runs.runs_of([words])[0]
        assert all(q != period for _, _, q in periodic_runs.runs_of([words[:-2] + [b"y"]])[0])  # a word too short


def test_thue_morse_words_defeat_no_hash():
    t = [b"a"]
    while len(t) < 4096:
        t += [b"b" if w == b"a" else b"a" for w in t]
    assert periodic_runs.runs_of([t])[0] == []  # no cube in it
    words = t[:50] * 4
    assert periodic_runs.runs_of([words])[0] == brute(words)


def test_minimizers_are_first_least():
    rng = random.Random(3)
    import numpy as np

    for width in (1, 2, 5, 8, 13):
        h = np.array([rng.randrange(20) for _ in range(100)], np.uint64)
        want = sorted({j + int(h[j : j + width].argmin()) for j in range(100 - width + 1)})
        assert periodic_runs.minimizers(h, width).tolist() == want


@pytest.mark.parametrize("case", ["odd", "nameless", "none"])
def test_operator_on_odd_rows(case, request):
    df = request.getfixturevalue(case)
    out = periodic_runs.periodic_runs(df).collect()
    assert len(out) == df.count()
    texts = dict(ODD_TEXTS)
    for r in out:
        if r["doc_id"] is not None:
            words = split(texts[r["doc_id"]])
            runs = [tuple(x) for x in r["runs"]]
            assert r["n_words"] == len(words) and runs == brute(words[:2000]) if len(words) < 2000 else True
            assert r["collapsed"] == kept(words, runs)


def test_text_ids(odd):
    out = periodic_runs.periodic_runs(odd.withColumn("doc_id", F.concat(F.lit("d"), "doc_id")))
    assert out.schema["doc_id"].dataType.simpleString() == "string" and out.count() == len(ODD_TEXTS)


def contract(doc_id, text):
    words = split(text)
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    best = (None,) * 4
    if runs:
        from fractions import Fraction

        start, length, period = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        best = (start, length, period, 1000 * length // period)
    return (doc_id, len(runs), *best, sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(kept(words, runs)))


def test_query_equals_brute_force(llm, given):
    out = build_llm_queries()["op12_periodic_runs"](llm, SF)
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {t for c, t in out.dtypes if not c.endswith("sha256")} == {"bigint"}
    assert sorted(map(tuple, out.collect())) == sorted(contract(i, t) for i, t in given.items())


def test_planted_tails_follow_the_rule(llm):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(i % 90))) for i in range(400)] + [(i, None) for i in range(400, 420)]
    df = llm.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: split(r["text"]) for r in periodic_runs.with_periodic_tails(df).collect()}
    for doc_id, text in rows:
        words, h = split(text), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        assert out[doc_id] == words
