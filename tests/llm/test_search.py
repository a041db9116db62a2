"""Ranked search against scoring every document, and how far the lists are read."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm import ranked_search
from tests.llm.conftest import LOWER, ODD_TEXTS

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    found = [(i, Counter(t), len(t)) for i, t in ((i, terms(x)) for i, x in docs) if t]
    n, total = len(found), sum(f[2] for f in found)
    out = []
    for item, text in items:
        scored = []
        for doc, tf, size in found:
            m = 25 + 75 * size * n // total
            score = 0
            for t in terms(text):
                if tf[t]:
                    df = sum(1 for f in found if t in f[1])
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def frames(spark, docs, items):
    return (
        spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
        spark.createDataFrame(items, "item_id string, text string"),
    )


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def corpus(rng, n):
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    return [(i, " ".join(rng.choices(words, weights, k=rng.randrange(1, 60)))) for i in range(n)]


def test_search_equals_brute_force(llm, monkeypatch):
    rng = random.Random(8)
    docs = corpus(rng, 300)
    docs += [(1000 + i, docs[i % 3][1]) for i in range(60)] + [(5, None), (6, ""), (7, "...")]  # copies: equal scores
    items = [(f"q{i}", " ".join(rng.choices([f"w{i}" for i in range(70)], k=rng.randrange(1, 12)))) for i in range(40)]
    items += [("none", "zz"), ("empty", ""), ("null", None), ("twice", "W3 w3, w3 w7"), (None, "w1")]
    want = brute(docs, [i for i in items if i[0]])
    assert got(ranked_search.search(*frames(llm, docs, items))) == want
    monkeypatch.setattr(ranked_search, "QUERY_TERMS", 20)  # several passes
    assert got(ranked_search.search(*frames(llm, docs, items))) == want


def test_small_blocks_and_depths(llm):
    rng = random.Random(9)
    docs = corpus(rng, 400)
    weights = np.array([5, 900, 2000, 1, 40] * 12, np.int64)
    known = {f"w{i}": i for i in range(60)}
    rows = [(i, np.array([known[w] for w in t.split()]), len(t.split())) for i, t in docs]
    block = ranked_search.Block(rows, weights, 400, sum(r[2] for r in rows))
    full = {}
    for q in range(50):
        which, times = np.unique(np.array(rng.choices(range(60), k=6)), return_counts=True)
        score = Counter()
        for e in range(len(block.impact)):
            term = int(np.searchsorted(block.starts, e, side="right")) - 1
            if term in which:
                score[int(block.doc[e])] += int(block.impact[e] * times[list(which).index(term)])
        tenth = sorted(score.values(), reverse=True)[9]
        found = block.best(which, times, 10, [])
        assert sorted(found) == sorted((s, d) for d, s in score.items() if s >= tenth)
        best = max(score.values())
        assert [f for f in block.best(which, times, 10, [best + 1] * 10) if f[0] > best] == []
        full[q] = len(found)


def test_reading_stops_early(monkeypatch):
    n = 20_000
    rows = [(i, np.array([0] * (1 + i % 50) + [1]), 60) for i in range(n)]
    block = ranked_search.Block(rows, np.array([3000, 10]), n, 60 * n)
    looked = []
    real = np.searchsorted
    monkeypatch.setattr(ranked_search.np, "searchsorted", lambda a, v, **k: looked.append(np.size(v)) or real(a, v, **k))
    found = block.best(np.array([0, 1]), np.array([1, 1]), 10, [])
    assert sum(looked) < n / 4 and len(found) == n / 50


def test_odd_rows(nameless, none, llm):
    items = llm.createDataFrame([("a", "word LINE one"), ("b", "mit license")], "item_id string, text string")
    docs = [(i, t) for i, t in ODD_TEXTS] + [(None, t) for i, t in ODD_TEXTS if i in (1, 7)]
    assert got(ranked_search.search(nameless, items)) == brute(docs, [("a", "word LINE one"), ("b", "mit license")])
    assert ranked_search.search(none, items).count() == 0
    assert ranked_search.search(nameless, items.where("false")).count() == 0


@pytest.mark.parametrize("kind", ["string", "int"])
def test_other_ids(llm, kind):
    docs, items = frames(llm, [(1, "a b"), (2, "a")], [("x", "a b")])
    out = ranked_search.search(docs.withColumn("doc_id", F.col("doc_id").cast(kind)), items, k=1)
    assert [str(r["doc_id"]) for r in out.collect()] == ["1"]


def test_terms_are_those_of_the_pattern():
    text = "A1_b-Cé x퟿ 7\x7fz  {y}"
    want = [ranked_search.terms_of(t)[0] for t in terms(text)]
    assert ranked_search.terms_of(text).tolist() == want
