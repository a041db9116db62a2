"""The n-gram Jaccard join against comparing all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm import jaccard_join
from tests.llm.conftest import ODD_TEXTS, rows
from tests.llm.test_similarity import brute_groups


def frame(spark, texts, parts=4):
    return spark.createDataFrame(sorted(texts.items()), "doc_id long, text string").repartition(parts)


def families(rng, groups, copies, size, passage):
    """Groups of copies with a few words changed, and texts that share a passage with half of all."""
    texts, n = {}, 0
    for _ in range(groups):
        base = [f"v{rng.randrange(5000)}" for _ in range(rng.randrange(1, size))]
        for _ in range(rng.randrange(1, copies)):
            w = list(base)
            for _ in range(rng.randrange(0, 3)):
                w[rng.randrange(len(w))] = f"z{rng.randrange(10**6)}"
            if rng.random() < 0.5:
                w = passage + w
            texts[n] = " ".join(w)
            n += 1
    return texts


def check(df, texts, size=5, threshold=80):
    got = rows(jaccard_join.similar_classes(df, size, threshold))
    assert got == sorted(brute_groups(texts, size, threshold), key=lambda r: [(False, str(v)) for v in r])


def test_join_equals_brute_force(llm):
    rng = random.Random(21)
    texts = families(rng, 60, 9, 90, [f"p{i}" for i in range(40)])
    check(frame(llm, texts), texts)


def test_full_matching_finds_what_no_head_ties(llm, monkeypatch):
    """Without heads, the multi-match prefixes alone find every link, in blocks and pools of any size."""
    rng = random.Random(22)
    texts = families(rng, 25, 7, 60, [f"p{i}" for i in range(30)])
    monkeypatch.setattr(jaccard_join, "BLOCK", 3)
    monkeypatch.setattr(jaccard_join, "PART", 2)
    monkeypatch.setattr(jaccard_join, "POOL", 300)
    check(frame(llm, texts), texts)
    monkeypatch.setattr(jaccard_join, "BLOCK_TOKENS", 40)
    real, calls = jaccard_join.verified, []

    def nothing_at_first(pairs, *rest):
        calls.append(1)
        return real(pairs.where("false") if len(calls) == 1 else pairs, *rest)

    for cost in (jaccard_join.VERIFY, 0.0, 1e9):  # levels as chosen, the least, whole sets
        monkeypatch.setattr(jaccard_join, "VERIFY", cost)
        calls.clear()
        monkeypatch.setattr(jaccard_join, "verified", nothing_at_first)
        check(frame(llm, texts), texts)


@pytest.mark.parametrize("threshold", [50, 95])
def test_other_thresholds_and_sizes(llm, threshold):
    rng = random.Random(threshold)
    texts = families(rng, 25, 6, 40, [f"p{i}" for i in range(10)])
    check(frame(llm, texts), texts, 3, threshold)


def test_chain_of_links_is_one_class(llm):
    base = [f"w{i}" for i in range(60)]
    texts = {i: " ".join(base[i * 2 : i * 2 + 40]) for i in range(9)} | {100 + i: " ".join(f"u{i}x{k}" for k in range(50)) for i in range(9)}
    check(frame(llm, texts), texts)


def test_prefixes_share_as_many_tokens_as_their_level():
    """The rule all candidates rest on, for both prefix lengths."""
    rng = random.Random(1)
    for _ in range(3000):
        n = rng.randrange(1, 60)
        a = set(rng.sample(range(80), n))
        b = {x if rng.random() < 0.93 else rng.randrange(80) for x in a}
        if 100 * len(a & b) < 80 * len(a | b):
            continue
        u, v = sorted((sorted(a), sorted(b)), key=len)
        t_v = jaccard_join.least_shared(len(v), 80)
        t_u = -(-160 * len(u) // 180)
        for level in range(1, t_v + 1):
            if level <= min(t_u, t_v):
                assert len(set(u[: len(u) - t_u + level]) & set(v[: len(v) - t_v + level])) >= level


def test_level_is_of_least_cost():
    # a prefix of rare tokens, frequent ones behind it: a longer prefix only costs
    assert jaccard_join.level_of(np.array([2] * 21 + [10**6] * 79), 100, 80) == 1
    # tokens of large groups: verifying costs more than carrying the whole set
    assert jaccard_join.level_of(np.array([10**5] * 100), 100, 80) > jaccard_join.level_of(np.array([3] * 100), 100, 80)


def test_odd_rows(nameless, none):
    texts = dict(ODD_TEXTS)
    for size in (2, 5):
        out = jaccard_join.similar_classes(nameless, size)
        assert rows(out.where("doc_id IS NOT NULL")) == sorted(brute_groups(texts, size), key=lambda r: [(False, str(v)) for v in r])
        assert {r["component"] for r in out.where("doc_id IS NULL").collect()} == {None}
        assert out.where("doc_id IS NULL").count() == 2
    assert jaccard_join.similar_classes(none).count() == 0


def test_repeated_ids_take_the_least_text(llm):
    df = llm.createDataFrame([(1, "b c d e f g"), (1, "a c d e f g"), (2, "a c d e f g"), (3, "b c d e f g")], "doc_id long, text string")
    assert rows(jaccard_join.similar_classes(df)) == [(1, 2, 1), (2, 2, 1), (3, 2, 3)]


def test_text_ids(llm):
    rng = random.Random(30)
    texts = families(rng, 10, 5, 40, [])
    df = frame(llm, texts).withColumn("doc_id", F.format_string("d%05d", "doc_id"))
    want = [(f"d{i:05d}", n, f"d{c:05d}") for i, n, c in brute_groups(texts, 5)]
    assert rows(jaccard_join.similar_classes(df)) == sorted(want)


def test_thresholds_without_a_base_level_are_refused(odd):
    with pytest.raises(ValueError):
        jaccard_join.similar_classes(odd, threshold=40)
