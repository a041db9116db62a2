"""Byte-level BPE, language-model scores, chat templates."""

import base64
import hashlib
import itertools
import json
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given as sampled
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mercato.llm import byte_bpe, chat_format, lattice_lm
from tests.llm.conftest import ODD_TEXTS, rows, words


@pytest.fixture(scope="module")
def own():
    return byte_bpe.codec()


@pytest.fixture(scope="module")
def known():
    path = public_tokenizers.path(byte_bpe.VOCABULARY)
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(path, "rb"))}
    return tiktoken.Encoding("known", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_minimal_and_exact(own):
    assert sorted(own.hash.ids.tolist()) == list(range(len(own.entries)))
    assert own.hash.find(own.entries) == list(range(len(own.entries)))
    assert own.hash.find([b"no such entry", b""]) == [-1, -1]


@settings(max_examples=300, deadline=None)
@sampled(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60))
def test_encoding_equals_the_library(own, known, text):
    assert own.encode(text) == known.encode_ordinary(text)
    assert own.decode(own.encode(text)) == text.encode()


@pytest.mark.parametrize("text", ["a" * 20_000, "ab\n" * 9_000, " " * 9_000, "é" * 5_000, "don't we'll 12345 ''s"])
def test_long_runs(own, known, text, monkeypatch):
    assert own.encode(text) == known.encode_ordinary(text)
    monkeypatch.setattr(byte_bpe, "SLICE", 50)
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 20)
    assert own.encode_all([text, "x", text]) == [known.encode_ordinary(t) for t in (text, "x", text)]


def test_encode_query_on_odd_rows(odd, none, own, known):
    hashed = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, t in ODD_TEXTS:
        ids = known.encode_ordinary(t or "")
        want.append((i, len(ids), hashed(",".join(map(str, ids)).encode()), hashed((t or "").encode())))
    assert rows(byte_bpe.digests(odd, own)) == sorted(want, key=lambda r: [(False, str(v)) for v in r])
    assert byte_bpe.digests(none, own).count() == 0
    both = byte_bpe.encoded(odd, own).select("doc_id", byte_bpe.decoder(odd.sparkSession, own)("ids").alias("b"))
    assert sorted((r[0], bytes(r[1]).decode()) for r in both.collect()) == sorted((i, t or "") for i, t in ODD_TEXTS)


def _segmentations(text, pieces):
    if not text:
        yield ()
    for n in range(1, len(text) + 1):
        if text[:n] in pieces:
            for rest in _segmentations(text[n:], pieces):
                yield (text[:n], *rest)


def test_forward_recursion_sums_all_segmentations():
    pieces = ["▁", "▁a", "a", "b", "ab", "▁ab", "ba", "bb", "<0xC3>", "<0xA9>"]
    rng = np.random.default_rng(1)
    share = rng.random(len(pieces) + 1)
    share /= share.sum()
    lattice = lattice_lm.Lattice(pieces, np.log(share[:-1]), math.log(share[-1]))
    listed = ["".join(w) for n in range(1, 6) for w in itertools.product("ab", repeat=n)]
    p = dict(zip(pieces, share, strict=False))
    want = [sum(math.prod(p[x] for x in s) for s in _segmentations("▁" + w, set(pieces))) for w in listed]
    assert np.allclose(np.exp(lattice.log_probabilities(listed)), want)
    # a character that is no piece goes by its bytes
    assert np.allclose(np.exp(lattice.log_probabilities(["é"])), p["▁"] * p["<0xC3>"] * p["<0xA9>"])
    # expected counts: of each piece over the posterior of segmentations
    counts = rng.integers(1, 5, len(listed)).astype(float)
    used = Counter()
    for w, n, total in zip(listed, counts, want, strict=True):
        for s in _segmentations("▁" + w, set(pieces)):
            for x in s:
                used[x] += n * math.prod(p[y] for y in s) / total
    assert np.allclose(lattice.expected(listed, counts), [used[x] for x in pieces])


@pytest.mark.parametrize("frequent", [40, 100_000])
def test_scores_equal_brute_force(odd, nameless, none, frequent):
    pieces = lattice_lm.load_pieces(public_tokenizers.path(lattice_lm.VOCABULARY))
    fold = lambda i: 0 if i is None else zlib.crc32(str(i).encode()) % 7
    texts = [*ODD_TEXTS, (None, ODD_TEXTS[0][1]), (None, ODD_TEXTS[6][1])]
    train = [words(t) for i, t in texts if fold(i) != 2]
    c = Counter(w for t in train for w in t)
    n, v, docs = sum(c.values()) + len(train), len(c) + 1, len(train)
    lattice = lattice_lm.Lattice.initial(pieces)
    for _ in range(lattice_lm.ROUNDS):
        lattice = lattice.reestimated(lattice.expected(list(c), np.array(list(c.values()), float)), float(docs))
    docs_df = nameless.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    held_out = lattice_lm.hash_split(F.col("doc_id"), 7) == 2
    got = rows(lattice_lm.scored(docs_df, ~held_out, pieces, frequent=frequent))
    log_p = {w: lattice._alone("▁" + w)[1][-1] for w in {w for _, t in texts for w in words(t)}}
    want = sorted((
        (
            i, len(words(t)) + 1, sum(w in c for w in words(t)) + 1, n,
            sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words(t)) + math.log10((docs + 1) / (n + v + 1)),
            (sum(log_p[w] for w in words(t)) + lattice.end) / math.log(10),
        ) for i, t in texts), key=lambda r: [(x is None, str(x)) for x in r])
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4:] for g in got], [w[4:] for w in want])
    assert lattice_lm.scored(none.select("doc_id", "text"), ~held_out, pieces).count() == 0


@settings(max_examples=20, deadline=None)
@sampled(st.lists(st.text(alphabet="\\<|/s>[INST] turn\nend|é", max_size=30), min_size=1, max_size=20))
def test_escaping_is_reversible(llm, texts):
    df = llm.createDataFrame([(t,) for t in texts], "t string").select("t", chat_format.escape(F.col("t")).alias("e"))
    for t, e, back in df.select("t", "e", chat_format.unescape(F.col("e"))).collect():
        assert back == t
        assert not any(s in e for s in ("<|", "</s>", "<s>", "[INST]", "[/INST]"))


def test_formatted_conversations_read_back(llm, monkeypatch):
    turns = [
        (1, 1, "assistant", "<|end|>\n<|turn|>user<|text|>"), (1, 0, "user", None), (1, 300, "assistant", "late\\"),
        (1, 300, "assistant", "late\\"), (2, 0, None, "role\n"), (None, 0, "assistant", "é😀"), (2, None, "us<|text|>er", "x" * 50_000),
    ]
    df = llm.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat_format.digests(chat_format.format_turns(df)).collect()}
    for conv in (1, 2, None):
        mine = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in turns if c == conv))
        said = "".join(f"{r}\n{x}\n" for _, _, r, x in mine)
        loss = "".join(x for _, _, r, x in mine if r == "assistant")
        row = got[conv]
        assert (row["n_turns"], row["loss_chars"]) == (len(mine), len(loss))
        assert row["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert row["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert chat_format.digests(chat_format.format_turns(df.where("false"))).count() == 0
    part = chat_format.format_turns(df.where("conv_id IS NULL")).first()
    span = part["loss_spans"][0]
    assert part["formatted"][span["start"] : span["start"] + span["length"]] == "é😀"


def test_layouts_are_found_by_fingerprint(llm):
    records = {
        "messages": {"messages": [{"role": "user", "content": "a"}, {"content": None, "role": "assistant"}]},
        "dialog": {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]},
        "instruction": {"instruction": "do", "input": "", "output": "done"},
        "system_instruction": {"system": "", "instruction": "do", "input": "it", "output": 5},
        "prompt_completion": {"prompt": "p", "completion": "c"},
        "nested_prompt": {"prompt": {"text": "p"}, "response": {"text": "r"}},
        "question_answer": {"question": "q", "answer": "a"},
        None: {"unknown": 1},
    }
    df = llm.createDataFrame([(str(k), json.dumps(v)) for k, v in records.items()] + [("bad", "{"), ("null", None)], "k string, j string")
    found = chat_format.canonical_turns(df, F.try_parse_json("j")).collect()
    got = {r["k"]: (r["layout"], None if r["turns"] is None else [tuple(t) for t in r["turns"]]) for r in found}
    assert got["messages"] == ("messages", [("user", "a"), ("assistant", "")])
    assert got["dialog"] == ("dialog", [("user", "a"), ("assistant", "b")])
    assert got["instruction"] == ("instruction", [("user", "do"), ("assistant", "done")])
    assert got["system_instruction"] == ("system_instruction", [("user", "do\nit"), ("assistant", "5")])
    assert got["prompt_completion"][1] == [("user", "p"), ("assistant", "c")]
    assert got["nested_prompt"][1] == [("user", "p"), ("assistant", "r")]
    assert got["question_answer"][1] == [("user", "q"), ("assistant", "a")]
    assert got["None"] == got["bad"] == got["null"] == (None, None)
