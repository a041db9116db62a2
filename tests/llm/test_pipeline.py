"""The pipeline against a plain Python version."""

import base64

import duckdb
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from mercato.llm import byte_bpe, quality
from mercato.llm.common import BATCH_BYTES, table
from tests.llm.conftest import ODD_TEXTS, SF, words
from tests.llm.test_similarity import brute_groups, brute_hits, brute_lines


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """The small tables, odd documents among them."""
    out = str(tmp_path_factory.mktemp("tables"))
    con = duckdb.connect()
    for name in ("labels", "benchmark"):
        con.execute(f"COPY (SELECT * FROM '{SF}/{name}.parquet') TO '{out}/{name}.parquet' (FORMAT parquet)")
    con.execute(f"CREATE TABLE d AS SELECT doc_id, text, lang, source, n_chars FROM '{SF}/documents.parquet'")
    con.executemany("INSERT INTO d VALUES (?, ?, 'en', 'odd', 0)", [(i + 10_000, t) for i, t in ODD_TEXTS] + [(None, "no id\nword")])
    con.execute(f"COPY d TO '{out}/documents.parquet' (FORMAT parquet)")
    return out


def test_pipeline_equals_brute_force(llm, folder):
    docs = table(llm, folder, "documents")
    model = quality.train(docs, table(llm, folder, "labels"), "quality", quality.trained_here())
    features = quality.Features()
    kept = [(r["doc_id"], r["text"]) for r in docs.collect() if model.scores([features.of(r["text"])])[0] >= 0.5]

    gone = brute_lines(kept)
    after = []
    for i, t in kept:
        if i in gone:
            t = "\n".join(line for k, line in enumerate(t.split("\n")) if k not in gone[i])
            if not words(t):
                continue
        after.append((i, t))

    named = {}
    for i, t in sorted(((i, t) for i, t in after if i is not None), key=lambda r: (r[0], r[1] or "")):
        named.setdefault(i, t)
    groups = brute_groups(named, corpus_pipeline.SHINGLE)
    after = [(i, named[i]) for i, _, c in groups if i == c] + [(i, t) for i, t in after if i is None]

    items = [tuple(r) for r in table(llm, folder, "benchmark").select("item_id", "text").collect()]
    clean = [(i, t) for (i, t), (_, n, hit, _) in zip(after, brute_hits(after, items), strict=True) if not (hit and 20 * hit >= n)]
    assert 0 < len(clean) < len(after) < len(kept) < docs.count()

    path = public_tokenizers.path(byte_bpe.VOCABULARY)
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(path, "rb"))}
    known = tiktoken.Encoding("known", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted((str(i), known.encode_ordinary(t or "")) for i, t in clean)
    got = corpus_pipeline.run(llm, folder).collect()
    assert sorted((str(r["doc_id"]), list(r["ids"])) for r in got) == want
    assert all(r["intact"] and r["n_tokens"] == len(r["ids"]) for r in got)


def test_texts_reach_workers_a_few_megabytes_at_a_time(llm, folder):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": [b.num_rows], "bytes": [b.nbytes]})

    table(llm, folder, "documents")
    seen = llm.range(0, 3000, 1, 1).select(F.repeat(F.lit("text"), 2000).alias("text")).mapInArrow(sizes, "rows long, bytes long").collect()
    assert sum(r["rows"] for r in seen) == 3000
    assert max(r["bytes"] for r in seen) < 2 * BATCH_BYTES
    narrow = llm.range(0, 10_000, 1, 1).mapInArrow(sizes, "rows long, bytes long").collect()
    assert [r["rows"] for r in narrow] == [10_000]


def test_a_limit_of_the_session_stays(llm, folder):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    llm.conf.set(key, "9m")
    try:
        table(llm, folder, "documents")
        assert llm.conf.get(key) == "9m"
    finally:
        llm.conf.unset(key)


def test_stages_keep_the_columns(llm, folder):
    docs = table(llm, folder, "documents").withColumns({"nth": F.lit(1), "Gone_lines": F.lit(2)}).withColumn("doc id", F.lit("x"))
    for name, step in corpus_pipeline.STAGES[:-1]:
        after = step(llm, docs, folder)
        assert after.columns == docs.columns, name
        assert after.dtypes == docs.dtypes, name
        assert step(llm, docs.where("false"), folder).count() == 0
    changed = corpus_pipeline.first_lines(llm, docs, folder).where("n_chars > 0")
    assert changed.where(F.length("text") != F.col("n_chars")).count() == 0
