"""A training corpus from raw documents: quality, repeated lines, near duplicates, benchmark text, tokens.

Each stage gets all that the one before kept and returns the columns of documents, the last one
token ids. ``run`` writes each stage's rows below ``spark.checkpoint.dir`` and reads them again, so
a lost executor costs the tasks of one stage.

Rows: null texts are empty. Rows without id are judged for quality, keep all their lines, and pass
the stages that compare documents, which cannot name them. Of rows that repeat an id one stays, that
of least text. Columns beyond doc_id and text pass through; ``n_chars`` follows a text that changes.
An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.llm import byte_bpe, decontaminate, line_dedup, near_dups, quality
from mercato.llm.common import table, unused, with_keys
from mercato.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Words of a shingle where documents are compared.
SHINGLE = 5


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that score 0.5 or more."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), "quality", quality.trained_here())
    return docs.where(quality.scorer(spark, model)(docs["text"]) >= 0.5)


def first_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: without lines like an earlier one, and without documents that this leaves without words."""
    _, gone = line_dedup.repeated_lines(docs)
    source, lines = unused(docs, "gone_from"), unused(docs, "gone_lines")
    gone = gone.select(F.col("doc_id").alias(source), F.col("removed").alias(lines))
    joined = docs.join(gone, F.col("doc_id") == F.col(source), "left")
    untouched, text = F.col(lines).isNull(), line_dedup.without_lines(F.col("text"), F.col(lines))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(untouched, F.col("n_chars")).otherwise(F.length(text).cast(kind))
    return joined.where(untouched | text.rlike(line_dedup.ANY_WORD)).withColumns(changed).drop(source, lines)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: the document of least id out of each group of near duplicates."""
    groups = stage(near_dups.duplicate_groups(docs, size=SHINGLE), "duplicate-groups")
    named = docs.where("doc_id IS NOT NULL")
    if named.count() != groups.count():  # ids repeat
        nth, first = unused(docs, "nth"), F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
        named = named.withColumn(nth, first).where(F.col(nth) == 1).drop(nth)
        docs = named.unionByName(docs.where("doc_id IS NULL"))
    return with_keys(docs, groups.where("doc_id <> component").select("doc_id"), ["doc_id"], "left_anti").select(*docs.columns)


def unseen_by_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: without documents of which benchmark passages make up a twentieth or more."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    tainted = stage(found.where(decontaminate.is_contaminated()).select("doc_id").distinct(), "contaminated")
    return with_keys(docs, tainted, ["doc_id"], "left_anti").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: token ids, and whether they decode to the text's own bytes."""
    return byte_bpe.tokenized(docs, byte_bpe.codec())


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_documents),
    ("line_dedup", first_lines),
    ("near_dedup", one_of_each),
    ("decontaminate", unseen_by_benchmarks),
    ("tokenize", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: The classifier and the encoder are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None
