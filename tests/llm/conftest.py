import glob
import os
import re

import duckdb
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from mercato.llm.common import importable

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="session")
def llm(spark):
    return importable(spark)


@pytest.fixture(scope="session")
def given():
    """doc_id -> text of the small documents table."""
    return dict(duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for file in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(file)[:-8]} AS SELECT * FROM '{file}'")
    return con


LINE = "one two three four five six seven eight nine ten"
ODD_TEXTS = [
    (1, "Alpha beta\ngamma, délta!\n\n" + LINE),
    (2, None),
    (3, ""),
    (4, " \t\n \n"),
    (5, "word"),
    (6, "WORD"),
    (7, LINE + "\n" + LINE.upper()),
    (8, LINE.replace("ten", "other")),  # similar to the line of 1
    (9, LINE.replace("one two three", "a b c")),  # not similar
    (10, "x" * 60_000),
    (11, " ".join(f"w{i % 977}" for i in range(30_000))),
    (12, " ".join(f"w{i % 977}" for i in range(30_000)) + " tail"),
    (13, "emoji 😀😀 line\u2028separator\u00a0space \x1f control \\ <|turn|> </s>"),
    (14, "Released under the MIT License."),
    (14, "Released under the MIT License."),  # a repeated row
    (15, "Alpha beta\ngamma, délta!\n\n" + LINE),  # the text of 1
    (-7, "negative id\nword"),
]


@pytest.fixture(scope="session")
def odd(llm):
    """Documents with odd texts, a repeated row, and columns whose names the operators use, too."""
    names = ("row", "n", "id", "component", "score", "range", "closes", "hits", "words", "key", "removed", "lines", "digest")
    rows = [Row(doc_id=i, text=t, n_chars=len(t or ""), **{c: "x" for c in names}) for i, t in ODD_TEXTS]
    kinds = "doc_id long, text string, n_chars long, " + ", ".join(f"`{c}` string" for c in names)
    return llm.createDataFrame([tuple(r) for r in rows], kinds).repartition(3)


@pytest.fixture(scope="session")
def nameless(odd):
    """The same with rows that have no id."""
    return odd.unionByName(odd.where("doc_id IN (1, 7)").withColumn("doc_id", F.lit(None).cast("long")))


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is None, str(v)) for v in r])
