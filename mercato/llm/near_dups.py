r"""Near-duplicate documents: MinHash bands, sequential Bayesian verification, exact confirmation.

1. Each text becomes its set of word shingles, a digest of the set, ``BANDS`` band keys of ``ROWS``
   min-hashes each, and one byte of every min-hash. Texts with equal sets are one class, whose least
   document id stands for it from here on.
2. In each bucket (equal band key) every class is paired with the bucket's least id only.
3. Pairs are compared by batches of signature bytes. After each batch a pair goes as soon as the
   posterior probability that its similarity reaches the threshold is below ``MISS`` (uniform prior).
   What is left is confirmed on the full sets, read again for just these documents.
4. Confirmed links are merged into components. Pairs within a component need no further look, so
   only the least pair of each class is confirmed first, then those that still join two components.
5. Buckets that still hold several components are compared in full, by the same batches and then on
   full sets, cut into blocks of ``BLOCK`` classes or ``BLOCK_SHINGLES`` shingles, whichever is
   less, that separate tasks compare; only links that tie
   components leave a task. So no link that matters is missed, and no bucket ever makes all its pairs.

The chance that a pair of similarity s shares no bucket is (1 - s^ROWS)^BANDS: 6e-7 at 0.8.

Rows: words are split at ASCII white space after lower-casing A-Z. A text with fewer words than a
shingle is one shingle; a null, empty or blank text has none, is linked with nothing and kept.
Rows that repeat an id are one document; if their texts differ, the set of least digest counts.
Rows without id are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.common import SPACED, hashed_words, id_text, map_rows, mix, only_ids, shingle_hashes, table
from mercato.llm.components import components
from mercato.session import stage

BANDS, ROWS = 36, 5
#: Similarity in percent; posterior below which a pair goes; signature bytes per batch; classes and
#: shingles (of 8 bytes) per block, on average.
THRESHOLD, MISS, BATCH, BLOCK, BLOCK_SHINGLES = 80, 1e-9, 30, 512, 1 << 23
_HASHES = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)


def shingles(text: str, size: int) -> np.ndarray:
    """Distinct shingle hashes in order."""
    return np.unique(shingle_hashes(hashed_words(text.encode().translate(SPACED))[0], size))


def min_hashes(found: np.ndarray) -> np.ndarray:
    least = np.full(len(_HASHES), np.uint64(2**64 - 1))
    with np.errstate(over="ignore"):
        for start in range(0, len(found), 2048):
            part = found[None, start : start + 2048] * _HASHES[:, None]
            np.minimum(least, part.min(axis=1), out=least)
    return least


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n, digest, bands, bytes) of (doc_id, text)."""

    def rows(source: Iterator[dict]) -> Iterator[tuple]:
        for r in source:
            found = shingles(r["text"], size)
            if not len(found):
                yield r["doc_id"], 0, None, [], None
                continue
            least = min_hashes(found)
            bands = [
                xxhash.xxh3_64_intdigest(least[i * ROWS : (i + 1) * ROWS].tobytes(), seed=i) - 2**63 for i in range(BANDS)
            ]
            signature = (mix(least) >> np.uint64(56)).astype(np.uint8).tobytes()
            yield r["doc_id"], len(found), xxhash.xxh3_128_digest(found.tobytes()), bands, signature

    key = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(docs, rows, f"doc_id {key}, n long, digest binary, bands array<long>, bytes binary", batch=1024)


def least_matches(threshold: int = THRESHOLD, miss: float = MISS, hashes: int = BANDS * ROWS, batch: int = BATCH) -> list[tuple[int, int]]:
    """(bytes seen, matches needed to go on). With m of n matches and a uniform prior the posterior
    is Beta(m+1, n-m+1), whose upper tail at t is the probability of at most m hits in n+1 draws."""
    t = threshold / 100
    t += (1 - t) / 256  # bytes also match by chance
    out = []
    for n in range(batch, hashes + 1, batch):
        tail, m = 0.0, -1
        while m < n:
            tail += math.comb(n + 1, m + 1) * t ** (m + 1) * (1 - t) ** (n - m)
            if tail >= miss:
                break
            m += 1
        out.append((n, m + 1))
    return out


def passing(a: np.ndarray, b: np.ndarray, steps: list[tuple[int, int]]) -> np.ndarray:
    """Row numbers of signature pairs that no batch rules out."""
    alive, seen, matches = np.arange(len(a)), 0, np.zeros(len(a), np.int64)
    for n, needed in steps:
        matches = matches + (a[alive, seen:n] == b[alive, seen:n]).sum(axis=1)
        keep = matches >= needed
        alive, matches, seen = alive[keep], matches[keep], n
    return alive


def _matrix(column: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(len(column), BANDS * ROWS)


def plausible(pairs: DataFrame, nodes: DataFrame, threshold: int) -> DataFrame:
    """Pairs (u, v) that the Bayesian comparison lets pass."""
    steps = least_matches(threshold)

    @F.pandas_udf("boolean")
    def likely(a: pd.Series, b: pd.Series) -> pd.Series:
        out = np.zeros(len(a), bool)
        if len(a):
            out[passing(_matrix(list(a)), _matrix(list(b)), steps)] = True
        return pd.Series(out)

    sides = [nodes.select(F.col("id").alias(k), F.col("bytes").alias(f"bytes_{k}")) for k in ("u", "v")]
    return pairs.join(sides[0], "u").join(sides[1], "v").where(likely("bytes_u", "bytes_v")).select("u", "v")


def _sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """Staged (doc_id, found): the full sets of at least these documents, one row each."""

    def rows(source: Iterator[dict]) -> Iterator[tuple]:
        for r in source:
            found = shingles(r["text"], size)
            yield r["doc_id"], xxhash.xxh3_128_digest(found.tobytes()), found.view(np.int64).tolist()

    key = docs.schema["doc_id"].dataType.simpleString()
    sets = stage(map_rows(only_ids(docs, ids), rows, f"doc_id {key}, digest binary, found array<long>", batch=512), "shingle-sets")
    if sets.groupBy("doc_id").count().where("count > 1").limit(1).count():  # repeated ids: see the module's text
        least = sets.groupBy("doc_id").agg(F.min("digest").alias("digest"))
        sets = sets.join(least, ["doc_id", "digest"]).dropDuplicates(["doc_id"])
    return sets.select("doc_id", "found")


def confirmed(pairs: DataFrame, docs: DataFrame, size: int, threshold: int) -> DataFrame:
    """Staged pairs (u, v) whose full sets are as similar as the threshold says."""
    sets = _sets(docs, pairs.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct(), size)
    sides = [sets.select(F.col("doc_id").alias(k), F.col("found").alias(f"found_{k}")) for k in ("u", "v")]
    shared = F.size(F.array_intersect("found_u", "found_v"))
    whole = F.size("found_u") + F.size("found_v") - shared
    return stage(pairs.join(sides[0], "u").join(sides[1], "v").where(shared * 100 >= threshold * whole).select("u", "v"), "links")


def _across(pairs: DataFrame, member: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components; (id, component) of linked ids."""
    for k in ("u", "v"):
        side = member.select(F.col("id").alias(k), F.col("component").alias(f"of_{k}"))
        pairs = pairs.join(side, k, "left").withColumn(f"of_{k}", F.coalesce(f"of_{k}", k))
    return pairs.where("of_u <> of_v").select("u", "v")


def in_blocks(rows: DataFrame) -> DataFrame:
    """(key, id, component, own, i, j) of bucket members (key, id, component, n, total: classes and
    shingles in the bucket). Block i meets blocks i and above: a row goes to each pair that holds its own."""
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.least(F.ceil(F.col("total") / BLOCK_SHINGLES), F.col("n"))).cast("int")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    rows = rows.withColumn("blocks", blocks).withColumn("own", own)
    return rows.select(
        "key", "id", "component", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).select("key", "id", "component", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))


def within_buckets(buckets: DataFrame, nodes: DataFrame, member: DataFrame, docs: DataFrame, size: int, threshold: int) -> DataFrame:
    """Links across components in buckets that hold three classes or more, of several components.

    A task compares two blocks of a bucket: signatures first, then, from the most similar on, the
    full sets of what passes, unless a link has tied the two components in this task already. So
    only links leave it, fewer than it has classes.
    """
    steps = least_matches(threshold)
    rows = buckets.join(member, "id", "left").select("key", "id", "shingles", F.coalesce("component", "id").alias("component"))
    mixed = rows.groupBy("key").agg(F.count("*").alias("n"), F.sum("shingles").alias("total"), F.min("component").alias("a"), F.max("component").alias("b")).where("n > 2 AND a <> b")
    rows = stage(rows.join(mixed.select("key", "n", "total"), "key"), "mixed-buckets")
    if not rows.limit(1).count():
        return rows.select(F.col("id").alias("u"), F.col("id").alias("v"))
    sets = _sets(docs, rows.select(F.col("id").alias("doc_id")).distinct(), size).withColumnRenamed("doc_id", "id")
    met = in_blocks(rows)
    met = met.join(nodes.select("id", "bytes").join(sets, "id"), "id")

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        own, ids, of = part["own"].to_numpy(), part["id"].to_numpy(), part["component"].to_numpy()
        sig, sets, same = _matrix(list(part["bytes"])), list(part["found"]), bool((part["i"] == part["j"]).all())
        tied, of = np.unique(of, return_inverse=True)
        tied, found = np.arange(len(tied)), []  # tied: by component, the one that stands for it now
        right = np.flatnonzero(own == part["j"].to_numpy())
        for a in np.flatnonzero(own == part["i"].to_numpy()):
            against = right[(tied[of[right]] != tied[of[a]]) & ((ids[right] < ids[a]) if same else True)]
            if not len(against):
                continue
            against = against[passing(np.broadcast_to(sig[a], (len(against), sig.shape[1])), sig[against], steps)]
            for b in against[np.argsort(-(sig[against] == sig[a]).sum(axis=1), kind="stable")]:
                if tied[of[a]] == tied[of[b]]:
                    continue
                shared = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                if shared * 100 >= threshold * (len(sets[a]) + len(sets[b]) - shared):
                    found.append((max(ids[a], ids[b]), min(ids[a], ids[b])))
                    tied[tied == tied[of[a]]] = tied[of[b]]
        return pd.DataFrame(found, columns=["u", "v"], dtype="int64")

    return met.groupBy("key", "i", "j").applyInPandas(compare, "u long, v long").distinct()


def duplicate_groups(docs: DataFrame, size: int, threshold: int = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, component) per document id."""
    docs = id_text(docs, id_col, text_col).where("doc_id IS NOT NULL")
    found = stage(sketches(docs, size), "sketches")
    one = found.groupBy("doc_id").agg(F.min(F.struct("digest", "n")).alias("s")).select("doc_id", "s.digest", "s.n")
    filled = one.where("n > 0")
    classes = filled.groupBy("digest").agg(F.min("doc_id").alias("id"))
    nodes = stage(
        found.join(classes, "digest").where("doc_id = id").select("id", "n", "bands", "bytes").dropDuplicates(["id"]), "classes"
    )
    buckets = nodes.select("id", F.col("n").alias("shingles"), F.explode("bands").alias("key"))
    heads = buckets.groupBy("key").agg(F.min("id").alias("v"), F.count("*").alias("n")).where("n > 1").select("key", "v")
    shared = stage(buckets.join(heads, "key").select("id", "shingles", "key", "v"), "buckets")  # of classes that share a bucket
    starred = shared.where("id <> v").select(F.col("id").alias("u"), "v").distinct()
    pairs = stage(plausible(starred, nodes, threshold), "plausible-pairs")

    links = confirmed(pairs.groupBy("u").agg(F.min("v").alias("v")), docs, size, threshold)
    member = stage(components(links), "components")
    rest = stage(_across(pairs, member), "further-pairs")
    if rest.limit(1).count():
        links = links.unionByName(confirmed(rest, docs, size, threshold))
        member = stage(components(links), "components")
    rest = stage(within_buckets(shared, nodes, member, docs, size, threshold), "links")
    if rest.limit(1).count():
        member = stage(components(links.unionByName(rest)), "components")
    grouped = filled.join(classes, "digest").join(member, "id", "left")
    return grouped.select("doc_id", "n", F.coalesce("component", "id").alias("component")).unionByName(
        one.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component"))
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = duplicate_groups(table(spark, sf_dir, "documents"), size=2)
    return groups.select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        (F.col("doc_id") == F.col("component")).alias("kept"),
    )


_TEXT_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x20\x09-\x0D]+')"
)
ORACLE_SQL = f"""
WITH RECURSIVE doc AS (SELECT doc_id, {_TEXT_WORDS} AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s
  FROM doc, generate_series(1, greatest(len(w) - 1, least(len(w), 1))) t(i)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
rarity AS (SELECT s, count(*) AS df FROM shingle GROUP BY s),
ranked AS (SELECT doc_id, s, row_number() OVER (PARTITION BY doc_id ORDER BY df, s) AS r FROM shingle JOIN rarity USING (s)),
prefix AS (SELECT doc_id, s, n FROM ranked JOIN size USING (doc_id) WHERE r <= n - ceil(0.8 * n) + 1),
candidate AS (
  SELECT DISTINCT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb FROM prefix a JOIN prefix b USING (s)
  WHERE a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
link AS (
  SELECT a, b FROM candidate c JOIN shingle x ON x.doc_id = a JOIN shingle y ON y.doc_id = b AND y.s = x.s
  GROUP BY a, b, na, nb HAVING 100 * count(*) >= 80 * (na + nb - count(*))),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(a, b) AS (SELECT doc_id, doc_id FROM doc UNION SELECT r.a, e.b FROM reach r JOIN edge e ON e.a = r.b),
component AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM component LEFT JOIN size USING (doc_id)"""
