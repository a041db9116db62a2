r"""Exact n-gram Jaccard join by adaptive multi-match prefixes, up to the components of its links.

Texts are sets of word shingles, tokens here; two sets of n and m tokens link if they share at least
``threshold`` percent of their union, so at least t(n) = ceil(threshold * n / 100) tokens. Under any
order of all tokens, two such sets share l tokens or more among their first n - t(n) + l and
m - t(m) + l tokens: their prefixes of level l. A document of level l takes part with that prefix,
and a pair needs as many shared prefix tokens as the lower of its two levels says.

1. Documents of equal sets are one class, whose least id stands for it.
2. All classes post a prefix of base level ``1 + n // 20``, in order of the tokens' hashes. A token is
   open if it is held in several components (at first each class is one). A class with fewer open
   prefix tokens than any partner's level asks for has no link and is out, exactly. Each other class
   names the head of most of its tokens, a holder of another component; these pairs are verified on
   their sets and the links joined into components, which ties most groups of copies.
3. All tokens of the classes left are counted, by documents and components. No link across
   components has a closed token in it, so a class with fewer than t(n) open tokens is done. The
   others order their tokens by rarity, closed ones first, and choose the level of least estimated
   cost: of matches in the posting lists, and of verifying the pairs that reach the level, at most
   1/l of the matches. Clean texts and tied groups of copies are gone by then.
4. What still shares open tokens across components is matched in full: pairs meet in the list of the
   first token that both have, where a task that holds a block of the list on either side counts the
   tokens that the prefixes share. Pairs below the lower of their levels go, and pairs that could not
   reach the threshold if they shared all tokens behind the prefix that ends first. Where the prefixes are
   whole sets, as in lists of large groups, the count is the intersection: such links tie their components
   in the task, and only pairs of components that nothing has tied yet leave it. Other pairs are verified.
   So no link is missed, and a group of k classes sends less than k links from each task.

Skew: a task pools the documents of each token in parts of ``POOL`` tokens before they are dealt out, so a
token that a third of all documents hold is a row per pool. Heads are verified in parts of ``PART``
members, lists matched in blocks of ``BLOCK`` members or ``BLOCK_TOKENS`` prefix tokens. Tokens and sets are 64-bit hashes; equal hashes of unlike
shingles only change the order, but for two in one compared pair, which verification would count.

Rows: words are split at ASCII white space after lower-casing A-Z. A text with fewer words than a
shingle is one shingle; a null, empty or blank text has none and is linked with nothing. Rows that
repeat an id are one document, of unlike texts the least counts. Rows without id give a row each,
without component, and are compared with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from mercato.llm.common import SPACED, hashed_words, id_text, map_rows, shingle_hashes, table
from mercato.llm.components import components
from mercato.session import stage

#: Words of a shingle; similarity in percent; tokens pooled in a task; tokens per level of a base prefix;
#: members verified against a head at a time; members and prefix tokens of a block of a list.
SIZE, THRESHOLD, POOL, BASE, PART, BLOCK, BLOCK_TOKENS = 5, 80, 1 << 19, 20, 256, 1024, 1 << 21
#: Costs: of a token that a prefix carries, of a match in a list, of a token in a verification.
CARRY, MATCH, VERIFY = 1.0, 0.05, 1.0


def tokens(text: str, size: int) -> np.ndarray:
    """Distinct shingle hashes in order."""
    return np.unique(shingle_hashes(hashed_words(text.encode().translate(SPACED))[0], size))


def least_shared(n: int, threshold: int) -> int:
    """Tokens that a set of n shares with any partner, at least."""
    return -(-threshold * n // 100)


def base_level(n: int) -> int:
    return 1 + n // BASE


def level_of(df: np.ndarray, n: int, threshold: int) -> int:
    """Level of least estimated cost, for the rising counts of n's open tokens.

    The prefix is carried to each list of level 1; each other holder of a prefix token is a match; at
    most 1/level of the matches are pairs that reach the level and are verified, n tokens each.
    """
    t = least_shared(n, threshold)
    spare = len(df) - t  # open tokens of the prefix beyond its level
    level = np.arange(1, t + 1)
    matches = np.cumsum(df - 1)[spare:][:t]
    return int(np.argmin(CARRY * (spare + 1) * (spare + level) + MATCH * matches + VERIFY * n * (matches / level))) + 1


def sized(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n, digest) of each set."""

    def rows(source: Iterator[dict]) -> Iterator[tuple]:
        for r in source:
            found = tokens(r["text"], size)
            yield r["doc_id"], len(found), xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None

    return map_rows(docs, rows, f"doc_id {_kind(docs)}, n long, digest binary")


def _kind(df: DataFrame, column: str = "doc_id") -> str:
    return df.schema[column].dataType.simpleString()


def pooled(docs: DataFrame, size: int, threshold: int, whole: bool) -> DataFrame:
    """(token, component, id, more) of (doc_id, component, text): who holds a token in a pool.

    ``component`` and ``id`` are those of the pool's least holder, ``more`` has the others. With
    ``whole`` all tokens, else those of base level prefixes.
    """
    kind = _kind(docs)
    schema = docs.sparkSession.createDataFrame([], f"token long, component {kind}, id {kind}, more array<struct<component:{kind},id:{kind}>>").schema
    arrow = to_arrow_schema(schema)

    def pool(held: list[tuple]) -> pa.RecordBatch:
        held.sort(key=lambda h: (h[1] if h[0] is None else h[0], h[1]))
        where = np.concatenate([np.full(len(h[2]), i, np.int32) for i, h in enumerate(held)])
        what = np.concatenate([h[2] for h in held])
        order = np.argsort(what, kind="stable")
        what, where = what[order], where[order]
        first = np.flatnonzero(np.r_[True, what[1:] != what[:-1]])
        rest = np.ones(len(what), bool)
        rest[first] = False
        side = [pa.array([h[k] for h in held], arrow.field("id").type) for k in (0, 1)]
        others = pa.StructArray.from_arrays([c.take(pa.array(where[rest])) for c in side], fields=list(arrow.field("more").type.value_type))
        counts = np.diff(np.r_[first, len(what)]) - 1
        offsets = np.zeros(len(first) + 1, np.int32)
        np.cumsum(counts, out=offsets[1:])
        none = pa.array(np.r_[counts == 0, False])
        more = pa.ListArray.from_arrays(pa.array(offsets, mask=none.to_numpy(zero_copy_only=False)), others, type=arrow.field("more").type)
        lead = [c.take(pa.array(where[first])) for c in side]
        return pa.RecordBatch.from_arrays([pa.array(what[first].view(np.int64)), *lead, more], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for b in batches:
            for key, component, text in zip(b.column("doc_id"), b.column("component"), b.column("text"), strict=True):
                found = tokens(text.as_py(), size)
                if not whole:
                    found = found[: len(found) - least_shared(len(found), threshold) + base_level(len(found))]
                if not len(found):
                    continue
                held.append((component.as_py(), key.as_py(), found))  # no component: its own
                total += len(found)
                if total >= POOL:
                    yield pool(held)
                    held, total = [], 0
        if held:
            yield pool(held)

    return docs.select("doc_id", "component", "text").mapInArrow(run, schema)


def _holder() -> Column:
    return F.struct("component", "id")


def _head() -> Column:
    """Orders the holders of a token; the least heads it. By hash, so that no id is head of much more than its own."""
    return F.struct(F.xxhash64("id").alias("at"), "component", "id")


def open_tokens(pools: DataFrame) -> DataFrame:
    """(token, df, head, component, id) per holder of a token that several components hold; the head is one of them."""
    pools = pools.repartition("token")  # before the columns that follow from these
    others = F.transform(
        F.coalesce("more", F.array().cast(pools.schema["more"].dataType)),
        lambda h: F.struct(F.coalesce(h["component"], h["id"]).alias("component"), h["id"].alias("id")),
    )
    pools = pools.select("token", F.coalesce("component", "id").alias("component"), "id", others.alias("more"))
    by = Window.partitionBy("token")
    found = pools.select(
        "*",
        F.min("component").over(by).alias("lo"),
        F.max(F.coalesce(F.array_max("more")["component"], F.col("component"))).over(by).alias("hi"),
        F.min(_head()).over(by).alias("head"),
        F.sum(F.lit(1) + F.size("more")).over(by).alias("df"),
    ).where("lo <> hi")
    return found.select("token", "df", "head", F.inline(F.concat(F.array(_holder()), "more")))


def named_heads(held: DataFrame) -> DataFrame:
    """(id, open, component, head, of, shared): open tokens of each holder, and the head of most of them that is
    in another component, if any."""
    other = F.col("head.component") != F.col("component")
    times = held.groupBy("id", "component", F.when(other, F.struct("head.component", "head.id")).alias("head")).agg(F.count("*").alias("n"))
    best = F.min(F.when(F.col("head").isNotNull(), F.struct((-F.col("n")).alias("n"), F.col("head.id").alias("id"), F.col("head.component").alias("of"))))
    found = times.groupBy("id", "component").agg(F.sum("n").alias("open"), best.alias("best"))
    return found.select("id", "open", "component", F.col("best.id").alias("head"), F.col("best.of").alias("of"), (-F.col("best.n")).alias("shared"))


def one_a_pair(named: DataFrame) -> DataFrame:
    """(u, v): of the pairs between two components the one that shares most tokens."""
    named = named.where("head IS NOT NULL")
    ends = F.least("component", "of").alias("a"), F.greatest("component", "of").alias("b")
    best = named.groupBy(*ends).agg(F.min(F.struct((-F.col("shared")).alias("shared"), "id", "head")).alias("best"))
    return best.select(F.col("best.id").alias("u"), F.col("best.head").alias("v"))


def verified(pairs: DataFrame, docs: DataFrame, size: int, threshold: int) -> DataFrame:
    """Staged pairs (u, v) whose sets are as similar as the threshold says. Members are dealt to their v in parts."""
    kind = _kind(docs)
    pairs = stage(pairs.select("u", "v").distinct(), "pairs")
    parts = pairs.groupBy("v").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    members = pairs.join(parts, "v").select(
        F.col("u").alias("doc_id"), "v", F.pmod(F.xxhash64("u"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("place")
    )
    heads = parts.select(F.col("v").alias("doc_id"), "v", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("place"))
    rows = docs.select("doc_id", "text").join(members.unionByName(heads), "doc_id").select("v", "part", "place", F.col("doc_id").alias("u"), "text")
    dealt = rows.repartition("v", "part").sortWithinPartitions("v", "part", "place")

    def compare(source: Iterator[dict]) -> Iterator[tuple]:
        head = np.empty(0, np.uint64)
        for r in source:
            found = tokens(r["text"], size)
            if r["place"] == 0:
                head = found
                continue
            shared = len(np.intersect1d(head, found, assume_unique=True))
            if shared * 100 >= threshold * (len(head) + len(found) - shared):
                yield r["u"], r["v"]

    return stage(map_rows(dealt, compare, f"u {kind}, v {kind}"), "links")


def _of(ids: DataFrame, member: DataFrame | None) -> DataFrame:
    """(id, …, component) of ids, their own where they are tied to nothing."""
    if member is None:
        return ids.withColumn("component", F.col("id"))
    member = member.select("id", F.col("component").alias("known"))
    return ids.join(member, "id", "left").withColumn("component", F.coalesce("known", "id")).drop("known")


def _joined(links: DataFrame | None, more: DataFrame) -> DataFrame:
    """Staged stars (u, v) of the components of both."""
    member = components(more if links is None else links.unionByName(more))
    return stage(member.where("id <> component").select(F.col("id").alias("u"), F.col("component").alias("v")), "stars")


def _members(stars: DataFrame) -> DataFrame:
    return stars.select(F.col("u").alias("id"), F.col("v").alias("component"))


def undecided(held: DataFrame, sizes: DataFrame, threshold: int) -> DataFrame:
    """Staged (id, component, n, level, closed, cut, found): classes with open tokens enough for a link across
    components, the level they choose, how many tokens are closed, and the open ones as (df, token) by rarity,
    of which ``cut`` are in the prefix."""

    @F.pandas_udf("long")
    def chosen(counts: pd.Series, sizes: pd.Series) -> pd.Series:
        return pd.Series([level_of(np.asarray(df, np.int64), n, threshold) for df, n in zip(counts, sizes, strict=True)], dtype="int64")

    listed = held.groupBy("id", "component").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("found")).join(sizes, "id")
    listed = listed.where(F.size("found") * 100 >= threshold * F.col("n")).withColumn("level", chosen("found.df", "n"))
    known = F.size("found").cast("long")
    cut = known - F.ceil(F.lit(threshold) * F.col("n") / 100) + F.col("level")
    return stage(listed.select("id", "component", "n", "level", (F.col("n") - known).alias("closed"), cut.alias("cut"), "found"), "undecided")


def matched(sets: DataFrame, threshold: int) -> DataFrame:
    """Staged (u, v, sure): pairs of ``undecided`` classes of different components that share as many prefix
    tokens as their levels ask for and may share enough in all; ``sure``: they do."""
    kind = _kind(sets, "id")
    first = F.col("cut") - F.col("level") + 1  # tokens of level 1
    lists = sets.select("id", "cut", F.explode(F.slice("found", F.lit(1), first.cast("int"))).alias("entry"))
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.least(F.ceil(F.sum("cut") / BLOCK_TOKENS), F.count("*"))).cast("int")
    sized = lists.groupBy("entry").agg(blocks.alias("blocks"), F.count("*").alias("holders")).where("holders > 1")
    dealt = lists.select("entry", "id").join(sized.select("entry", "blocks"), "entry").select(
        "entry", "id", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("own"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    ).select("entry", "id", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    carried = F.slice("found", F.lit(1), F.col("cut").cast("int"))
    full = dealt.join(sets.select("id", "n", "level", "component", (F.size("found") - F.col("cut")).alias("rest"), carried.alias("prefix")), "id").select(
        "entry", "i", "j", "own", "id", "n", "level", "component", "rest", F.col("prefix.df").alias("dfs"), F.col("prefix.token").alias("tokens")
    )
    full = full.repartition("entry", "i", "j").sortWithinPartitions("entry", "i", "j")

    def run(source: Iterator[dict]) -> Iterator[tuple]:
        for (df, token, i, j), members in groupby(source, key=lambda r: (r["entry"]["df"], r["entry"]["token"], r["i"], r["j"])):
            members = list(members)
            if len({r["component"] for r in members}) > 1:
                yield from _pairs(members, df, token, i, j, threshold)

    return stage(map_rows(full, run, f"u {kind}, v {kind}, sure boolean"), "matched")


def _pairs(members: list[dict], df: int, token: int, i: int, j: int, threshold: int) -> Iterator[tuple]:
    """Pairs of a block i with a block j of the list of a token, by the rules of ``matched``."""
    a = [r for r in members if r["own"] == i]
    b = a if i == j else [r for r in members if r["own"] == j]
    if not a or not b:
        return
    both = a if i == j else a + b
    what = np.concatenate([np.asarray(r["tokens"], np.int64) for r in both])
    counts = np.concatenate([np.asarray(r["dfs"], np.int64) for r in both])
    where = np.concatenate([np.full(len(r["tokens"]), k) for k, r in enumerate(both)])
    known, first, at, times = np.unique(what, return_index=True, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(times > 1)  # others are common to no pair
    before = (counts[first[shared]] < df) | ((counts[first[shared]] == df) & (known[shared] < token))
    common = np.zeros((len(a), len(b)), np.float32)
    earlier = np.zeros((len(a), len(b)), np.float32)
    number = np.full(len(known), -1)
    number[shared] = np.arange(len(shared))
    column = number[at]
    for start in range(0, len(shared), 2048):
        here = (column >= start) & (column < start + 2048)
        held = np.zeros((len(both), min(2048, len(shared) - start)), np.float32)
        held[where[here], column[here] - start] = 1
        left, right = held[: len(a)], held if i == j else held[len(a) :]
        common += left @ right.T
        old = before[start : start + 2048]
        if old.any():
            earlier += left[:, old] @ right[:, old].T
    get = lambda rows, c: np.array([r[c] for r in rows], np.int64)
    na, nb = get(a, "n")[:, None], get(b, "n")[None, :]
    of = {c: k for k, c in enumerate(dict.fromkeys(r["component"] for r in both))}
    ca, cb = (np.array([of[r["component"]] for r in rows]) for rows in (a, b))
    needed = -(-threshold * (na + nb) // (100 + threshold))
    # common tokens that were not counted lie behind the prefix that ends first
    (da, ta), (db, tb) = ((np.array([r["dfs"][-1] for r in rows]), np.array([r["tokens"][-1] for r in rows])) for rows in (a, b))
    sooner = (da[:, None] < db[None, :]) | ((da[:, None] == db[None, :]) & (ta[:, None] <= tb[None, :]))
    reach = common + np.where(sooner, get(a, "rest")[:, None], get(b, "rest")[None, :])
    good = (earlier == 0) & (ca[:, None] != cb[None, :]) & (common >= np.minimum(get(a, "level")[:, None], get(b, "level")[None, :]))
    good &= (reach >= needed) & (100 * np.minimum(na, nb) >= threshold * np.maximum(na, nb))
    if i == j:
        good = np.triu(good, 1)
    whole = (get(a, "rest")[:, None] == 0) & (get(b, "rest")[None, :] == 0)
    sure = good & whole & (common * 100 >= threshold * (na + nb - common))
    tied = np.arange(len(of))  # by component, the one that stands for it now
    for x in np.flatnonzero(sure.any(axis=1)):
        while len(left := np.flatnonzero(sure[x] & (tied[cb] != tied[ca[x]]))):
            yield a[x]["id"], b[left[0]]["id"], True
            tied[tied == tied[cb[left[0]]]] = tied[ca[x]]
    rest = good & ~whole & (tied[ca][:, None] != tied[cb][None, :])
    for x, y in zip(*np.nonzero(rest), strict=True):
        yield a[x]["id"], b[y]["id"], False


def similar_classes(docs: DataFrame, size: int = SIZE, threshold: int = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, component) per document."""
    if not 50 <= threshold <= 100:
        raise ValueError("threshold: 50 to 100 percent")
    every = id_text(docs, id_col, text_col)
    docs = every.where("doc_id IS NOT NULL")
    if docs.groupBy("doc_id").count().where("count > 1").limit(1).count():
        docs = docs.groupBy("doc_id").agg(F.min("text").alias("text"))
    sets = stage(sized(docs, size), "sets")
    filled = sets.where("n > 0")
    classes = stage(filled.groupBy("digest").agg(F.min("doc_id").alias("id"), F.min("n").alias("n")), "classes")
    sizes = classes.select("id", "n")

    def texts(ids: DataFrame) -> DataFrame:
        return docs.join(ids.withColumnRenamed("id", "doc_id"), "doc_id")

    # base level, in order of the hashes
    own = classes.select("id", F.lit(None).cast(_kind(classes, "id")).alias("component"))
    found = open_tokens(pooled(texts(own), size, threshold, whole=False))
    partner = F.ceil(F.lit(threshold) * F.col("n") / 100)  # size of the smallest partner
    alive = named_heads(found).join(sizes, "id").where(F.col("open") >= 1 + F.floor(partner / BASE))
    alive = stage(alive.select("id", "component", "head", "of", "shared"), "prefixes-that-meet")
    stars = _joined(None, verified(one_a_pair(alive), docs, size, threshold))

    # all tokens of what is left, and full matching of what they leave
    held = open_tokens(pooled(texts(_of(alive.select("id"), _members(stars))), size, threshold, whole=True))
    pairs = matched(undecided(held, sizes, threshold), threshold)
    if pairs.limit(1).count():
        links = pairs.where("sure").select("u", "v").unionByName(verified(pairs.where("NOT sure"), docs, size, threshold))
        stars = _joined(stars, links)

    member = _members(stars)
    named = filled.join(classes.select("digest", "id"), "digest").select("doc_id", "n", "id")
    out = _of(named, member).select("doc_id", "n", "component")
    blank = sets.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component"))
    nameless = sized(every.where("doc_id IS NULL"), size).select("doc_id", "n", F.col("doc_id").alias("component"))
    return out.unionByName(blank).unionByName(nameless)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_classes(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id")
    )


_TEXT_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x20\x09-\x0D]+')"
)
ORACLE_SQL = f"""
WITH RECURSIVE doc AS (SELECT doc_id, {_TEXT_WORDS} AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM doc, generate_series(1, greatest(len(w) - 4, least(len(w), 1))) t(i)),
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
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM component LEFT JOIN size USING (doc_id)"""
