"""URL filters: glob rules packed into multiword Shift-And masks.

``*`` stands for any run of characters but ``/``, ``**`` for any run, ``?`` for one character but
``/``. Each rule takes a start state and one state per literal; all rules lie side by side in
64-bit words. A step reads one byte of every URL of a batch and moves all rules at once:

    D = (D << 1) & M[byte]  |  D & L[byte]

M has the states that a byte leads into, L those that it may stay in (the wildcards). A rule
matches if its last state is set after the last byte, so rules always cover the whole URL.

Per row, without a shuffle; the masks grow with the rules, not with the data.

Rows: a null URL or one without ``://`` has an empty host and path, which are judged as they are.
Repeated rows give repeated results. Rules that fit equally well: the longer pattern wins, then
block before allow, then the order given.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.common import ascii_lower, table


@dataclass(frozen=True)
class Rule:
    """A verdict for canonical URLs (host and path). ``name``: what results call it."""

    verdict: str
    globs: tuple[str, ...]
    name: str
    listed: bool = False

    @staticmethod
    def host(verdict: str, host: str, path: str) -> Rule:
        """For a host, its subdomains, and the paths that start so."""
        plain = "".join(f"[{c}]" if c in "*?[" else c for c in host + path)
        return Rule(verdict, (f"{plain}**", f"*.{plain}**"), host + path, listed=True)

    @staticmethod
    def glob(verdict: str, pattern: str) -> Rule:
        return Rule(verdict, (pattern,), pattern)


#: Fixed values of the query.
HOST_RULES = (
    Rule.host("allow", "com", "/"),
    Rule.host("block", "example.com", "/en/"),
    Rule.host("allow", "www.example.com", "/en/"),
    Rule.host("block", "net", "/es/"),
    Rule.host("block", "net", "/fr/"),
)
#: Wildcards for what no host rule covers; whatever none of them fits is allowed.
GLOB_RULES = (
    Rule.glob("block", "ads.**"),
    Rule.glob("block", "*.ads.**"),
    Rule.glob("block", "**casino**"),
    Rule.glob("block", "**/wp-login*"),
    Rule.glob("block", "**/cgi-bin/**"),
    Rule.glob("block", "**.exe"),
    Rule.glob("block", "**/*.zip"),
    Rule.glob("block", "m.*.org/**/??"),
    Rule.glob("allow", "blog.*.org/**"),
)


def _parse(pattern: str) -> list[tuple[str, bytes | None]]:
    """Steps: ("byte", b), ("one", None), ("run", None) or ("all", None); ``[c]`` is the character c."""
    steps: list[tuple[str, bytes | None]] = []
    i = 0
    while i < len(pattern):
        c = pattern[i]
        if c == "[" and pattern[i + 2 : i + 3] == "]":
            steps += [("byte", bytes([b])) for b in pattern[i + 1].encode()]
            i += 3
        elif c == "*":
            end = i
            while pattern[end : end + 1] == "*":
                end += 1
            steps.append(("all" if end - i > 1 else "run", None))
            i = end
        else:
            steps += [("one", None)] if c == "?" else [("byte", bytes([b])) for b in c.encode()]
            i += 1
    return steps


class Automaton:
    """All rules as one bit-parallel machine. Rules are held best first."""

    def __init__(self, rules: tuple[Rule, ...]) -> None:
        order = sorted(range(len(rules)), key=lambda i: (not rules[i].listed, -len(rules[i].name), rules[i].verdict != "block", i))
        self.rules = [rules[i] for i in order]
        moves: list[tuple[int, range | list[int]]] = []
        loops: list[tuple[int, bool]] = []
        starts, self.ends, self.owner = [], [], []
        state = 0
        for k, rule in enumerate(self.rules):
            for glob in rule.globs:
                starts.append(state)
                for kind, byte in _parse(glob):
                    if kind in ("run", "all"):
                        loops.append((state, kind == "all"))
                        continue
                    state += 1
                    moves.append((state, [byte[0]] if byte else [b for b in range(256) if b != ord("/")]))
                self.ends.append(state)
                self.owner.append(k)
                state += 1
        words = max(1, -(-state // 64))
        self.move, self.stay = np.zeros((256, words), np.uint64), np.zeros((256, words), np.uint64)
        self.start = np.zeros(words, np.uint64)
        bit = lambda s: np.uint64(1 << (s % 64))
        for s, taken in moves:
            self.move[taken, s // 64] |= bit(s)
        for s, slash in loops:
            self.stay[[b for b in range(256) if slash or b != ord("/")], s // 64] |= bit(s)
        for s in starts:
            self.start[s // 64] |= bit(s)

    def best(self, urls: list[bytes]) -> np.ndarray:
        """Index of the best fitting rule of each URL, -1 for none."""
        sizes = np.array([len(u) for u in urls], dtype=np.int64)
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        buffer = np.frombuffer(b"".join(urls), dtype=np.uint8)
        at = np.concatenate(([0], np.cumsum([len(u) for u in urls])))[:-1][order].astype(np.int64)
        d = np.tile(self.start, (len(urls), 1))
        live = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), side="left")
        for j, n in enumerate(live):  # longest first: the first n still have a byte here
            codes, now = buffer[at[:n] + j], d[:n]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            d[:n] = (moved & self.move[codes]) | (now & self.stay[codes])
        found = np.full(len(urls), len(self.rules), dtype=np.int64)
        for end, k in zip(self.ends, self.owner, strict=True):
            hit = (d[:, end // 64] >> np.uint64(end % 64)) & np.uint64(1) > 0
            found[hit] = np.minimum(found[hit], k)
        out = np.empty_like(found)
        out[order] = np.where(found == len(self.rules), -1, found)
        return out


def host_path(url: Column) -> tuple[Column, Column]:
    """Canonical form: lower-case host after the first ``://``, then the path without query and fragment."""
    scheme_end = F.instr(url, "://")
    rest = F.when(scheme_end > 0, F.substring(url, scheme_end + F.lit(3), F.length(url)))
    host = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return ascii_lower(host), path


def judge(pages: DataFrame, rules: tuple[Rule, ...], id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """id, host, path, rule (the host rule that decided, else null), wildcard (the one that did), verdict."""
    machine = Automaton(rules)

    @F.pandas_udf("int")
    def best(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for host, path in parts:
            urls = [(h + p).encode() for h, p in zip(host, path, strict=True)]
            found = [machine.best(urls[i : i + 2048]) for i in range(0, len(urls), 2048)]
            yield pd.Series(np.concatenate(found) if found else np.empty(0, np.int64))

    named = pages.select(pages[id_col].alias(id_col), pages[url_col].alias("__url"))
    host, path = host_path(F.col("__url"))
    parts = named.select(id_col, host.alias("host"), path.alias("path"))
    by = F.col("__best")
    pick = lambda values: F.get(F.array(*[F.lit(v) for v in values]), by)
    listed = [r.name if r.listed else None for r in machine.rules]
    wild = [None if r.listed else r.name for r in machine.rules]
    return parts.withColumn("__best", best("host", "path")).select(
        id_col, "host", "path",
        F.when(by >= 0, pick(listed)).cast("string").alias("rule"),
        F.when(by >= 0, pick(wild)).cast("string").alias("wildcard"),
        F.when(by >= 0, pick([r.verdict for r in machine.rules])).otherwise(default).alias("verdict"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), HOST_RULES + GLOB_RULES)


def _like(rule: Rule) -> str:
    """The rule as a DuckDB regular expression test on ``u``."""
    out = []
    for kind, byte in _parse(rule.globs[0]):
        out.append({"one": "[^/]", "run": "[^/]*", "all": "(?s:.*)"}.get(kind) or (byte.decode() if byte.isalnum() else "\\" + byte.decode()))
    return f"regexp_full_match(u, '{''.join(out)}')"


def _oracle() -> str:
    hosts = sorted(HOST_RULES, key=lambda r: -len(r.name))
    fits = lambda r: (lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}')")(*r.name.split("/", 1))
    wild = [r for r in Automaton(GLOB_RULES).rules]
    return f"""
WITH rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT page_id,
    translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
urls AS (SELECT *, host || path AS u, CASE {' '.join(f"WHEN {fits(r)} THEN '{r.name}'" for r in hosts)} END AS rule FROM parts),
judged AS (SELECT *, CASE WHEN rule IS NULL THEN CASE {' '.join(f"WHEN {_like(r)} THEN '{r.name}'" for r in wild)} END END AS wildcard FROM urls)
SELECT page_id, host, path, rule, wildcard, CASE
    {' '.join(f"WHEN rule = '{r.name}' THEN '{r.verdict}'" for r in hosts)}
    {' '.join(f"WHEN wildcard = '{r.name}' THEN '{r.verdict}'" for r in wild)} ELSE 'allow' END AS verdict
FROM judged"""


ORACLE_SQL = _oracle()
