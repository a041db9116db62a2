"""License scans: a trained paragraph classifier, confirmed by comparison with templates.

A paragraph is a run of lines with words, so a notice may be wrapped over many lines; marks of
comments are no words, and a line of nothing else ends a paragraph. Its words are read in windows of
``WINDOW``, each half overlapping the one before, so any notice of half a window or less lies whole
in one. Hits name the first line of their paragraph and the lines that the notice itself spans. A
window's features are the words and word pairs that occur in templates, all others count as unknown
words. Logistic regression with an L1 penalty, so most weights are zero, gives each licence family a
probability of its own, so a window may hold several. It is trained here, on variants of the templates
(words dropped, set into running text) and on notices of two families, against windows of the corpus
and loose pieces of templates, which are no licence.

The model is calibrated on rows kept out of training: a temperature by likelihood, then the least
probability, of any family, at which no more than ``FALSE_RATE`` of the kept corpus windows without
licence pass. A window that passes is compared with the templates of all families, since the
probability of one says nothing of the others. A family counts if ``CONFIRMED`` percent of the word pairs of one of its
templates are in the window (of a template with free words in it: all its ``PARTS``), and with them all ``KEYS`` of the family that the template has, which
tell it from families of like wording. Names in an SPDX expression count one by one. Wording that
several licences share (the warranty clause of MIT) counts for the family that lists it, and "all
rights reserved" for ``proprietary``, also beside an open licence.

The corpus windows for training come from the ``SAMPLE`` documents of least id hash; a window
counts as without licence if it holds less than half of every template. Scanning is one pass over
whole texts without a shuffle.

Rows: null, empty and blank texts have no paragraph and no hit; repeated rows give repeated
results; rows without id are scanned like others. Without any document nothing is trained.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import batched, permutations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.common import id_text, map_rows, table

WINDOW, SAMPLE, FALSE_RATE, CONFIRMED = 64, 500, 0.001, 75
#: Variants of each template and windows without licence, at most, that the model is fitted on.
VARIANTS, OTHERS = 40, 3000
#: Windows of two notices that the model is fitted on, for every two families.
DOUBLES = 12
WORDS = re.compile(r"[^\W_]+")
#: Marks of comments that are letters; all others are no words anyway.
MARK = re.compile(r"\W*(?:rem|dnl|c)(?=\s|$)", re.IGNORECASE)
#: Public notices, by family. None is longer than half a window.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND",
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
        "The software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement",
        "In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise",
        "SPDX-License-Identifier: MIT",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3",
        "redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "without even the implied warranty of merchantability or fitness for a particular purpose. See the GNU General Public License for more details",
        "You should have received a copy of the GNU General Public License along with this program",
        "Licensed under the GPL, version 2 or later",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "licensed under the GNU Lesser General Public License, version 2.1",
        "redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "redistribute it and/or modify it under the terms of the GNU Library General Public License",
        "without even the implied warranty of merchantability or fitness for a particular purpose. See the GNU Lesser General Public License for more details",
        "You should have received a copy of the GNU Lesser General Public License along with this library",
        "SPDX-License-Identifier: LGPL-2.1",
    ),
    "agpl": (
        "licensed under the GNU Affero General Public License, version 3",
        "redistribute it and/or modify it under the terms of the GNU Affero General Public License",
        "without even the implied warranty of merchantability or fitness for a particular purpose. See the GNU Affero General Public License for more details",
        "You should have received a copy of the GNU Affero General Public License along with this program",
        "SPDX-License-Identifier: AGPL-3.0",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
        "This software is provided by the copyright holders and contributors as is and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness",
        "Licensed under the BSD 3-Clause License",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "If a copy of the MPL was not distributed with this file, You can obtain one at mozilla.org/MPL/2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "The software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
        "SPDX-License-Identifier: ISC",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0",
        "licensed under a Creative Commons Attribution 4.0 International License",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0",
        "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0",
        "Licensed under CC BY-NC-SA 4.0",
        "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    "cc0": (
        "dedicated to the public domain under CC0 1.0 Universal",
        "This is free and unencumbered software released into the public domain",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose",
    ),
    "proprietary": (
        "Copyright. All rights reserved",
        "(c) All rights reserved",
        "This software is proprietary and confidential. Unauthorized copying of this file is strictly prohibited",
    ),
}
FAMILIES = tuple(TEMPLATES)
#: Templates of fixed parts with free words between them, such as a year and a holder: all parts must occur.
PARTS = {"Copyright. All rights reserved": ("copyright", "all rights reserved"), "(c) All rights reserved": ("c", "all rights reserved")}
#: Words by which a family is told from others; a template that has them needs them.
KEYS = {
    "apache-2.0": ("apache",), "mit": ("mit",), "gpl": ("gnu general", "gpl"), "lgpl": ("gnu lesser", "gnu library", "lgpl"),
    "agpl": ("gnu affero", "agpl"), "bsd": ("bsd",), "mpl-2.0": ("mozilla public", "mpl"), "isc": ("isc",),
    "cc-by": ("by 4", "attribution 4"), "cc-by-sa": ("by sa", "attribution sharealike"),
    "cc-by-nc": ("by nc", "attribution noncommercial"), "cc0": ("cc0",),
}
#: Versions in SPDX expressions to train on, what stands at the head of one, and what may stand in it beside the names and numbers.
TAILS = ("", "", "2 0", "3 0 only", "2 0 only", "2 1 or later", "2 0 or later", "2 clause", "3 clause")
SPDX, SPDX_WORDS = ("spdx", "license", "identifier"), frozenset("or and with only later exception clause by sa nc nd cc".split())


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower().replace("©", " copyright "))


def paragraphs_of(text: str) -> Iterator[tuple[list[str], list[int]]]:
    """(words, line of each word) of every run of lines with words."""
    words: list[str] = []
    lines: list[int] = []
    for i, line in enumerate(text.split("\n")):
        mark = MARK.match(line)
        found = words_of(line[mark.end() :] if mark else line)
        if found:
            words += found
            lines += [i] * len(found)
        elif words:
            yield words, lines
            words, lines = [], []
    if words:
        yield words, lines


def span_of(words: list[str], template: str) -> tuple[int, int]:
    """First and last word of the stretch, a third longer than the template at most, that holds most of its word pairs."""
    if template in PARTS:  # the last part, and the place of the others nearest to it
        *others, end = ([i for i in range(len(words)) if holds(words[i : i + len(part)], part)] for part in parts_of(template))
        at = [end[0], end[0] + len(parts_of(template)[-1]) - 1] + [min(o, key=lambda i: abs(i - end[0])) for o in others]
        return min(at), max(at)
    text = words_of(template)
    own, reach = pairs_of(text), len(text) + len(text) // 3
    at = [i for i, pair in enumerate(zip(words, words[1:], strict=False)) if pair in own]
    within = [[j for j in at if i <= j < i + reach] for i in at]
    best = max(within, key=lambda js: (len({(words[j], words[j + 1]) for j in js}), js[0] - js[-1]))
    return best[0], best[-1] + 1


def pairs_of(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:], strict=False))


def holds(words: list[str], part: tuple[str, ...]) -> bool:
    return any(tuple(words[i : i + len(part)]) == part for i in range(len(words) - len(part) + 1))


def parts_of(template: str) -> list[tuple[str, ...]]:
    return [tuple(part.split()) for part in PARTS.get(template, ())]


class Template:
    """A template's words, word pairs, the keys it needs and, of an SPDX line, the name."""

    def __init__(self, family: str, text: str) -> None:
        self.family, self.text, words = family, text, words_of(text)
        self.pairs, self.parts = pairs_of(words), parts_of(text)
        self.keys = [k for k in (tuple(k.split()) for k in KEYS.get(family, ())) if holds(words, k)]
        self.name: tuple[str, ...] = ()
        if tuple(words[:3]) == SPDX:  # a version is part of the name if it is part of the family's
            self.name = tuple(words[3:] if family[-1].isdigit() else words[3:4])

    def share(self, words: list[str], found: set[tuple[str, str]], named: list[list[str]]) -> float:
        """Share of the template's word pairs that a window holds; 0 without a key of it."""
        if self.name and any(holds(n, self.name) for n in named):
            return 1.0
        if self.parts and all(holds(words, part) for part in self.parts):
            return 1.0
        share = len(self.pairs & found) / len(self.pairs)
        return share if 100 * share < 50 or all(holds(words, k) for k in self.keys) else 0.0


ALL = {family: [Template(family, t) for t in templates] for family, templates in TEMPLATES.items()}
NAMES = frozenset(w for ts in ALL.values() for t in ts for w in t.name)


def expressions(words: list[str]) -> list[list[str]]:
    """The words of each SPDX expression in a window."""
    out = []
    for i in range(len(words) - 3):
        if tuple(words[i : i + 3]) == SPDX:
            end = i + 3
            while end < len(words) and (words[end] in SPDX_WORDS or words[end] in NAMES or words[end][0].isdigit()):
                end += 1
            out.append(words[i + 3 : end])
    return out


def best_template(words: list[str], families: tuple[str, ...] = FAMILIES) -> tuple[float, str, str]:
    """(share of its word pairs found, family, template) of the template that the words hold most of; the longer of equals."""
    found, named = pairs_of(words), expressions(words)
    best = (0.0, 0, "", "")
    for family in families:
        for t in ALL[family]:
            best = max(best, (t.share(words, found, named), len(t.pairs), family, t.text))
    return best[0], best[2], best[3]


class Scanner:
    """The features, the model, and its calibration. Feature 0 is any other word or pair."""

    def __init__(self) -> None:
        texts = [words_of(t) for ts in TEMPLATES.values() for t in ts]
        self.ids = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}), 1)}
        size = len(self.ids) + 1
        self.pairs = np.zeros((size, size), np.int32)
        for a, b in sorted({p for t in texts for p in pairs_of(t)}):
            self.pairs[self.ids[a], self.ids[b]] = self.pairs.max() + 1
        self.size = size
        self.features = size + int(self.pairs.max()) + 1
        self.weights = np.zeros((self.features, len(FAMILIES)))
        self.bias = np.zeros(len(FAMILIES))
        self.least = 1.0

    def rows(self, windows: list[list[str]]) -> np.ndarray:
        """Feature counts, one row per window."""
        out = np.zeros((len(windows), self.features), np.float32)
        for row, words in zip(out, windows, strict=True):
            ids = np.array([self.ids.get(w, 0) for w in words], np.int64)
            np.add.at(row, ids, 1)
            np.add.at(row, self.size + self.pairs[ids[:-1], ids[1:]], 1)
        out[:, [0, self.size]] = 0
        return out

    def fit(self, rows: np.ndarray, labels: np.ndarray, steps: int = 250, penalty: float = 2e-4) -> None:
        """Accelerated proximal gradient on the mean logistic loss of every family; in each, its
        windows weigh as much as all others. ``labels``: windows by families, true or false."""
        target = labels.astype(np.float32)
        many = target.sum(axis=0)
        weight = np.where(labels, 0.5 / np.maximum(many, 1), 0.5 / np.maximum(len(labels) - many, 1)).astype(np.float32)
        now = np.zeros((rows.shape[1] + 1, target.shape[1]), np.float32)
        ahead, t = now, 1.0
        full = np.hstack([rows, np.ones((len(rows), 1), np.float32)])
        rate = 4 / float((weight * np.square(full).sum(axis=1, keepdims=True)).sum(axis=0).max())
        for _ in range(steps):
            p = _sigmoid(full @ ahead)
            new = ahead - rate * (full.T @ (weight * (p - target)))
            new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * penalty, 0)
            after = (1 + (1 + 4 * t * t) ** 0.5) / 2
            ahead, now, t = new + (t - 1) / after * (new - now), new, after
        self.weights, self.bias = now[:-1].astype(np.float64), now[-1].astype(np.float64)

    def calibrate(self, rows: np.ndarray, labels: np.ndarray, corpus: np.ndarray) -> None:
        """``corpus``: which rows are windows of the corpus."""
        z = rows @ self.weights + self.bias

        def likelihood(heat: float) -> float:
            return -float(np.logaddexp(0, np.where(labels, -z, z) / heat).mean())

        heat = max(np.geomspace(0.1, 4, 40), key=likelihood)
        self.weights, self.bias = self.weights / heat, self.bias / heat
        none = _sigmoid(z[corpus] / heat).max(axis=1)
        self.least = float(max(0.5, np.quantile(none, 1 - FALSE_RATE))) if len(none) else 0.5

    def scan(self, paragraphs: list[list[str]]) -> list[tuple[int, int, int, str, float, float, str]]:
        """(paragraph, first and last word of the notice, family, probability, template share, template) of confirmed windows."""
        half, get = WINDOW // 2, self.ids.get
        ids = np.array([get(w, 0) for p in paragraphs for w in p], np.int64)
        sizes = np.array([len(p) for p in paragraphs], np.int64)
        ends = np.cumsum(sizes)
        many = np.maximum(1, -(-(sizes - half) // half)) * (sizes > 0)  # windows of each paragraph
        owner = np.repeat(np.arange(len(sizes)), many)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
        start = (ends - sizes)[owner] + nth * half
        stop = np.minimum(start + WINDOW, ends[owner])
        known = np.flatnonzero(ids)
        after = known[np.isin(known + 1, known)] + 1  # second words of pairs
        pair = self.pairs[ids[after - 1], ids[after]]
        after, pair = after[pair > 0], pair[pair > 0]
        # sums over a window as differences of running sums over its known words and pairs
        single = np.vstack([np.zeros(len(self.bias)), np.cumsum(self.weights[ids[known]], axis=0)])
        double = np.vstack([np.zeros(len(self.bias)), np.cumsum(self.weights[self.size + pair], axis=0)])
        z = single[np.searchsorted(known, stop)] - single[np.searchsorted(known, start)] + self.bias
        z += double[np.searchsorted(after, stop)] - double[np.minimum(np.searchsorted(after, start + 1), np.searchsorted(after, stop))]
        p = _sigmoid(z)
        out = []
        for w in np.flatnonzero(p.max(axis=1) >= self.least) if len(p) else ():
            at = int(start[w] - (ends - sizes)[owner[w]])
            words = paragraphs[owner[w]][at : at + int(stop[w] - start[w])]
            for k, family in enumerate(FAMILIES):
                share, _, template = best_template(words, (family,))
                if 100 * share >= CONFIRMED:
                    first, last = span_of(words, template)
                    out.append((int(owner[w]), at + first, at + last, family, float(p[w, k]), share, template))
        return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def windows_of(words: list[str]) -> list[list[str]]:
    half = WINDOW // 2
    return [words[i : i + WINDOW] for i in range(0, max(1, len(words) - half), half)] if words else []


def examples(others: list[list[str]], seed: int = 5) -> tuple[list[list[str]], np.ndarray, int]:
    """Windows, which families each holds, and how many of the first are from ``others``, corpus windows."""
    rng = np.random.default_rng(seed)
    others = [w for w in others if best_template(w)[0] < 0.5]
    others = [others[i] for i in rng.permutation(len(others))[:OTHERS]] or [["text"]]
    windows, labels = [list(w) for w in others], [()] * len(others)

    def around(words: list[str]) -> list[str]:
        text = others[rng.integers(len(others))][: int(rng.integers(0, WINDOW - len(words) + 1))]
        cut = int(rng.integers(0, len(text) + 1))
        return text[:cut] + words + text[cut:]

    for family in FAMILIES:
        for template in TEMPLATES[family]:
            words = words_of(template)
            for v in range(VARIANTS):
                kept = [w for w in words if v % 2 == 0 or rng.random() > 0.08]
                if template in PARTS:  # free words between the parts
                    first, *rest = parts_of(template)
                    kept = list(first)
                    for part in rest:
                        kept += others[rng.integers(len(others))][: int(rng.integers(0, 13))] + list(part)
                windows.append(around(kept))
                labels.append((family,))
                if v % 2:  # a loose piece, its words in any order
                    piece = [words[i] for i in rng.permutation(len(words))[: max(1, len(words) // 3)]]
                    windows.append(around(piece))
                    labels.append(())
    for pair in permutations(FAMILIES, 2):
        one, two = (ALL[family] for family in pair)
        for v in range(DOUBLES // 2):
            a, b = (ts[rng.integers(len(ts))] for ts in (one, two))
            names = [next((t for t in ts if t.name), None) for ts in (one, two)]
            joined = words_of(a.text) + ["or"] * (v % 2) + words_of(b.text)
            if v % 2 == 0 and all(names):  # one SPDX expression, of any versions
                c, d = ([*t.name, *TAILS[rng.integers(len(TAILS))].split()] for t in names)
                joined = [*SPDX, *c, "or", *d]
            if len(joined) <= WINDOW:
                windows.append(around(joined))
                labels.append(pair)
    return windows, np.array([[f in own for f in FAMILIES] for own in labels]), len(others)


def trained(docs: DataFrame) -> Scanner:
    """A scanner for these (doc_id, text) rows."""
    sample = docs.orderBy(F.xxhash64("doc_id"), "doc_id").select("doc_id").limit(SAMPLE).distinct()

    def rows(source: Iterator[dict]) -> Iterator[tuple]:
        for r in source:
            found = [w for words, _ in paragraphs_of(r["text"]) for w in windows_of(words)]
            step = max(1, len(found) // 20)
            for w in found[::step]:  # evenly over the whole text, so that one long text is not the sample
                yield (w,)

    windows = map_rows(docs.join(F.broadcast(sample), "doc_id", "left_semi"), rows, "words array<string>").toArrow()
    found = sorted(windows.column("words").to_pylist())
    texts, labels, corpus = examples(found)
    scanner = Scanner()
    features = scanner.rows(texts)
    aside = np.arange(len(texts)) % 4 == 3
    scanner.fit(features[~aside], labels[~aside])
    scanner.calibrate(features[aside], labels[aside], np.arange(len(texts))[aside] < corpus)
    return scanner


def scanned(docs: DataFrame, scanner: Scanner, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, paragraphs, hits) per row; hits are (paragraph, word, line, last_line, family,
    probability, share, template): the paragraph by its first line, the notice by its first word there and its lines."""
    named = id_text(docs, id_col, text_col)
    shipped = docs.sparkSession.sparkContext.broadcast(scanner)

    def rows(source: Iterator[dict]) -> Iterator[tuple]:
        use = shipped.value
        for part in batched(source, 128):
            found = [(d, words, lines) for d, r in enumerate(part) for words, lines in paragraphs_of(r["text"])]
            hits: list[list[dict]] = [[] for _ in part]
            for at, word, last, family, p, share, template in use.scan([words for _, words, _ in found]) if found else []:
                d, _, lines = found[at]
                hits[d].append({
                    "paragraph": lines[0], "word": word, "line": lines[word], "last_line": lines[last],
                    "family": family, "probability": p, "share": share, "template": template,
                })
            counts = np.bincount([d for d, _, _ in found], minlength=len(part)).tolist()
            for r, n, of_row in zip(part, counts, hits, strict=True):
                yield r["doc_id"], n, of_row

    key = named.schema["doc_id"].dataType.simpleString()
    hit = "struct<paragraph:int,word:int,line:int,last_line:int,family:string,probability:double,share:double,template:string>"
    return map_rows(named, rows, f"doc_id {key}, paragraphs long, hits array<{hit}>")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = scanned(docs, trained(id_text(docs)))
    return found.select(
        "doc_id", F.col("paragraphs").alias("n_paragraphs"),
        F.size(F.array_distinct("hits.paragraph")).cast("bigint").alias("n_licensed"),
        F.array_join(F.sort_array(F.array_distinct("hits.family")), ",").alias("families"),
        F.array_max("hits.probability").alias("probability"),
    )
