"""Quality scores, license scans, URL rules."""

import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm import licenses, quality, url_filter
from mercato.llm.common import id_text, table
from tests.llm.conftest import ODD_TEXTS, SF


def test_quality_on_held_out_rows(llm, duck):
    got = {r["doc_id"]: r for r in quality.query(llm, SF).collect()}
    labels = duck.execute("SELECT doc_id, quality FROM labels").fetchall()
    held = [(i, q) for i, q in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i]["held_out"] for i, _ in held) and len(held) > 10
    assert sum(got[i]["predicted"] == q for i, q in held) >= 0.95 * len(held)
    assert all(r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in got.values())


def test_held_out_labels_are_not_read(llm):
    docs, labels = table(llm, SF, "documents"), table(llm, SF, "labels")
    wrong = labels.withColumn("quality", F.when(quality.trained_here(), F.col("quality")).otherwise(1 - F.col("quality")))
    a, b = (quality.train(docs, x, "quality", quality.trained_here()) for x in (labels, wrong))
    assert np.array_equal(a.weights, b.weights) and (a.slope, a.offset) == (b.slope, b.offset)


def test_quality_on_odd_rows(llm, odd, none):
    labels = llm.createDataFrame([(1, 1), (1, 0), (1, 1), (5, 0), (None, 1), (9, None), (99, 0), (11, 1)], "doc_id long, quality int")
    model = quality.train(odd, labels, "quality", F.lit(True))
    scores = id_text(odd).select("doc_id", quality.scorer(llm, model)("text").alias("s")).collect()
    assert len(scores) == len(ODD_TEXTS) and all(0 <= r["s"] <= 1 for r in scores)
    blank = {r["s"] for r in scores if r["doc_id"] in (2, 3, 4)}
    assert len(blank) == 1
    for kept, score in ((labels.where("false"), 1), (labels.where("quality = 1"), 1), (labels.where("quality = 0 AND doc_id = 5"), 0)):
        one = quality.train(odd, kept, "quality", F.lit(True))
        assert round(one.scores([np.array([3])])[0]) == score
    assert none.select(quality.scorer(llm, model)("text")).count() == 0


def test_descent_separates_classes():
    rng = np.random.default_rng(3)
    rows = [np.unique(np.concatenate([rng.integers(100, 5000, 30), [1, 2] if k % 4 else [3, 4]])) for k in range(400)]
    good = np.array([bool(k % 4) for k in range(400)])
    model = quality.fit(rows, good)
    assert ((model.scores(rows) >= 0.5) == good).mean() > 0.99


def test_repeats_are_a_feature():
    features = quality.Features()
    a, b = features.of("it it it it"), features.of("it is it was")
    assert len(np.setdiff1d(a, b)) > 2
    assert len(features.of(None)) == len(features.of(" \n")) == 0


def test_license_scan(llm, odd, none):
    scanner = licenses.trained(id_text(table(llm, SF, "documents")))
    rng = random.Random(1)
    filler = [f"word{rng.randrange(300)}" for _ in range(400)]
    texts, want = [], {}
    for k, (family, templates) in enumerate(licenses.TEMPLATES.items()):
        for n, template in enumerate(templates):
            i = 10 * k + n
            cut = rng.randrange(300)
            texts.append((i, " ".join(filler[:cut]) + " " + template + ". " + " ".join(filler[cut:])))
            want[i] = family
    texts += [(1000, "the license plate of version 2 of the car"), (1001, "under the general public all rights of way"), (1002, " ".join(filler))]
    found = licenses.scanned(llm.createDataFrame(texts, "doc_id long, text string"), scanner).collect()
    got = {r["doc_id"]: {h["family"] for h in r["hits"]} for r in found}
    assert sum(got[i] == {f} for i, f in want.items()) >= 0.9 * len(want)
    assert not got[1000] and not got[1001] and not got[1002]
    odd_hits = [(r["doc_id"], [h["family"] for h in r["hits"]]) for r in licenses.scanned(odd, scanner).collect()]
    assert sorted(i for i, h in odd_hits if h) == [14, 14] and all(h in ([], ["mit"]) for _, h in odd_hits)
    assert licenses.scanned(none, scanner).count() == 0
    assert licenses.trained(id_text(none)).least <= 1


MIT = """/*
 * Permission is hereby granted, free of charge, to any person obtaining
 * a copy of this software and associated documentation files (the
 * "Software"), to deal in the Software without restriction, including
 */"""
BSD = """# Redistribution and use in source and binary
# forms, with or without modification, are
# permitted provided that the following
# conditions are met:"""
ISC = """// Permission to use, copy, modify, and/or
// distribute this software for any purpose
// with or without fee is hereby granted,
// provided that the above copyright notice"""
GPL = """dnl This program is free software; you can redistribute it
dnl and/or modify it under the terms of the GNU General
dnl Public License as published by the Free Software
dnl Foundation; either version 2"""
LGPL = """REM This library is free software; you can
REM redistribute it and/or modify it under the
REM terms of the GNU Lesser General Public
REM License as published by the Free"""


def test_wrapped_notices(llm):
    scanner = licenses.trained(id_text(table(llm, SF, "documents")))
    wrapped = {"mit": MIT, "bsd": BSD, "isc": ISC, "gpl": GPL, "lgpl": LGPL}
    code = "import os\n\n{}\n\nint main ( ) { return 0 ; }\nnothing else"
    texts = [(k, code.replace("{}", text, 1)) for k, text in enumerate(wrapped.values())]
    got = {r["doc_id"]: r for r in licenses.scanned(llm.createDataFrame(texts, "doc_id long, text string"), scanner).collect()}
    for k, family in enumerate(wrapped):
        assert {h["family"] for h in got[k]["hits"]} == {family}
        assert got[k]["paragraphs"] == 3
        for h in got[k]["hits"]:
            assert 2 <= h["paragraph"] <= h["line"] < h["last_line"] <= 6
    ends = [(h["line"], h["last_line"]) for k in (0, 1, 2) for h in got[k]["hits"]]
    assert ends == [(3, 4), (2, 5), (2, 4)]
    assert [len(w) for w, _ in licenses.paragraphs_of("a b\n//\nc d\n# e f\r\n\n\ng")] == [2, 3, 1]


def test_lines_of_two_licenses(llm):
    scanner = licenses.trained(id_text(table(llm, SF, "documents")))
    lines = {
        "Licensed under the MIT License or the Apache License, Version 2.0": {"mit", "apache-2.0"},
        "// SPDX-License-Identifier: Apache-2.0 OR MIT": {"mit", "apache-2.0"},
        "# SPDX-License-Identifier: (GPL-2.0-only OR BSD-2-Clause)": {"gpl", "bsd"},
        "SPDX-License-Identifier: LGPL-2.1-or-later": {"lgpl"},
        "terms of the GNU Affero General Public License as published by the Free Software Foundation; licensed under the GNU Affero General Public License, version 3": {"agpl"},
        "Licensed under CC BY-SA 4.0": {"cc-by-sa"},
    }
    for (a, one), (b, two) in itertools.permutations(licenses.TEMPLATES.items(), 2):
        lines[f"{one[0]} or {two[0]}"] = {a, b}
    texts = list(enumerate(lines))
    found = licenses.scanned(llm.createDataFrame(texts, "doc_id long, text string"), scanner).collect()
    got = {texts[r["doc_id"]][1]: {h["family"] for h in r["hits"]} for r in found}
    assert {k: (v, got[k]) for k, v in lines.items() if got[k] != v} == {}


WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""


def test_holders_and_later_clauses(llm):
    scanner = licenses.trained(id_text(table(llm, SF, "documents")))
    filler = " ".join(f"word{i}" for i in range(45))
    texts = {
        "Copyright (c) 2024 Example Inc. All rights reserved.": "proprietary",
        "filler\n\n// \u00a9 2019-2024, The Example Company GmbH & Co. KG.\n// All rights reserved.": "proprietary",
        "(C) Example 2020, all rights reserved": "proprietary",
        WARRANTY: "mit",
        f"{filler}\n{WARRANTY}\n{filler}": "mit",
        "Redistributions of source code must retain the above copyright notice, this list of\nconditions and the following disclaimer.": "bsd",
        "You should have received a copy of the GNU Lesser General Public\nLicense along with this library": "lgpl",
        "all rights to the copy are reserved": "", "the copyright of all songs": "",
    }
    rows = list(enumerate(texts))
    found = licenses.scanned(llm.createDataFrame(rows, "doc_id long, text string"), scanner).collect()
    got = {rows[r["doc_id"]][1]: ",".join({h["family"] for h in r["hits"]}) for r in found}
    assert got == texts
    assert [(h["line"], h["last_line"]) for r in found if r["doc_id"] == 1 for h in r["hits"]][0] == (2, 3)
    assert max(len(licenses.words_of(t)) for ts in licenses.TEMPLATES.values() for t in ts) <= licenses.WINDOW // 2


def test_licenses_of_the_given_documents(llm, given):
    lines = {
        "Licensed under CC BY-NC 4.0.": "cc-by-nc", "Released under the MIT License.": "mit",
        "This work is licensed under the GNU General Public License, version 3.": "gpl",
        "Licensed under the Apache License, Version 2.0.": "apache-2.0",
    }
    got = {r["doc_id"]: r["families"] for r in licenses.query(llm, SF).collect()}
    assert got == {i: ",".join(sorted({f for s, f in lines.items() if s in t})) for i, t in given.items()}


def expression(glob):
    parts = re.findall(r"\[.\]|\*+|\?|[^*?\[]", glob, re.S)
    return "".join("[^/]" if p == "?" else "[^/]*" if p == "*" else "(?s:.*)" if p[0] == "*" else re.escape(p[1] if p[0] == "[" and len(p) == 3 else p) for p in parts)


def test_automaton_equals_regular_expressions():
    rng = random.Random(8)
    globs = ["".join(rng.choice(["a", "b", "/", "*", "**", "?", "ab"]) for _ in range(rng.randrange(1, 9))) for _ in range(120)]
    rules = tuple(url_filter.Rule.glob("block", g) for g in globs)
    machine = url_filter.Automaton(rules)
    urls = ["".join(rng.choice("ab/") for _ in range(rng.randrange(12))) for _ in range(400)] + ["", "a" * 5000]
    for url, best in zip(urls, machine.best([u.encode() for u in urls]), strict=True):
        fits = [k for k, r in enumerate(machine.rules) if re.fullmatch(expression(r.name), url)]
        assert best == (min(fits) if fits else -1), url


URLS = [
    ("http://A.Example.COM/en/1?x#y", "a.example.com", "/en/1", "example.com/en/", "block"),
    ("http://www.example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    ("http://com", "com", "", None, "allow"),
    ("http://x.net/es/", "x.net", "/es/", "net/es/", "block"),
    ("http://x.org/a.com/", "x.org", "/a.com/", None, "allow"),
    ("http://ads.org/a.com/", "ads.org", "/a.com/", None, "block"),
    ("http://x.org?http://y.com/en/", "x.org", "", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
    ("://casino\n.com/ü", "casino\n.com", "/ü", "com/", "allow"),
    ("http://x.org/" + "é" * 30_000 + "casino", "x.org", "/" + "é" * 30_000 + "casino", None, "block"),
]


@pytest.mark.parametrize("copies", [1, 3])
def test_urls(llm, copies):
    rows = [(i, u, "x", "x") for i, (u, *_) in enumerate(URLS)] * copies
    pages = llm.createDataFrame(rows, "page_id long, url string, host string, __best string")
    got = url_filter.judge(pages, url_filter.HOST_RULES + url_filter.GLOB_RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == URLS[r["page_id"]][1:]
    assert url_filter.judge(pages.where("false"), url_filter.HOST_RULES).count() == 0
