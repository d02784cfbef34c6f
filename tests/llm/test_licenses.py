"""Licence scan against licence files and headers as projects carry them; none
is a copy of a template."""

from __future__ import annotations

import math
import re
from collections import Counter
from pathlib import Path

import pytest

from vigil.llm import licenses, queries

SAMPLES = Path(__file__).parent / "license_samples"
GPL2 = """/*
 * frob.c - frobnicates the input
 * Copyright (C) 2019-2021  Jane Roe <jane@example.org>
 *
 * This file is part of Frob.
 *
 * Frob is free software; you can redistribute it and/or modify it under
 * the terms of the GNU General Public License as published by the Free
 * Software Foundation; either version 2 of the License, or (at your
 * option) any later version.
 */
#include <stdio.h>
"""
AGPL = """<html><body><p>Copyright 2020 Jane Roe</p>
<p>This server is free software: you can redistribute it and/or modify it under
the terms of the GNU Affero General Public License as published by the Free
Software Foundation, version 3 of the License.</p></body></html>"""
LGPL = """# Copyright (C) 2008 J. Roe
#
# This module is free software; you can redistribute it and/or
# modify it under the terms of the GNU Lesser General Public
# License as published by the Free Software Foundation; either
# version 2.1 of the License, or (at your option) any later version.

import os
"""
MIT_CODE = '"""\n' + "Copyright (c) 2011 J. Roe\n\n" + "{}" + '\n"""\nimport os\n\n\ndef run():\n    return os.name\n'
CASES = [
    ("MIT", "// SPDX-License-Identifier: MIT\nint main() {}"),
    ("Apache-2.0", "#!/usr/bin/env python\n# SPDX-License-Identifier: Apache-2.0\nimport os"),
    ("GPL-3.0", "/* SPDX-License-Identifier: GPL-3.0+ */"),
    (None, "/* SPDX-License-Identifier: Zlib */"),
    ("GPL-2.0", GPL2), ("AGPL-3.0", AGPL), ("LGPL-2.1", LGPL),
    ("AGPL-3.0", "        GNU AFFERO GENERAL PUBLIC LICENSE\n           Version 3, 19 November 2007\n\n Everyone may copy this document."),
    ("CC-BY-NC-4.0", "Attribution-NonCommercial 4.0 International\n\nCreative Commons Attribution-NonCommercial 4.0 International Public\nLicense\n\nBy exercising"),
    (None, "Copyright (c) MIT"), (None, "Copyright 2024 Example Corp. All rights reserved."), (None, "Released under the Zlib License."),
]


def scan(spark, texts):
    df = spark.createDataFrame([(i, None, t) for i, t in enumerate(texts)], "id long, path string, text string")
    return [r.license for r in sorted(licenses.scan(df).collect(), key=lambda r: r.id)]


def test_headers_tags_and_titles(spark):
    assert scan(spark, [t for _, t in CASES]) == [x for x, _ in CASES]


def test_whole_licence_files(spark):
    names = ["BSD-3-Clause", "ISC", "MIT"]
    texts = [(SAMPLES / f"{n}.txt").read_text(encoding="utf-8") for n in names]
    assert not {t for _, t in licenses.templates()} & set(texts)
    assert scan(spark, texts + [MIT_CODE.format(texts[2])]) == names + ["MIT"]


@pytest.mark.parametrize("name", ["GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "CC-BY-SA-4.0", "MPL-2.0"])
def test_licence_texts_are_told_apart(spark, name):
    text = (licenses.TEXTS / f"{name}.txt").read_text(encoding="utf-8")
    assert scan(spark, [text.replace("\n", "\r\n") + "\r\nCopyright 2020 J. Roe\r\n"]) == [name]


def test_query_scans_pages_and_documents(spark, tmp_path):
    pages = [(1, "http://h/", "<p>Licensed under the Apache License, Version 2.0.</p>"), (2, "http://h/a", "<p>none</p>")]
    docs = [(1, "prose\n\nLicensed under CC BY-NC 4.0.\n\nmore prose"), (2, "prose"), (3, None), (3, None)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.table, r.id, r.path, r.license, r.origin) for r in queries.op3_license_scan(spark, str(tmp_path)).collect()
                 if r.table == "pages" or r.license)
    assert got == [("documents", 1, None, "CC-BY-NC-4.0", "own"), ("pages", 1, "h/", "Apache-2.0", "own"), ("pages", 2, "h/a", "Apache-2.0", "inherited")]
    assert queries.op3_license_scan(spark, str(tmp_path)).filter("origin = 'none'").count() == 3


def plain_best(line):
    """(license, cosine) of a statement: TF-IDF over the templates, term by term"""
    words = lambda t: Counter(re.sub(r"(?:(?![.-])[\W_])+|[.-]+(?=\s|$)", " ", t.lower()).split())
    held = [(name, words(re.sub(licenses.TAG, " ", text))) for name, text in licenses.templates()]
    df = Counter(w for _, c in held for w in c)
    idf = lambda w: math.log((len(held) + 1) / (df[w] + 1)) + 1
    weigh = lambda c: {w: (1 + math.log(n)) * idf(w) for w, n in c.items()}
    mine = weigh(words(line))
    size = lambda v: math.sqrt(sum(x * x for x in v.values()))
    best = (0.0, "")
    for name, c in held:
        needed = next((t for t in licenses.NEEDED if t in c), None)
        v = weigh(c)
        if set(mine) & set(v) and (needed is None or needed in mine):
            best = min(best, (-round(sum(mine[w] * v[w] for w in mine if w in v) / size(mine) / size(v), 9), name))
    return (best[1], -best[0]) if -best[0] >= licenses.MIN_COSINE else (None, None)


LINES = ["Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.", "MIT License",
         "This work is licensed under the GNU General Public License, version 3.", "Released under the ISC License", "Copyright of nobody",
         "SPDX-License-Identifier: LGPL-2.1-only", "licensed to drive", "public domain", "GNU Lesser General Public License version 3 license license"]


def test_cosine_equals_a_plain_one(spark):
    df = spark.createDataFrame([(i, None, t) for i, t in enumerate(LINES)], "id long, path string, text string")
    got = {r.id: (r.license, r.cosine and round(r.cosine, 6)) for r in licenses.scan(df).collect()}
    want = {i: plain_best(t) for i, t in enumerate(LINES)}
    assert got == {i: (name, c and round(c, 6)) for i, (name, c) in want.items()}
    assert [got[i][0] for i in range(6)] == ["MIT", "Apache-2.0", "CC-BY-NC-4.0", "MIT", "GPL-3.0", "ISC"]
    assert all(0.6 <= got[i][1] < 1 for i in (0, 1, 2, 4))        # found by likeness, not because a template repeats them


def test_directories_hand_their_licence_down(spark):
    files = [(1, "x.org/a/LICENSE", "MIT License"), (2, "x.org/a/b/c.html", "no word of it"), (3, "x.org/a/b/LICENSE.txt", "Apache License Version 2.0, January 2004"),
             (4, "x.org/z/d.html", ""), (5, "x.org/a/e.html", None), (6, "x.org/a/b/c/d/f", "ISC License"), (7, None, "plain")]
    got = {r.id: (r.license, r.origin, r.inherited_from) for r in licenses.scan(spark.createDataFrame(files, "id long, path string, text string")).collect()}
    assert got == {1: ("MIT", "own", None), 2: ("Apache-2.0", "inherited", "x.org/a/b/"), 3: ("Apache-2.0", "own", None), 4: (None, "none", None),
                   5: ("MIT", "inherited", "x.org/a/"), 6: ("ISC", "own", None), 7: (None, "none", None)}
