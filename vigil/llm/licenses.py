"""Licence scan: sparse TF-IDF cosine to templates, then inheritance.

Every part of a file that speaks of a licence is a statement: each line (or
mark-up segment), each paragraph and the leading comment with their comment
marks taken off, and the whole text.  Distinct statements, many files share
one, are compared with the templates (notices, headers, SPDX tags, titles and
whole licence texts) by the cosine of sparse TF-IDF vectors: a join on terms,
dot products as grouped sums.  A file's own licence is that of its best
statement at or above ``MIN_COSINE``.

A file without one inherits from the nearest ancestor directory that has a
licence file (LICENSE, COPYING, ... or the directory's index page), by joins
of paths: each file is joined with all its ancestor directories.

Document frequencies are counted over the templates, so that a file's licence
does not hang on the other files; a term counts 1 + ln of its repeats.  Only
DataFrame functions.

Defined results: null and empty texts state nothing and may inherit; a null or
empty path has no ancestors; of several licences equally good the first by
name holds; of several licence files in a directory the best cosine, then the
first name; repeated rows are judged one by one; no rows give no rows; other
columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.storage import Scratch
from vigil.operators.common import bounded_broadcast

MIN_COSINE = 0.6
# one-sentence notices, as the licences' publishers and hosts word them
NOTICES = (
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "The Apache Software Foundation licenses this file to you under the Apache License, Version 2.0"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause Simplified License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause New or Revised License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License, CC BY 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License, CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under the CC0 1.0 Universal License."),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This program is licensed under the GNU General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain, The Unlicense."),
)
#: Whole licence texts as published, a file each.
TEXTS = Path(__file__).parent / "license_texts"
TITLES = (
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("ISC", "ISC License"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("MIT", "MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
)
# headers of source files; the GNU ones differ in name, version and address
GNU = (("AGPL-3.0", "Affero General", "3"), ("GPL-2.0", "General", "2"), ("GPL-3.0", "General", "3"),
       ("LGPL-2.1", "Lesser General", "2.1"), ("LGPL-3.0", "Lesser General", "3"))
GRANTS = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} Public License as "
    "published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version.",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {0} Public License "
    "version {1} as published by the Free Software Foundation.",
)
NO_WARRANTY = (" This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
               "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} Public License for more details.")
WHERE = (
    " You should have received a copy of the GNU {0} Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    " You should have received a copy of the GNU {0} Public License along with this program; if not, write to the Free Software "
    "Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.",
)
APACHE = ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
          "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0")
HEADERS = (
    ("Apache-2.0", APACHE),
    ("Apache-2.0", APACHE + " Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
     "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
     "language governing permissions and limitations under the License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
     "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
     "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
     "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
     "subject to the following conditions:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
     "that the above copyright notice and this permission notice appear in all copies."),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this "
     "software to the public domain worldwide. This software is distributed without any warranty."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
) + tuple((license, text.format(name, version)) for license, name, version in GNU
          for grant in GRANTS for text in (grant, *(grant + NO_WARRANTY + where for where in WHERE)))
# SPDX tags: the GNU licences also as -only, -or-later and +
TAGS = tuple((license, f"SPDX-License-Identifier: {license}{end}") for license in
             ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "ISC", "MIT", "MPL-2.0", "Unlicense",
              *(license for license, _, _ in GNU)) for end in (("", "-only", "-or-later") if "GPL" in license else ("",)))
#: Terms without which a short template says nothing: 'Copyright MIT' is none.
NEEDED = ("spdx-license-identifier", "license", "licence", "licensed", "domain")
CUE = r"(?i)(licen[sc]|public domain|copyright|SPDX)"
LICENSE_FILE = r"(?i)(^|/)((un)?licen[sc]es?|copying|copyright|notice|legal|index)([._-][^/]*)?$|/$"
TAG = r"</?[A-Za-z][A-Za-z0-9-]*+(?:\s[^<>]*+|/)?>"
BLOCK_TAG = r"(?i)</?(?:p|div|h[1-6]|li|ul|ol|td|tr|table|section|article|aside|footer|header|main|nav|pre|body|html|head|title|script|style)(?:\s[^<>]*+|/)?>"
MARKS = r"(?m)^[ \t]*(?:/\*+|\*+/|\*+|//+!?|#+!?|--+|;+|%+|\(\*+|\{-|<!--|\"{3}|'{3}|dnl\b|(?i:rem)\b)?[ \t]*"
BLOCK_COMMENT = r"(?s)\A\s*(?:(?:#!|<\?)[^\n]*\n\s*)?(?:/\*|<!--|\"{3}|'{3}|\(\*|\{-)(.*?)(?:\*/|-->|\"{3}|'{3}|\*\)|-\})"
COMMENT_LINE = r"^\s*(?:$|//|#|--|;|%|\*|dnl\b|(?i:rem)\b)"


def url_path(url: Column) -> Column:
    """Host and path of a url as a file path; without ``://``: null."""
    return F.nullif(F.regexp_extract(url, r"(?s)^.*?://([^?#]*)", 1), F.lit(""))


def _terms(text: Column) -> Column:
    # words, numbers and versions; a word keeps inner dots and dashes only
    return F.filter(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}.-]+|[.-]+(?=\s|$)", " "), r"\s+"), lambda x: x != "")


def statements(text: Column) -> Column:
    """Lines and mark-up segments, paragraphs, the leading comment and the
    whole of a text, as far as they speak of a licence."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    lines = F.split(text, r"[<>\n\r]+")
    ends = F.regexp_replace(text, r"\r\n?", "\n")
    # mark-up: blocks end a paragraph, other tags only a word
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(ends, BLOCK_TAG, "\n\n"), TAG, " "), MARKS, "")
    rows = F.split(ends, "\n")
    code = F.array_position(F.transform(rows, lambda x: ~x.rlike(COMMENT_LINE)), True)
    leading = F.array(F.regexp_extract(ends, BLOCK_COMMENT, 1), F.array_join(F.slice(rows, 1, F.greatest(code - 1, F.lit(0)).cast("int")), "\n"))
    leading = F.transform(leading, lambda x: F.regexp_replace(x, MARKS, ""))
    parts = F.concat(lines, F.split(plain, r"\n[ \t]*\n\s*"), leading, F.array(plain))
    cued = F.array_distinct(F.filter(F.transform(parts, F.trim), lambda x: x.rlike(CUE)))
    return F.when(text.rlike(CUE), cued).otherwise(F.array().cast("array<string>"))


def _template_terms(text: str) -> Counter:
    # as _terms
    text = re.sub(TAG, " ", text)
    return Counter(re.sub(r"(?:(?![.-])[\W_])+|[.-]+(?=\s|$)", " ", text.lower()).split())


def templates() -> list[tuple[str, str]]:
    """(license, text) of every template."""
    texts = tuple((p.stem, p.read_text(encoding="utf-8")) for p in sorted(TEXTS.glob("*.txt")))
    return list(NOTICES + TITLES + HEADERS + TAGS + texts)


def _template_vectors() -> tuple[list, float]:
    """Rows (term, idf, entries (template, license, needed term, weight of the
    unit vector)) and the idf of a term that no template has."""
    known = [(license, _template_terms(text)) for license, text in templates()]
    df = Counter(term for _, terms in known for term in terms)
    idf = {term: math.log((len(known) + 1) / (n + 1)) + 1 for term, n in df.items()}
    entries: dict[str, list] = {term: [] for term in df}
    for i, (license, terms) in enumerate(known):
        weights = {term: (1 + math.log(n)) * idf[term] for term, n in sorted(terms.items())}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        needed = next((t for t in NEEDED if t in terms), None)
        for term, w in weights.items():
            entries[term].append((i, license, needed is None, term == needed, w / norm))
    return [(term, idf[term], entries[term]) for term in sorted(df)], math.log(len(known) + 1) + 1


def match_statements(spark: SparkSession, found: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """(key, license, cosine) of the distinct rows (key, statement) that reach
    it.  Rows are dealt by statement once; all sums of a statement stay there."""
    rows, unknown = _template_vectors()
    known = F.broadcast(spark.createDataFrame(rows, "term string, idf double, entries array<struct<template int, license string, free boolean, needed boolean, weight double>>"))
    counted = (found.groupBy("key").agg(F.first("statement").alias("statement"))
               .select("key", F.explode(_terms(F.col("statement"))).alias("term")).groupBy("key", "term").agg(F.count(F.lit(1)).alias("tf")))
    w = (1 + F.log(F.col("tf"))) * F.coalesce("idf", F.lit(unknown))
    sums = counted.join(known, "term", "left").withColumn("w", w)
    # template -1 sums the statement's own squares
    itself = F.array(F.struct(F.lit(-1).alias("template"), F.lit("").alias("license"), F.lit(True).alias("free"), F.lit(True).alias("needed"), F.col("w").alias("weight")))
    each = sums.select("key", "w", F.explode(F.concat(itself, F.coalesce("entries", F.array().cast(known.schema["entries"].dataType)))).alias("e"))
    dots = (each.groupBy("key", "e.template", "e.license").agg(F.sum(F.col("w") * F.col("e.weight")).alias("dot"), F.max(F.col("e.free") | F.col("e.needed")).alias("counts")))
    of = F.collect_list(F.when((F.col("template") >= 0) & F.col("counts"), F.struct("license", "dot")))
    per = dots.groupBy("key").agg(F.sqrt(F.max(F.when(F.col("template") == -1, F.col("dot")))).alias("norm"), of.alias("of"))
    # of a statement only the best counts: least (-cosine, license)
    best = F.array_min(F.transform("of", lambda t: F.struct((-F.round(t["dot"] / F.col("norm"), 9)).alias("c"), t["license"].alias("license"))))
    return per.select("key", best.alias("b")).select("key", "b.license", (-F.col("b.c")).alias("cosine")).filter(F.col("cosine") >= min_cosine)


def _folder(path: Column) -> Column:
    return F.regexp_replace(path, "[^/]*$", "")


def scan(files: DataFrame, id_col: str = "id", path_col: str = "path", text_col: str = "text", min_cosine: float = MIN_COSINE) -> DataFrame:
    """(id, path, license, cosine, origin, inherited_from) for every file;
    origin: ``own``, ``inherited`` or ``none``."""
    spark = files.sparkSession
    run = Scratch(spark, "licenses")
    found = run.keep(files.select(F.col(id_col).alias("id"), F.nullif(F.col(path_col), F.lit("")).alias("path"),
                                  statements(F.col(text_col)).alias("statements"))
                     .withColumn("row", F.monotonically_increasing_id()), "files")
    said = found.select("row", F.explode("statements").alias("statement")).withColumn("key", F.md5("statement"))
    matched = run.keep(match_statements(spark, said.select("key", "statement"), min_cosine), "matched")
    best = F.min(F.struct((-F.col("cosine")).alias("c"), "license"))
    own = run.keep(said.drop("statement").join(bounded_broadcast(matched), "key").groupBy("row").agg(best.alias("b"))
                   .select("row", "b.license", (-F.col("b.c")).alias("cosine")), "own")
    judged = run.keep(found.drop("statements").join(bounded_broadcast(own), "row", "left"), "judged")

    # a licence file's licence holds for its directory and all below
    folders = (judged.filter(F.col("license").isNotNull() & F.col("path").rlike(LICENSE_FILE))
               .groupBy(_folder(F.col("path")).alias("folder")).agg(F.min(F.struct((-F.col("cosine")).alias("c"), "license")).alias("b"))
               .select("folder", F.col("b.license").alias("f_license"), (-F.col("b.c")).alias("f_cosine")))
    without = judged.filter(F.col("license").isNull() & F.col("path").isNotNull())
    parts = F.split(_folder(F.col("path")), "(?<=/)")
    depths = F.filter(F.sequence(F.lit(1), F.size(parts)), lambda d: F.element_at(parts, d) != "")
    above = without.select("row", F.explode(F.transform(depths, lambda d: F.array_join(F.slice(parts, 1, d), ""))).alias("folder"))
    nearest = (above.join(bounded_broadcast(folders), "folder").groupBy("row")
               .agg(F.max(F.struct(F.length("folder").alias("size"), "folder", "f_license", "f_cosine")).alias("n"))
               .select("row", "n.folder", "n.f_license", "n.f_cosine"))
    return (judged.join(bounded_broadcast(nearest), "row", "left")
            .select(F.col("id").alias(id_col), "path", F.coalesce("license", "f_license").alias("license"),
                    F.coalesce("cosine", "f_cosine").alias("cosine"),
                    F.when(F.col("license").isNotNull(), "own").when(F.col("f_license").isNotNull(), "inherited").otherwise("none").alias("origin"),
                    F.col("folder").alias("inherited_from")))
