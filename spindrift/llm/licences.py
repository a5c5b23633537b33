"""Licence scan: sparse TF-IDF cosine of notices and licence files to templates, then inheritance from the nearest
ancestor directory. DataFrame functions only.

A file's units are stretches of lines that begin with a licence cue, wherever they stand, of each length in ``SPANS`` (a
line, a short notice, the text of a licence); a licence file (by its name) is one unit.
A unit's terms are counted, weighted by the inverse document frequency among the templates (a term of no template has
the largest weight) and compared with each template by the cosine; only terms shared with a template are joined, so
the work follows the matches. The best unit at or over ``threshold`` gives the file's own licence. A directory has the
licence of its licence file; a file without its own licence takes that of the nearest directory at or above it. The
ancestors are joined for distinct directories, not for files.

Defined cases: a null or empty text has no unit; a null path is in no directory and inherits nothing; ties of cosine
go to the first licence by name; several licence files in a directory: the one of the best cosine, then the first
path; repeated rows report each; an empty table gives an empty result; other columns are kept out unless named in
``keep``.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrift.llm.shared import cut

CUE = r"(?i)licen[sc]e|copyright|spdx-|released under|all rights reserved|public domain"
LICENCE_NAME = r"(?i)^(?:licen[sc]e|copying|notice|unlicense)(?:[.-].*)?$"
#: Short notices of common licences (fixed values).
TEMPLATES: dict[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "BSD-2-Clause": "Released under the BSD 2-Clause License (simplified BSD)",
    "BSD-3-Clause": "Released under the BSD 3-Clause License (new BSD)",
    "CC-BY-4.0": "This work is licensed under Creative Commons Attribution CC BY 4.0 International",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0 Creative Commons Attribution NonCommercial",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0 Creative Commons Attribution ShareAlike",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0 Universal",
    "GPL-2.0": "This program is licensed under the GNU General Public License, version 2",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "LGPL-3.0": "Licensed under the GNU Lesser General Public License, version 3",
    "MIT": "Released under the MIT License",
    "MPL-2.0": "Subject to the terms of the Mozilla Public License, v. 2.0 (MPL)",
    "Proprietary": "Copyright. All rights reserved. Proprietary and confidential",
    "Unlicense": "This is free and unencumbered software released into the public domain, Unlicense",
}
#: Headers and texts of licences (fixed values; headers are cut where the names of a work's parts begin).
TEXTS: dict[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at"
    " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS,"
    " WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must"
    " retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and"
    " the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must"
    " retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and"
    " the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to"
    " endorse or promote products derived from this software without specific prior written permission.",
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the"
    " License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or"
    " FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the"
    " License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or"
    " FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear"
    " in all copies.",
    "MIT": "MIT License Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without"
    " restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is"
    " furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or"
    " as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}
TERM = r"[a-z0-9]+(?:\.[0-9]+)*"
#: Lines of a unit, from a line with a cue on.
SPANS = (1, 3, 12)


def templates() -> list[tuple[str, str, str]]:
    """(template, licence, text): the short notice, the text or header, and the tag of each licence."""
    names = sorted({*TEMPLATES, *TEXTS})
    return [(f"{n}/{k}", n, t) for n in names for k, t in (("notice", TEMPLATES.get(n)), ("text", TEXTS.get(n)), ("tag", f"SPDX-License-Identifier: {n}" if n != "Proprietary" else None)) if t]


def template_terms() -> tuple[list[tuple[str, str, str, float, float]], float]:
    """(template, licence, term, weight in a vector of unit length, idf) rows and the idf of unknown terms."""
    counts = {(name, licence): Counter(re.findall(TERM, text.lower())) for name, licence, text in templates()}
    seen = Counter(t for c in counts.values() for t in c)
    idf = {t: round(math.log((1 + len(counts)) / (1 + n)) + 1, 9) for t, n in seen.items()}
    rows = []
    for key, c in counts.items():
        norm = math.sqrt(sum((n * idf[t]) ** 2 for t, n in c.items()))
        rows += [(*key, t, round(n * idf[t] / norm, 9), idf[t]) for t, n in sorted(c.items())]
    return rows, round(math.log(1 + len(counts)) + 1, 9)


def terms_frame(spark: SparkSession) -> DataFrame:
    """The template terms from one literal, a row a term: its idf and the templates that have it."""
    at: dict[str, dict] = {}
    for name, licence, term, weight, idf in template_terms()[0]:
        at.setdefault(term, {"term": term, "idf": idf, "at": []})["at"].append({"template": name, "licence": licence, "weight": weight})
    kind = "array<struct<term:string,idf:double,at:array<struct<template:string,licence:string,weight:double>>>>"
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(list(at.values()))), kind)))


def directory(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def cued(text: Column) -> Column:
    """The stretches of lines from each line with a cue on."""
    of_line = lambda lines, i: F.transform(F.array(*map(F.lit, SPANS)), lambda n: F.array_join(F.slice(lines, i + 1, n), "\n"))
    at = lambda lines: F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(CUE), i)), lambda i: i.isNotNull())
    return F.transform(F.array(F.split(text, "\n")), lambda lines: F.flatten(F.transform(at(lines), lambda i: of_line(lines, i))))[0]


def own_licences(files: DataFrame, threshold: float) -> DataFrame:
    """__row, own_licence, own_cosine of the files with a notice of their own; files: __row, path, text."""
    name = F.regexp_extract(F.coalesce("path", F.lit("")), r"([^/]*)$", 1)
    units = F.when(name.rlike(LICENCE_NAME), F.array(F.col("text"))).when(F.col("text").rlike(CUE), cued(F.col("text")))
    unit = files.select("__row", F.posexplode(units).alias("unit", "notice")).where("notice is not null")
    words = unit.select("__row", "unit", F.explode(F.regexp_extract_all(F.lower("notice"), F.lit(TERM), F.lit(0))).alias("term"))
    tf = words.groupBy("__row", "unit", "term").agg(F.count("*").alias("tf"))
    tf = tf.join(F.broadcast(terms_frame(files.sparkSession)), "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(template_terms()[1])))
    # the unit's own norm rides along with its terms that templates have
    met = F.collect_list(F.when(F.col("at").isNotNull(), F.struct("w", "at")))
    size = tf.groupBy("__row", "unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), met.alias("terms"))
    pairs = size.select("__row", "unit", "norm", F.explode("terms").alias("t")).select("__row", "unit", "norm", "t.w", F.inline("t.at"))
    cosine = pairs.groupBy("__row", "unit", "template", "licence").agg(F.round(F.sum(F.col("w") * F.col("weight")) / F.max("norm"), 6).alias("cosine"))
    best = cosine.where(F.col("cosine") >= threshold).groupBy("__row").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "licence")).alias("b"))
    return best.select("__row", F.col("b.licence").alias("own_licence"), (-F.col("b.c")).alias("own_cosine"))


def scan(files: DataFrame, keep: tuple[str, ...] = (), stands_for: str | None = None, threshold: float = 0.6) -> DataFrame:
    """``keep`` columns, path, own_licence, own_cosine, licence, inherited_from of every file (path, text).

    ``stands_for``: a boolean column of ``files``; of the files it marks, those with a licence count as licence files
    of their directories (for tables without file names)."""
    marked = F.col(stands_for) if stands_for else F.lit(False)
    is_licence = F.regexp_extract(F.coalesce("path", F.lit("")), r"([^/]*)$", 1).rlike(LICENCE_NAME) | F.coalesce(marked, F.lit(False))
    # rows of equal path and text have one key, of two hashes
    parts = [F.coalesce("path", F.lit("")), F.coalesce("text", F.lit("")), F.col("path").isNull(), F.col("text").isNull()]
    rows = files.withColumn("__row", F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(1), *parts).alias("b")))
    own = cut(own_licences(rows.select("__row", "path", "text"), threshold))
    lean = rows.select("__row", *keep, "path", directory(F.col("path")).alias("dir"), is_licence.alias("is_licence"))
    lean = cut(lean.join(own, "__row", "left").drop("__row"))
    of_dir = (
        lean.where("is_licence and own_licence is not null and path is not null")
        .groupBy("dir")
        .agg(F.min(F.struct((-F.col("own_cosine")).alias("c"), "path", "own_licence")).alias("b"))
        .select("dir", F.col("b.own_licence").alias("dir_licence"))
    )
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("above")))
    dirs = lean.where("path is not null").select("dir").distinct().select("dir", F.inline(above))
    nearest = (
        dirs.join(of_dir.select(F.col("dir").alias("above"), "dir_licence"), "above")
        .groupBy("dir")
        .agg(F.max(F.struct("depth", "above", "dir_licence")).alias("b"))
        .select("dir", F.col("b.above").alias("inherited_from"), F.col("b.dir_licence").alias("dir_licence"))
    )
    out = lean.join(nearest, "dir", "left")
    return out.select(
        *keep, "path", "own_licence", "own_cosine",
        F.coalesce("own_licence", "dir_licence").alias("licence"),
        F.when(F.col("own_licence").isNull(), F.col("inherited_from")).alias("inherited_from"),
    )


def scan_documents(docs: DataFrame, threshold: float = 0.6) -> DataFrame:
    """``scan`` of the documents table, whose rows have no paths: they are placed below source/ten thousands, every
    second one (by a checksum of its id) deeper, below the five hundreds, and half of these deeper still, below the
    twenties. Every row with a licence of its own stands for a licence file of its directory."""
    doc_id = F.col("doc_id").cast("long")
    down = lambda n: F.call_function("div", doc_id, F.lit(n)).cast("string")
    depth = F.crc32(doc_id.cast("string").cast("binary")) % 4
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), down(10_000), F.when(depth >= 2, down(500)), F.when(depth == 3, down(20)), doc_id.cast("string"))
    files = docs.select(doc_id.alias("doc_id"), F.when(doc_id.isNotNull(), path).alias("path"), F.col("text").cast("string").alias("text"), F.lit(True).alias("stands"))
    return scan(files, keep=("doc_id",), stands_for="stands", threshold=threshold)


def oracle(threshold: float = 0.6) -> str:
    """``scan_documents`` in SQL, for tables whose doc_id is unique."""
    rows, unknown = template_terms()
    listed = ", ".join(f"('{t}', '{n}', '{w}', {x}, {i})" for t, n, w, x, i in rows)
    table = []
    for b in range(256):
        for _ in range(8):
            b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
        table.append(b)
    crc = f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda c, x: xor(c >> 8, {table}[CAST(xor(c & 255, x) AS INT) + 1])), 4294967295)"
    return rf"""
WITH tpl AS (SELECT * FROM (VALUES {listed}) AS t(template, licence, term, weight, idf)),
idf AS (SELECT DISTINCT term, idf FROM tpl),
deep AS (SELECT doc_id, text, coalesce(source, 'none') AS source, {crc} % 4 AS depth FROM documents),
files AS (SELECT doc_id, concat_ws('/', source, CAST(doc_id // 10000 AS VARCHAR), CASE WHEN depth >= 2 THEN CAST(doc_id // 500 AS VARCHAR) END, CASE WHEN depth = 3 THEN CAST(doc_id // 20 AS VARCHAR) END) AS dir, text FROM deep),
split AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM files WHERE regexp_matches(text, '{CUE}')),
cues AS (SELECT doc_id, l, unnest(list_filter(range(1, len(l) + 1), lambda i: regexp_matches(l[i], '{CUE}'))) AS i FROM split),
lines AS (SELECT doc_id, i * 100 + n AS unit, array_to_string(l[i:i + n - 1], chr(10)) AS notice FROM cues, (SELECT unnest({list(SPANS)}) AS n)),
words AS (SELECT doc_id, unit, unnest(regexp_extract_all(lower(notice), '{TERM}')) AS term FROM lines),
tf AS (SELECT doc_id, unit, term, count(*) * coalesce(max(idf), {unknown}) AS w FROM words LEFT JOIN idf USING (term) GROUP BY 1, 2, 3),
norm AS (SELECT doc_id, unit, sqrt(sum(w * w)) AS norm FROM tf GROUP BY 1, 2),
cosine AS (SELECT doc_id, unit, template, licence, round(sum(w * weight) / max(norm), 6) AS cosine FROM tf JOIN tpl USING (term) JOIN norm USING (doc_id, unit) GROUP BY 1, 2, 3, 4),
own AS (SELECT doc_id, licence AS own_licence, cosine AS own_cosine FROM cosine WHERE cosine >= {threshold} QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, licence) = 1),
lean AS (SELECT f.doc_id, dir, dir || '/' || CAST(f.doc_id AS VARCHAR) AS path, own_licence, own_cosine FROM files f LEFT JOIN own USING (doc_id)),
of_dir AS (SELECT dir, own_licence AS dir_licence FROM lean WHERE own_licence IS NOT NULL QUALIFY row_number() OVER (PARTITION BY dir ORDER BY own_cosine DESC, path) = 1),
dirs AS (SELECT DISTINCT dir FROM lean),
nearest AS (SELECT d.dir, o.dir AS above, dir_licence FROM dirs d JOIN of_dir o ON d.dir = o.dir OR starts_with(d.dir, o.dir || '/') OR o.dir = '' QUALIFY row_number() OVER (PARTITION BY d.dir ORDER BY length(o.dir) DESC) = 1)
SELECT doc_id, path, own_licence, own_cosine, coalesce(own_licence, dir_licence) AS licence, CASE WHEN own_licence IS NULL THEN above END AS inherited_from FROM lean LEFT JOIN nearest USING (dir)
"""
