"""Licence scans: TF-IDF cosine of statements to templates, then inheritance by directory.

Terms are lower-cased words without punctuation at their ends. The weight of a term in a
text is its count by ln((1 + files) / (1 + files with it)) + 1, counted over all files. A
line states the licence of a template from a cosine of ``STATEMENT``; lines are compared
whole and wherever they stand, header or footer. A file of which the whole text has a cosine
of ``WHOLE`` is a licence file: it speaks for its directory. A file without a statement
inherits from the licence file of its nearest ancestor directory.

Beside these statements stand whole texts (``licences``) and headers of files (``HEADERS``). A
file of which the whole text has a cosine of ``STATEMENT`` to one of the texts states that
licence and is a licence file. A header is compared to as many words of a file, whatever their
lines, laid so that one of its ``ANCHORS`` rarest terms stands in its place. A statement that no
line makes alone is looked for in two and three lines. The whole text counts before a header,
this before a line and this before several lines.

A tag (``SPDX-License-Identifier: MIT``) and its identifier are one term, so a line with a tag
is as near to that tag's template as the line has few other words; a tag of another identifier
is another term. Tags are compared to lines only: a short file with a tag is no licence file.
Expressions of several identifiers (``MIT OR Apache-2.0``) state none.

Vectors stay sparse. A template's heaviest terms, those without which no text can reach the
threshold, pick the lines that are compared at all; terms are counted per task before they
are shuffled. Directories are made distinct before they are joined.

Null texts state nothing; null paths have no directory. Of several best templates (equal to nine
places) or files the first by name counts. Repeated rows are judged each. An empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import math
import re
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quotelake.llm.common import attach, null_marked, stage_table, words

STATEMENT = 0.8
WHOLE = 0.5
ANCHORS = 3
PUNCTUATION = ".,;:!?()[]{}<>\"'*#/-_|"

# Statements of common licences: fixed values.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "all-rights-reserved": "All rights reserved.",
}

# Headers that files of a licence carry: fixed values.
HEADERS = {
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License.""",
    "BSD-3-Clause": """Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.""",
    "MIT": """Use of this source code is governed by an MIT-style license that can be found in the LICENSE file or at
https://opensource.org/licenses/MIT.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
}
_GNU = """This {what} is free software{colon} you can redistribute it and/or modify it under the terms of the GNU {kind} General
Public License as published by the Free Software Foundation, either version {version} of the License, or (at your option)
any later version. This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} General Public License for more
details. You should have received a copy of the GNU {kind} General Public License along with this {what}. If not, see
<https://www.gnu.org/licenses/>."""
HEADERS |= {f"{name}-{version}": _GNU.format(what=what, colon=";" if version < "3" else ":", kind=kind, version=number)
            for name, what, kind, version, number in (
                ("GPL", "program", "", "2.0", "2"), ("GPL", "program", "", "3.0", "3"),
                ("LGPL", "library", "Lesser", "2.1", "2.1"), ("LGPL", "library", "Lesser", "3.0", "3"))}

# Identifiers in tags: fixed values. Those of the GNU licences have forms of their own.
TAG = "spdx-license-identifier:"
TAGS = {f"SPDX-License-Identifier: {name}{form}": name
        for names, forms in ((("Apache-2.0", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "MIT", "MPL-2.0"), ("",)),
                             (("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0"), ("", "+", "-only", "-or-later")))
        for name in names for form in forms}

TEXTS = {path.stem: path.read_text() for path in sorted((Path(__file__).parent / "licences").glob("*.txt"))}


def terms(text: Column) -> Column:
    small = F.lower(text)
    joined = F.when(F.contains(small, F.lit(TAG)), F.regexp_replace(small, TAG + r"[ \t(]+", TAG)).otherwise(small)
    trimmed = F.transform(words(joined), lambda w: F.btrim(w, F.lit(PUNCTUATION)))
    return F.filter(trimmed, lambda w: w != "")


def _plain_terms(text: str) -> list[str]:
    joined = re.sub(TAG + r"[ \t(]+", TAG, text.lower())
    return [t for t in (w.strip(PUNCTUATION) for w in joined.split()) if t]


def _idf(files: int, with_term: int) -> float:
    return math.log((1 + files) / (1 + with_term)) + 1


def template_weights(counts: dict[str, int], files: int, templates: dict[str, str]) -> dict[str, dict[str, float]]:
    """Unit vectors of the templates."""
    vectors = {}
    for name, text in templates.items():
        tokens = _plain_terms(text)
        raw = {t: tokens.count(t) * _idf(files, counts.get(t, 0)) for t in tokens}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        vectors[name] = {t: w / norm for t, w in raw.items()}
    return vectors


def key_terms(vectors: dict[str, dict[str, float]], threshold: float) -> list[str]:
    """Terms of which a text must have one to reach the threshold with any template: without
    them the rest of each template is too light."""
    keys = set()
    for weights in vectors.values():
        left = 1.0
        for term, weight in sorted(weights.items(), key=lambda x: (-x[1], x[0])):
            if left < threshold * threshold:
                break
            keys.add(term)
            left -= weight * weight
    return sorted(keys)


def rare_terms(vectors: dict[str, dict[str, float]], counts: dict[str, int], files: int,
               threshold: float) -> dict[str, list[str]]:
    """Of each template the heaviest terms of few files, then others, of which a text must have
    one to reach the threshold."""
    few = 10 + files // 1000
    result = {}
    for name, weights in vectors.items():
        left, result[name] = 1.0, []
        for term in sorted(weights, key=lambda t: (max(few, counts.get(t, 0)), -weights[t], t)):
            if left < threshold * threshold - 1e-9:
                break
            result[name].append(term)
            left -= weights[term] ** 2
    return result


def _vector_table(spark: SparkSession, vectors: dict[str, dict[str, float]]) -> DataFrame:
    return spark.createDataFrame([(name, t, w) for name, vector in vectors.items() for t, w in vector.items()],
                                 "template string, term string, unit double")


def _cosines(units: DataFrame, weights: DataFrame, vectors: DataFrame, keys: list[str]) -> DataFrame:
    """keys, template and cosine of every unit (keys, terms) and template that share a term."""
    counted = units.select(*keys, F.explode("terms").alias("term")).groupBy(*keys, "term").agg(F.count("*").alias("tf"))
    weighed = counted.join(weights, "term").withColumn("weight", F.col("tf") * F.col("idf"))
    norms = weighed.groupBy(*keys).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    products = weighed.join(F.broadcast(vectors), "term").groupBy(*keys, "template").agg(
        F.sum(F.col("weight") * F.col("unit")).alias("product"))
    return products.join(norms, keys).select(*keys, "template", (F.col("product") / F.col("norm")).alias("cosine"))


def statements(files: DataFrame, templates: dict[str, str] = TEMPLATES, tags: dict[str, str] = TAGS) -> DataFrame:
    """row_key of every file that states a licence, its licence and whether it is a licence file."""
    spark = files.sparkSession
    tag_texts = {tag: tag for tag in tags}
    vocabulary = sorted({t for of in (templates, tag_texts, HEADERS, TEXTS) for text in of.values() for t in _plain_terms(text)})
    frequency = stage_table(
        files.select(F.explode(F.array_distinct(terms(F.col("text")))).alias("term"))
        .groupBy("term").agg(F.count("*").alias("df")), "licence-terms")
    counts = {r["term"]: r["df"] for r in frequency.filter(F.col("term").isin(vocabulary)).collect()}
    total = files.count()
    vectors = template_weights(counts, total, templates)
    of_tags = template_weights(counts, total, tag_texts)
    table, line_table = _vector_table(spark, vectors), _vector_table(spark, vectors | of_tags)
    headers, texts = (template_weights(counts, total, of) for of in (HEADERS, TEXTS))
    rare_of_headers, rare_of_texts = (rare_terms(of, counts, total, STATEMENT) for of in (headers, texts))
    rare = sorted({t for of in (rare_of_headers, rare_of_texts) for some in of.values() for t in some})

    keys = key_terms(vectors | of_tags, min(STATEMENT, WHOLE))

    def has(column: str, of: list[str]) -> Column:
        return F.arrays_overlap(column, F.array(*map(F.lit, of)))

    # Terms come out of a generator: what is asked of them does not make them again.
    listed = files.select("row_key", "text", F.explode(F.array(terms(F.col("text")))).alias("terms"))
    hinted = stage_table(
        listed.select("row_key", "text", has("terms", keys).alias("of_line"), has("terms", rare).alias("of_text"))
        .filter("of_line or of_text"), "licence-hints")
    long = hinted.filter("of_text").select("row_key", terms(F.col("text")).alias("terms"))
    long = stage_table(long, "licence-long").dropDuplicates(["row_key"])
    hinted = hinted.filter("of_line").select("row_key", "text")
    lines = hinted.select("row_key", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    lines = lines.select("row_key", "line", F.explode(F.array(terms(F.col("text")))).alias("terms"))
    units = stage_table(lines.filter(has("terms", keys)), "licence-lines")
    wholes = hinted.join(units.select("row_key").distinct(), "row_key", "left_semi").select(
        "row_key", terms(F.col("text")).alias("terms"))
    weights = frequency.select("term", (F.log((1 + F.lit(total)) / (1 + F.col("df"))) + 1).alias("idf"))

    best = F.max(F.struct("rank", F.round("cosine", 9), F.col("order")))
    names = sorted({*templates, *tags, *HEADERS, *TEXTS}, reverse=True)  # of equal cosines the first name has the largest number
    number = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "template string, order int")
    of_line = stage_table(
        _cosines(units, weights, line_table, ["row_key", "line"]).filter(F.col("cosine") >= STATEMENT), "licence-stated")
    of_whole = _cosines(wholes, weights, table, ["row_key"]).groupBy("row_key").agg(F.max("cosine").alias("whole"))

    # Two and three lines around one with a key, in files of which no line states a licence.
    split = F.split("text", "\n")
    beside = units.join(of_line, "row_key", "left_anti").join(hinted, "row_key").select("row_key", "line", split.alias("lines"))
    spans = F.array(*(F.struct(F.lit(a).alias("from"), F.lit(n).alias("n")) for a, n in ((-1, 2), (0, 2), (-2, 3), (-1, 3), (0, 3))))
    several = beside.withColumn("span", F.explode(spans)).withColumn("at", F.col("line") + F.col("span.from")).filter(
        (F.col("at") >= 0) & (F.col("at") + F.col("span.n") <= F.size("lines")))
    several = several.select("row_key", (F.col("at") * 4 + F.col("span.n")).alias("line"), terms(
        F.array_join(F.slice("lines", F.col("at") + 1, F.col("span.n")), "\n")).alias("terms")).dropDuplicates(["row_key", "line"])
    of_several = _cosines(several, weights, table, ["row_key", "line"]).filter(F.col("cosine") >= STATEMENT)

    # As many words as a header has, laid at each of its anchors.
    places = []
    for name, text in HEADERS.items():
        tokens = _plain_terms(text)
        places += [(name, t, tokens.index(t), len(tokens)) for t in rare_of_headers[name][:ANCHORS]]
    laid = F.broadcast(spark.createDataFrame(places, "header string, anchor string, offset int, size int"))
    at = long.select("row_key", "terms", F.posexplode("terms").alias("place", "term")).join(laid, F.col("term") == F.col("anchor"))
    at = at.withColumn("begin", F.greatest(F.col("place") - F.col("offset"), F.lit(0)))
    words_at = at.select("row_key", "begin", "header", F.slice("terms", F.col("begin") + 1, F.col("size")).alias("terms")).dropDuplicates(
        ["row_key", "begin", "header"])
    of_header = _cosines(words_at, weights, _vector_table(spark, headers), ["row_key", "begin", "header"]).filter(
        (F.col("cosine") >= STATEMENT) & (F.col("template") == F.col("header")))
    of_text = _cosines(long, weights, _vector_table(spark, texts), ["row_key"]).filter(F.col("cosine") >= STATEMENT)

    found = reduce(DataFrame.unionByName, (
        part.select("row_key", "template", "cosine", F.lit(rank).alias("rank"))
        for rank, part in enumerate((of_several, of_line, of_header, of_text))))
    own = found.join(F.broadcast(number), "template").groupBy("row_key").agg(best.alias("best"))
    return stage_table(
        own.join(of_whole, "row_key", "left").select(
            "row_key", F.element_at(F.array(*(F.lit(tags.get(n, n)) for n in names)), F.col("best.order") + 1).alias("licence"),
            ((F.col("best.rank") == 3) | (F.coalesce("whole", F.lit(0.0)) >= WHOLE)).alias("is_licence_file")), "licences")


def directory(path: Column) -> Column:
    """The path up to the last slash; empty at the top, null for a null path."""
    return F.when(F.contains(path, F.lit("/")), F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.when(path.isNotNull(), ""))


def scan(files: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """file_id, path, licence, origin ('statement', 'directory' or null) and from_dir of every
    file of (file_id, path, text)."""
    keyed = files.select("file_id", "path", "text", F.xxhash64(*null_marked("file_id", "path", "text")).alias("row_key"))
    stated = statements(keyed, templates)
    rows = keyed.select("file_id", "path", "row_key", directory(F.col("path")).alias("dir"))
    own = attach(rows, stated, ["row_key"])

    speaking = own.filter("is_licence_file and dir is not null").groupBy(F.col("dir").alias("from_dir")).agg(
        F.min(F.struct("path", "licence")).alias("first"))
    speaking = stage_table(speaking.select("from_dir", F.col("first.licence").alias("given")), "licence-dirs")
    dirs = rows.select("dir").filter("dir is not null").distinct()
    parts = F.split("dir", "/")
    above = dirs.withColumn("depth", F.explode(F.sequence(F.lit(0), F.size(parts)))).withColumn(
        "from_dir", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/"))
    nearest = attach(above, speaking, ["from_dir"], "inner").groupBy("dir").agg(
        F.max(F.struct("depth", "from_dir", "given")).alias("near"))
    nearest = stage_table(nearest.select("dir", F.col("near.from_dir").alias("from_dir"), F.col("near.given").alias("given")), "inherited")
    told = attach(own, nearest, ["dir"])
    return told.select(
        "file_id", "path", F.coalesce("licence", "given").alias("licence"),
        F.when(F.col("licence").isNotNull(), "statement").when(F.col("given").isNotNull(), "directory").alias("origin"),
        F.when(F.col("licence").isNull(), F.col("from_dir")).alias("from_dir"))
