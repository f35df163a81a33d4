"""Licence scan: TF-IDF cosine of whole files, paragraphs and lines to templates, then inheritance from the nearest ancestor directory.

Each text is compared as a whole (a licence file; with the longer templates only), by paragraph (a header) and by line (a one-line notice or an SPDX
tag); the best of these counts. Weights are term frequency times inverse document frequency over all texts. A word that
no template has counts fully in the norm, with the weight of a word that no text has, so prose around a notice lowers the
similarity. No keyword picks the parts: what is left out before the joins are parts without a *distinctive* word. The
other words are so common that a part of these alone can't reach the threshold with any template (Cauchy-Schwarz on the
templates' weights), so this loses nothing. Files without a licence of their own take the one of the nearest
directory above them that has a licence file. DataFrame operations only; the driver sees one number for each template word.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import column, scratch

_WARRANTY = ('THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
             "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. ")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. ")
_BSD_3 = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
          "software without specific prior written permission. ")
_BSD_END = ('THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
            "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
            "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
            "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
            "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
            "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")


def _gnu(program: str, name: str, version: str) -> str:
    return (f"This {program} is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software "
            f"Foundation, either version {version} of the License, or (at your option) any later version. This {program} is distributed in the hope that it "
            f"will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} "
            f"for more details. You should have received a copy of the {name} along with this {program}. If not, see <https://www.gnu.org/licenses/>.")


#: Texts of the short licences, the standard headers and titles of the long ones, and common one-line notices.
TEMPLATES = {
    "AGPL-3.0": ["GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007", _gnu("program", "GNU Affero General Public License", "3"),
                 "Licensed under the GNU Affero General Public License, version 3."],
    "Apache-2.0": [
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a '
        "copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed "
        'under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for '
        "the specific language governing permissions and limitations under the License.",
        "Licensed under the Apache License, Version 2.0."],
    "BSD-2-Clause": [_BSD + _BSD_END, "Released under the BSD 2-Clause License."],
    "BSD-3-Clause": [_BSD + _BSD_3 + _BSD_END, "Released under the BSD 3-Clause License.",
                     "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."],
    "CC-BY-4.0": ["This work is licensed under the Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."],
    "CC-BY-NC-4.0": ["This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License.", "Licensed under CC BY-NC 4.0."],
    "CC-BY-SA-4.0": ["This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.", "Licensed under CC BY-SA 4.0."],
    "CC0-1.0": ["This work is dedicated to the public domain under CC0 1.0 Universal.", "Creative Commons CC0 1.0 Universal Public Domain Dedication"],
    "GPL-2.0": ["GNU GENERAL PUBLIC LICENSE Version 2, June 1991", _gnu("program", "GNU General Public License", "2"),
                "This work is licensed under the GNU General Public License, version 2."],
    "GPL-3.0": ["GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", _gnu("program", "GNU General Public License", "3"),
                "This work is licensed under the GNU General Public License, version 3."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
            'copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH '
            "REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
            "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
            "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
            "Released under the ISC License."],
    "LGPL-3.0": ["GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007", _gnu("library", "GNU Lesser General Public License", "3"),
                 "This library is licensed under the GNU Lesser General Public License, version 3."],
    "MIT": ['Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
            "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
            "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _WARRANTY +
            "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
            "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
            "Released under the MIT License.", "MIT License", "Licensed under the MIT License."],
    "MPL-2.0": ["Mozilla Public License Version 2.0",
                "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You "
                "can obtain one at https://mozilla.org/MPL/2.0/."],
    "Unlicense": ["This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
                  "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."],
}
#: Names of files that hold the licence of their directory if they name a known one.
LICENCE_NAME = r"(?i)(^|/)(licen[sc]e|copying|unlicense)([.-][^/]*)?$"
#: A template of at least so many words is a licence's text or header: only these make a whole file a licence file.
FULL_WORDS = 20
#: A text with one of these speaks of licences (reported beside the result; decides nothing).
NOTICE = r"(?i)licen[sc]|copyright|spdx|redistribut|all rights reserved|public domain"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Paragraphs end at a line without a letter, digit or non-ASCII character.
BREAK = r"\n[\x00-\x09\x0B-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*\n"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def bodies(templates: dict[str, list[str]]) -> list[tuple[str, str]]:
    """(licence, text) of every template, each licence's SPDX tag included; a GNU licence also has the tags -only and -or-later."""
    out = []
    for name, texts in sorted(templates.items()):
        tags = [name] + ([f"{name}-only", f"{name}-or-later"] if "GPL" in name else [])
        out += [(name, text) for text in texts] + [(name, f"SPDX-License-Identifier: {tag}") for tag in tags]
    return out


def counted(templates: dict[str, list[str]]) -> list[tuple[str, Counter]]:
    return [(name, Counter(re.findall(WORD, text.lower()))) for name, text in bodies(templates)]


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few thousand rows from one JSON literal (no RDD, no Python worker)."""
    names = [field.split()[0] for field in schema.split(", ")]
    text = json.dumps([dict(zip(names, r)) for r in rows])
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{', '.join(f.replace(' ', ': ') for f in schema.split(', '))}>>")))


def distinctive(made: list[tuple[str, Counter]], idf: dict[str, float], least: float) -> list[str]:
    """The template words without which no part reaches ``least``: all but the most common words whose weights
    together stay under ``least`` times the norm in every template."""
    norms = [sum((n * idf[w]) ** 2 for w, n in c.items()) for _, c in made]
    room = [least * least * n * (1 - 1e-6) for n in norms]  # similarities are rounded, so keep a margin
    common = set()
    for w in sorted(idf, key=lambda w: (idf[w], w)):
        cost = [(c[w] * idf[w]) ** 2 for _, c in made]
        if all(a < b for a, b in zip(cost, room)):
            room = [b - a for a, b in zip(cost, room)]
            common.add(w)
    return sorted(set(idf) - common)


def matches(files: DataFrame, id_col: str, text_col: str, templates: dict[str, list[str]], least: float) -> DataFrame:
    """id, licence, similarity (6 digits), whole (similarity of the text as a whole, 0 under ``least``): the best template of each id
    that reaches ``least`` with any part. Ties: the first name."""
    spark = files.sparkSession
    made = counted(templates)
    vocabulary = sorted(set().union(*[c for _, c in made]))
    texts = files.select(column(files, id_col).alias("id"), F.coalesce(column(files, text_col).cast("string"), F.lit("")).alias("t"))
    # Document frequencies of the template words over all texts, and the number of texts as that of the empty word.
    seen = F.concat(F.array(F.lit("")), F.array_distinct(F.filter(words(F.col("t")), lambda w: w.isin(vocabulary))))
    df = {r["w"]: r["n"] for r in texts.select(F.explode(seen).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = df.get("", 0)
    idf = {w: math.log((1 + total) / (1 + df.get(w, 0))) + 1 for w in vocabulary}
    other = math.log(1 + total) + 1
    needed = distinctive(made, idf, least)

    def telling(t: Column) -> Column:
        return F.exists(words(t), lambda w: w.isin(needed))

    lines, paragraphs = F.split("t", "\n"), F.split("t", BREAK)
    parts = F.concat(F.array(F.struct(F.lit(True).alias("whole"), F.col("t").alias("part"))),
                     F.transform(F.array_distinct(F.concat(paragraphs, lines)), lambda p: F.struct(F.lit(False).alias("whole"), p.alias("part"))))
    part = (texts.where(telling(F.col("t"))).select("id", F.explode(parts).alias("p")).select("id", "p.whole", words(F.col("p.part")).alias("all"))
            .where(F.exists("all", lambda w: w.isin(needed)))
            .select("id", "whole", F.filter("all", lambda w: w.isin(vocabulary)).alias("terms"), F.size("all").alias("size"))
            .select(F.monotonically_increasing_id().alias("k"), "id", "whole", (F.col("size") - F.size("terms")).alias("rest"), "terms"))
    part = scratch(part, "licence-parts")  # the numbers stay what they are; read twice below
    tf = part.select("k", F.explode("terms").alias("w")).groupBy("k", "w").agg(F.count(F.lit(1)).alias("tf"))
    # Weights of the templates, at most words x templates rows; template -1 makes the square of the part's own norm.
    rows = [(i, w, n * idf[w] * idf[w]) for i, (_, c) in enumerate(made) for w, n in c.items()] + [(-1, w, idf[w] ** 2) for w in vocabulary]
    weights = small_table(spark, rows, "i int, w string, x double")
    sums = (tf.join(F.broadcast(weights), "w")
            .groupBy("k", "i").agg(F.sum(F.when(F.col("i") < 0, F.col("tf") * F.col("tf")).otherwise(F.col("tf")) * F.col("x")).alias("s")))
    norms = [math.sqrt(sum((n * idf[w]) ** 2 for w, n in c.items())) for _, c in made]
    names = small_table(spark, [(i, name, norms[i], c.total() >= FULL_WORDS) for i, (name, c) in enumerate(made)] + [(-1, None, 1.0, False)],
                        "i int, licence string, norm double, full boolean")
    # At most one entry for each template.
    per_part = (sums.join(F.broadcast(names), "i").groupBy("k")
                .agg(F.max(F.when(F.col("i") < 0, F.col("s"))).alias("own"),
                     F.collect_list(F.when(F.col("i") >= 0, F.struct((F.col("s") / F.col("norm")).alias("d"), "licence", "full"))).alias("dots")))
    scored = per_part.join(part.select("k", "id", "whole", "rest"), "k")
    length = F.sqrt(F.col("own") + F.col("rest") * F.lit(other * other))
    scored = scored.withColumn("best", F.array_min(F.transform(
        F.filter("dots", lambda x: x["full"] | ~F.col("whole")), lambda x: F.struct((-F.round(x["d"] / length, 6)).alias("d"), x["licence"].alias("licence")))))
    hits = scored.where(-F.col("best.d") >= least)
    return (hits.groupBy("id").agg(F.min("best").alias("b"), F.max(F.when(F.col("whole"), -F.col("best.d")).otherwise(0.0)).alias("whole"))
            .select("id", F.col("b.licence").alias("licence"), (-F.col("b.d")).alias("similarity"), "whole"))


def licence_scan(files: DataFrame, path_col: str, id_col: str = "doc_id", text_col: str = "text",
                 templates: dict[str, list[str]] = TEMPLATES, least: float = 0.6) -> DataFrame:
    """Per file: ``id_col``, ``licence`` (null: none), ``origin`` (own, inherited or none), ``similarity`` (of an own licence, else 0),
    ``licence_dir`` (where an inherited one comes from), ``notice`` (the text speaks of licences, known or not).

    ``path_col``: slash-separated paths; the directory is all before the last slash. A file with a known licence is a
    licence file if its whole text reaches ``least`` with a template of ``FULL_WORDS`` words or more, or if its name says so (``LICENCE_NAME``); a directory with several takes the highest
    similarity, then the first name. An own known licence wins; without one (a notice that no template explains is
    none) the nearest directory above, the own one first, with a licence file counts. Null or empty texts have no
    notice; a null path has the directory '' and no name. Whole texts are compared at any length. Rows of one id (null
    is one, too) share the best match among them, and every row gives a row. Columns but the three named ones
    aren't looked at, whatever their names. Empty tables give an empty result. Directories are resolved once each, so a directory
    with a third of all files adds one row to the path joins.
    """
    best = matches(files, id_col, text_col, templates, least)
    path = F.coalesce(column(files, path_col).cast("string"), F.lit(""))
    base = files.select(column(files, id_col).alias("id"), F.regexp_extract(path, r"^([\s\S]*)/[^/]*$", 1).alias("dir"), path.rlike(LICENCE_NAME).alias("named"),
                        F.coalesce(column(files, text_col).cast("string").rlike(NOTICE), F.lit(False)).alias("notice"))
    own = base.join(best.withColumnRenamed("id", "best_id"), F.col("id").eqNullSafe(F.col("best_id")), "left").drop("best_id")
    roots = (own.where(F.col("licence").isNotNull() & (F.col("named") | (F.col("whole") >= least)))
             .groupBy(F.col("dir").alias("above"))
             .agg(F.min(F.struct((-F.col("similarity")).alias("d"), "licence")).alias("r")))
    dirs = base.select("dir").distinct()
    parts = F.split("dir", "/")
    above = dirs.select("dir", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.when(
        k == 0, F.lit("")).otherwise(F.array_join(F.slice(parts, 1, k), "/")))).alias("above")).distinct()
    nearest = (above.join(roots, "above").groupBy("dir")
               .agg(F.max_by(F.struct("above", "r"), F.length("above")).alias("near"))
               .select("dir", F.col("near.above").alias("near_dir"), F.col("near.r.licence").alias("near_licence")))
    out = own.join(nearest, "dir", "left")
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("licence", "near_licence").alias("licence"),
        F.when(F.col("licence").isNotNull(), "own").when(F.col("near_licence").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.coalesce("similarity", F.lit(0.0)).alias("similarity"),
        F.when(F.col("licence").isNull(), F.col("near_dir")).alias("licence_dir"),
        "notice")


def licence_sql(table: str = "documents", path: str = "'/' || concat_ws('/', source, lang, CAST(doc_id AS VARCHAR))",
                templates: dict[str, list[str]] = TEMPLATES, least: float = 0.6) -> str:
    """``licence_scan`` in DuckDB's SQL, every part of every text compared, for tables with distinct ids."""
    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    made = counted(templates)
    rows = ", ".join(f"({i}, {quoted(name)}, {quoted(w)}, {n}, {c.total() >= FULL_WORDS})" for i, (name, c) in enumerate(made) for w, n in sorted(c.items()))
    low = f"translate({{}}, '{UPPER}', '{LOWER}')"
    extracted = f"regexp_extract_all({low}, {quoted(WORD)})"
    return f"""
WITH tpl(i, licence, w, n, complete) AS (VALUES {rows}),
docs AS (SELECT doc_id, coalesce(text, '') AS t, coalesce({path}, '') AS path FROM {table}),
vocab AS (SELECT DISTINCT w FROM tpl),
total AS (SELECT count(*) AS files FROM docs),
seen AS (SELECT w, count(*) AS df FROM (SELECT unnest(list_distinct({extracted.format('t')})) AS w FROM docs) GROUP BY w),
idf AS (SELECT v.w, ln((1 + files) / (1 + coalesce(df, 0))) + 1 AS idf FROM vocab v LEFT JOIN seen USING (w), total),
part AS (SELECT doc_id, TRUE AS whole, t AS p FROM docs
         UNION ALL SELECT doc_id, FALSE, unnest(list_distinct(list_concat(regexp_split_to_array(t, {quoted(BREAK)}), string_split(t, chr(10))))) FROM docs),
numbered AS (SELECT row_number() OVER () AS k, doc_id, whole, {extracted.format('p')} AS ws FROM part),
tf AS (SELECT k, w, count(*) AS tf FROM (SELECT k, unnest(ws) AS w FROM numbered) GROUP BY k, w),
inside AS (SELECT k, sum(tf) AS inside, sum(tf * tf * idf * idf) AS own FROM tf JOIN idf USING (w) GROUP BY k),
norm_t AS (SELECT i, sqrt(sum(n * n * idf * idf)) AS norm FROM tpl JOIN idf USING (w) GROUP BY i),
dots AS (SELECT k, i, licence, complete, sum(tf * n * idf * idf) AS dot FROM tf JOIN tpl USING (w) JOIN idf USING (w) GROUP BY ALL),
sims AS (SELECT doc_id, whole, licence, round(dot / norm / sqrt(own + (len(ws) - inside) * power(ln(1 + files) + 1, 2)), 6) AS similarity
         FROM dots JOIN norm_t USING (i) JOIN inside USING (k) JOIN numbered USING (k), total WHERE complete OR NOT whole),
best AS (SELECT doc_id, arg_min(licence, (-similarity, licence)) AS licence, max(similarity) AS similarity,
                max(CASE WHEN whole THEN similarity ELSE 0 END) AS whole FROM sims WHERE similarity >= {least} GROUP BY doc_id),
own AS (SELECT d.doc_id, regexp_extract(path, '(?s)^(.*)/[^/]*$', 1) AS dir, regexp_matches(path, {quoted(LICENCE_NAME)}) AS named,
               regexp_matches(t, {quoted(NOTICE)}) AS notice, licence, similarity, whole FROM docs d LEFT JOIN best b ON d.doc_id = b.doc_id),
roots AS (SELECT dir AS above, arg_min(licence, (-similarity, licence)) AS near FROM own WHERE licence IS NOT NULL AND (named OR whole >= {least}) GROUP BY dir),
nearest AS (SELECT dir, arg_max(above, length(above)) AS above, arg_max(near, length(above)) AS near
            FROM (SELECT DISTINCT dir FROM own) JOIN roots ON above = '' OR dir = above OR starts_with(dir, above || '/') GROUP BY dir)
SELECT doc_id, coalesce(licence, near) AS licence, CASE WHEN licence IS NOT NULL THEN 'own' WHEN near IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       coalesce(similarity, 0.0)::DOUBLE AS similarity, CASE WHEN licence IS NULL THEN above END AS licence_dir, notice
FROM own LEFT JOIN nearest USING (dir)"""
