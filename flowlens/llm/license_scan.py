"""License scan: sparse TF-IDF cosine to templates, then inheritance by directory.

DataFrame functions only. The units of a file are its lines (notices and
headers stand anywhere) and, where the file's name says that it is a licence
file, its whole text. A unit's terms are its ASCII letter and digit runs,
lower-cased.

Weights: ``tf * idf`` with ``idf = ln((1 + units) / (1 + df)) + 1``; document
frequencies are counted over the lines of all files, for every term. A unit's
norm is over all its terms with their own frequencies.

No term's idf is below that of the commonest term outside the templates, which
bounds a unit's cosine from its template terms and its number of words; units
below the threshold by that bound go before any join. The rest meet the
template vectors, and what may still reach the threshold meets the table of
frequencies term by term: frequent terms (at most ``COMMON_TERMS``, as each has
that share of all frequencies) are broadcast, the others joined, so no term
gathers its units in one task. A file's licence is its best unit (ties: the
earlier unit, then the template's name). A directory's licence is the best of
the files that lie directly in it (ties: the lesser path). A file without its
own takes the nearest ancestor directory's, by joining the distinct
directories' ancestors to the directories that have one.

Nulls: a null text has no terms; a null path has no directory and inherits
nothing. Repeated rows get one result each. An empty table gives an empty
table. Extra columns are ignored. A long text is cut into its lines, none of
which is left out; a file is one row until then.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import shared_table

THRESHOLD = 0.7
COMMON_TERMS = 10_000
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|unlicense)[^/]*$"

# The usual notice of each licence.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, Version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("All-Rights-Reserved", "All rights reserved."),
]


def template_terms(text: str) -> Counter:
    return Counter(re.findall("[a-z0-9]+", text.lower()))


def _terms(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit("([A-Za-z0-9]+)"), F.lit(1)), lambda t: F.lower(t))


def _count(terms: Column, term: Column) -> Column:
    return F.size(F.filter(terms, lambda t: t == term)).cast("double")


def license_scan(files: DataFrame, path_col: str = "path", text_col: str = "text", id_col: str = "doc_id",
                 templates=TEMPLATES, threshold: float = THRESHOLD, licence_file: str = LICENCE_FILE) -> DataFrame:
    """One row a file: ``id``, ``path``, ``licence``, ``score`` and ``line`` of its own
    notice (0 for a whole licence file), and ``declared_in`` (its own path, the
    ancestor directory it inherits from, or null)."""
    spark = files.sparkSession
    vocabulary = sorted({t for _, text in templates for t in template_terms(text)})
    known = F.array(*[F.lit(t) for t in vocabulary])
    rows = files.select(F.col(id_col).cast("bigint").alias("id"), F.col(path_col).cast("string").alias("path"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    pieces = F.transform(F.split("text", "\n"), lambda x, i: F.struct((i + 1).alias("line"), x.alias("text")))
    whole = F.when(F.col("path").rlike(licence_file), F.array(F.struct(F.lit(0).alias("line"), F.col("text").alias("text")))
                   ).otherwise(F.array().cast("array<struct<line:int,text:string>>"))
    units = (rows.select("id", "path", F.explode(F.concat(pieces, whole)).alias("u"))
             .select("id", "path", F.col("u.line").alias("line"), _terms(F.col("u.text")).alias("terms"))
             .withColumn("own", F.array_intersect("terms", known)))

    seen = shared_table(units.where("line > 0").select(F.explode(F.array_distinct("terms")).alias("term"))
                        .groupBy("term").agg(F.count(F.lit(1)).alias("df")), "frequencies")
    total = rows.select(F.sum(F.size(F.split("text", "\n")))).first()[0] or 0
    in_templates = F.col("term").isin(vocabulary)
    df = {r.term: r.df for r in seen.where(in_templates).collect()}  # at most one row a template term
    spread = seen.agg(F.sum("df").alias("all"), F.max(F.when(~in_templates, F.col("df"))).alias("most")).first()
    least = math.log((1 + total) / (1 + (spread["most"] or 0))) + 1
    idf = {t: math.log((1 + total) / (1 + df.get(t, 0))) + 1 for t in vocabulary}

    vectors = []
    for number, (name, text) in enumerate(templates):
        terms = template_terms(text)
        norm = math.sqrt(sum((n * idf[t]) ** 2 for t, n in terms.items()))
        vectors += [(number, name, t, n * idf[t] / norm) for t, n in terms.items()]
    vectors = spark.createDataFrame(vectors, "template int, licence string, term string, weight double")

    lookup = F.create_map(*[F.lit(x) for t in vocabulary for x in (t, idf[t])])
    weighted = (units.where(F.size("own") > 0)
                .withColumn("vector", F.transform("own", lambda t: F.struct(t.alias("term"), _count(F.col("terms"), t).alias("n"))))
                .withColumn("vector", F.transform("vector", lambda x: F.struct(
                    x["term"].alias("term"), x["n"].alias("n"), (x["n"] * F.element_at(lookup, x["term"])).alias("weight")))))
    known_part = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x["weight"] * x["weight"])
    strangers = F.size("terms") - F.aggregate("vector", F.lit(0.0), lambda a, x: a + x["n"])  # of n equal ones, n * n count
    measured = shared_table(weighted.withColumn("known_part", known_part)
                            .withColumn("square", F.col("known_part") + strangers * F.lit(least ** 2))
                            .where(F.col("known_part") >= F.lit(threshold ** 2) * F.col("square") - F.lit(1e-9))
                            .select(F.monotonically_increasing_id().alias("unit"), "id", "path", "line", "terms", "vector", "square"), "candidates")
    close = shared_table(measured.select("unit", "id", "path", "line", "square", F.explode("vector").alias("v"))
                         .select("unit", "id", "path", "line", "square", F.col("v.term").alias("term"), F.col("v.weight").alias("own_weight"))
                         .join(F.broadcast(vectors), "term")  # bounded by the templates
                         .groupBy("unit", "id", "path", "line", "square", "template", "licence")
                         .agg(F.sum(F.col("own_weight") * F.col("weight")).alias("dot"))
                         .where(F.col("dot") >= F.lit(threshold) * F.sqrt("square") - F.lit(1e-5) * F.sqrt("square")), "close")
    counts = (measured.join(close.select("unit").distinct(), "unit", "left_semi").select("unit", F.explode("terms").alias("term"))
              .groupBy("unit", "term").agg(F.count(F.lit(1)).alias("n")))
    common = seen.where(F.col("df") >= F.lit(spread["all"] or 0) / COMMON_TERMS)
    met = counts.join(F.broadcast(common), "term", "left")
    rest = met.where(F.col("df").isNull()).drop("df").join(seen, "term")
    term_idf = F.log(F.lit(1.0 + total) / (F.col("df") + 1)) + 1
    norms = (met.where(F.col("df").isNotNull()).unionByName(rest).groupBy("unit")
             .agg(F.sqrt(F.sum(F.pow(F.col("n") * term_idf, F.lit(2.0)))).alias("norm")))
    cosine = (close.join(norms, "unit").withColumn("score", F.round(F.col("dot") / F.col("norm"), 6))
              .where(F.col("score") >= threshold))
    best = F.min_by(F.struct("licence", "score", "line"), F.struct(-F.col("score"), "line", "licence", "template")).alias("b")
    own = shared_table(cosine.groupBy("id", "path").agg(best).select("id", "path", "b.*"), "own")

    folder = F.when(F.instr("path", "/") > 0, F.regexp_replace("path", "/[^/]*$", "")).otherwise(F.when(F.col("path").isNotNull(), ""))
    by_folder = (own.withColumn("folder", folder).where(F.col("folder").isNotNull()).groupBy("folder")
                 .agg(F.min_by("licence", F.struct(-F.col("score"), "path", "line")).alias("inherited")))
    placed = rows.select("id", "path").withColumn("folder", folder)
    parts = F.split("folder", "/")
    chain = F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")))
    nearest = (placed.select("folder").where(F.col("folder").isNotNull()).distinct()
               .select("folder", F.posexplode(F.array_distinct(chain)).alias("depth", "ancestor"))
               .join(by_folder.withColumnRenamed("folder", "ancestor"), "ancestor")
               .groupBy("folder").agg(F.max(F.struct("depth", "ancestor", "inherited")).alias("up")))
    found = own.select(F.col("id").alias("own_id"), F.col("path").alias("own_path"), "licence", "score", "line")
    out = (placed.join(found, F.col("id").eqNullSafe(F.col("own_id")) & F.col("path").eqNullSafe(F.col("own_path")), "left")
           .join(nearest, "folder", "left"))
    return out.select("id", "path", F.coalesce("licence", "up.inherited").alias("licence"), "score", "line",
                      F.when(F.col("licence").isNotNull(), F.col("path")).otherwise(F.col("up.ancestor")).alias("declared_in"))
