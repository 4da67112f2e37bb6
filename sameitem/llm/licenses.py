"""Operator 6: licence scan by sparse TF-IDF cosine, with inheritance along directories.

Only DataFrame functions.  Files are rows of a path and a text.  Every line of a
file (a possible licence header) and every possible licence file as a whole
becomes a sparse TF-IDF vector; its cosine to each template's vector says which
licence it states, from :data:`HEADER_COSINE` (lines) or :data:`FILE_COSINE`
(files) on.  A file whose name or whole text is a licence's covers its
directory; a file that states no licence itself inherits that of its nearest
ancestor directory, by joins on paths.

Weights: a term's inverse document frequency is counted over all scanned files
(:func:`corpus_weights`) in whole bits, ``bit_length((1 + n) // (1 + files with the
term))``, so the words of every text weigh next to nothing beside a licence's own.
So that a handful of files, most of them licences, doesn't make a licence's words
common, :data:`PRIOR_FILES` more files count as if each held just :data:`COMMON`.
A term of no template counts as held by no file, its greatest weight: such terms
only lengthen a unit's vector, so prose comes no nearer to a licence.

No line or text is left out by its words.  :func:`may_reach` bounds a unit's cosine
from above within its row, and only units whose bound stays below the threshold
are not scored against the templates.

Defined cases: null and empty texts state nothing; a file that states several
licences has the one of the greatest cosine, then the least name; two licence
files in a directory: greatest cosine, then least path; rows of one path are one
file; a null source or lang is the directory ``unknown``; an empty table gives
no rows; columns other than ``doc_id, source, lang, text`` are not read.

Scale: terms are counted within the row, so neither texts nor their terms are
shuffled, but for rows of one path with different texts, whose terms meet in a
groupBy.  Equal lines are scored once.  Directories, not files, look up their ancestors, so a directory
with a third of all files is one row there; the join back has plain exchanges on
both sides, which adaptive execution can split.  Only the templates' terms (fixed
here, a few kB) are broadcast, and only their counts (one a term) reach the driver.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sameitem.llm.common import stage, table

HEADER_COSINE = 0.6
FILE_COSINE = 0.5
WORD = r"[a-z0-9]+(?:\.[0-9]+)*"
FILE_NAMES = r"(?i)(^|/)(licen[cs]es?|copying|notice|unlicense)([._-][^/]*)?$"

#: Files assumed beside those scanned; their share vanishes as the corpus grows.
PRIOR_FILES = 1024
# English words that any text holds.
COMMON = tuple(("a all an and any are as at be but by can for from have if in into is it its may must no not of on or other out "
                "shall such that the their this to use was which will with work you").split())

# How licences are stated, by SPDX identifier.
TEMPLATES = (
    ("MIT", "Released under the MIT License"),
    ("MIT", "MIT License"),
    ("MIT", "Licensed under the MIT license"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the Software), to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met"),
    ("ISC", "Licensed under the ISC License"),
    ("CC0-1.0", "Released into the public domain under CC0 1.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0"),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("MIT", "MIT License. Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
            "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
            "this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "
            "\"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
            "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS "
            "BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
            "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                     "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
                     "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
                     "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
                     "with the distribution."),
    ("BSD-3-Clause", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
                     "disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
                     "the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the "
                     "name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
                     "from this software without specific prior written permission."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                   "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required "
                   "by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" "
                   "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
                   "language governing permissions and limitations under the License."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
                "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later "
                "version."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
                "version."),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1"),
    ("CC0-1.0", "CC0 1.0 Universal. The person who associated a work with this deed has dedicated the work to the public domain by waiving "
                "all of his or her rights to the work worldwide under copyright law"),
    ("GFDL-1.3", "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation "
                 "License, Version 1.3"),
)


def words(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


@dataclass(frozen=True)
class Weights:
    """Inverse document frequency of each term of a template, and of a term in none."""

    idf: dict[str, float]
    other: float


def inverse_frequencies(templates: tuple = TEMPLATES) -> tuple[dict[str, float], float]:
    """Inverse document frequency of each term among the templates, and of a term in none."""
    seen = Counter(t for _, text in templates for t in set(words(text)))
    n = len(templates)
    return {t: math.log((1 + n) / (1 + c)) + 1 for t, c in seen.items()}, math.log(1 + n) + 1


#: Weights among the templates alone, for units without a corpus.
TEMPLATE_WEIGHTS = Weights(*inverse_frequencies())


def corpus_weights(files: DataFrame, text: str = "text") -> Weights:
    """Weights by the number of rows that hold each term, over all rows with a text and the assumed files."""
    names = sorted(TEMPLATE_WEIGHTS.idf)
    files = files.where(F.col(text).isNotNull())
    held = F.array_intersect(terms(F.col(text)), F.array(*[F.lit(t) for t in names]))
    # The empty term stands for the row itself; one row a term reaches the driver.
    seen = {r["term"]: r["count"] for r in files.select(F.explode(F.concat(F.array(F.lit("")), held)).alias("term"))
            .groupBy("term").count().collect()}
    n = 1 + PRIOR_FILES + seen.get("", 0)
    most = {t: 1 + seen.get(t, 0) + PRIOR_FILES * (t in COMMON) for t in names}
    return Weights({t: float((n // most[t]).bit_length()) for t in names}, float(n.bit_length()))


def template_vectors(templates: tuple = TEMPLATES, weights: Weights = TEMPLATE_WEIGHTS) -> list[dict[str, float]]:
    """TF-IDF vectors of length 1."""
    out = []
    for _, text in templates:
        v = {t: c * weights.idf[t] for t, c in Counter(words(text)).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        out.append({t: x / norm for t, x in v.items()})
    return out


def cosines(spark: SparkSession, units: DataFrame, key: str, text: str, by: Weights = TEMPLATE_WEIGHTS) -> DataFrame:
    """Best licence of each unit: ``key, license, cosine`` (units that share no term with a template are left out)."""
    weights = spark.createDataFrame([(t, w) for t, w in sorted(by.idf.items())], "term string, idf double")
    vectors = spark.createDataFrame(
        [(k, TEMPLATES[k][0], t, w) for k, v in enumerate(template_vectors(weights=by)) for t, w in sorted(v.items())],
        "template int, license string, term string, share double")
    tf = (units.select(key, F.explode(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))).alias("term"))
          .groupBy(key, "term").count()
          .join(F.broadcast(weights), "term", "left")
          .withColumn("weight", F.col("count") * F.coalesce("idf", F.lit(by.other))))
    norm = tf.groupBy(key).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    dot = (tf.join(F.broadcast(vectors), "term").groupBy(key, "template", "license")
           .agg(F.sum(F.col("weight") * F.col("share")).alias("dot")))
    scored = dot.join(norm, key).withColumn("cosine", F.round(F.col("dot") / F.col("norm"), 9))
    return (scored.groupBy(key).agg(F.min(F.struct((-F.col("cosine")).alias("c"), "license")).alias("best"))
            .select(key, F.col("best.license").alias("license"), (-F.col("best.c")).alias("cosine")))


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def _by_term(term: Column, values: dict[str, float], other: float) -> Column:
    """``values[term]`` as a few look-ups in sets of terms of equal value."""
    groups: dict[float, list[str]] = {}
    for t, x in sorted(values.items()):
        groups.setdefault(round(x, 12), []).append(t)
    out = F.when(~term.isin(sorted(values)), F.lit(other))
    *first, (last, _) = sorted(groups.items(), key=lambda g: -len(g[1]))
    for x, names in first:
        out = out.when(term.isin(names), F.lit(x))
    return out.otherwise(F.lit(last))


def square_norm(terms: Column, by: Weights = TEMPLATE_WEIGHTS) -> Column:
    """Square of the TF-IDF vector's length: the k-th occurrence of a term adds ``(2k - 1) idf^2``."""
    squares = {w: x * x for w, x in by.idf.items()}
    zero = F.struct(F.lit("").alias("t"), F.lit(0).alias("k"), F.lit(0.0).alias("s"))

    def add(acc: Column, t: Column) -> Column:
        k = F.when(acc["t"] == t, acc["k"] + 1).otherwise(F.lit(1))
        return F.struct(t.alias("t"), k.alias("k"), (acc["s"] + (2 * k - 1) * _by_term(t, squares, by.other * by.other)).alias("s"))

    return F.aggregate(F.array_sort(terms), zero, add, lambda acc: acc["s"])


def reach(known: Column, by: Weights = TEMPLATE_WEIGHTS) -> Column:
    """At least the dot product with any template, from the terms that templates have."""
    most: dict[str, float] = {}
    for v in template_vectors(weights=by):
        for t, x in v.items():
            most[t] = max(most.get(t, 0.0), by.idf[t] * x)
    # In steps of a 64th, upwards, so that few look-ups tell them apart.
    most = {t: math.ceil(x * 64) / 64 for t, x in most.items()}
    return F.aggregate(known, F.lit(0.0), lambda acc, t: acc + _by_term(t, most, 0.0))


def may_reach(units: DataFrame, text: str, cosine: float, always: Column | None = None,
              by: Weights = TEMPLATE_WEIGHTS) -> DataFrame:
    """``units`` with ``known, square``, without those whose cosine to every template is below ``cosine``.

    A unit's dot product with a template is at most :func:`reach`.  Its length is
    at least that of as many different terms without a template (and is then
    taken exactly), so what goes is below the threshold whatever the template.
    """
    least = (cosine - 1e-6) ** 2
    always = F.lit(False) if always is None else always

    def lone(x: Column) -> Column:
        return (F.size(x["terms"]) - F.size(x["known"])) * by.other ** 2 + F.size(x["known"]) * min(by.idf.values()) ** 2

    # Lambda variables, so that each step is taken once a unit.
    found = F.transform(F.array(terms(F.col(text))), lambda t: F.struct(
        t.alias("terms"), F.filter(t, lambda w: w.isin(sorted(by.idf))).alias("known")))
    found = F.transform(F.filter(found, lambda x: F.size(x["known"]) > 0), lambda x: F.struct(
        x["terms"].alias("terms"), x["known"].alias("known"), reach(x["known"], by).alias("reach")))
    found = F.filter(found, lambda x: always | (x["reach"] * x["reach"] >= lone(x) * least))
    found = F.transform(found, lambda x: F.struct(
        x["known"].alias("known"), x["reach"].alias("reach"), square_norm(x["terms"], by).alias("square")))
    found = F.filter(found, lambda x: always | (x["reach"] * x["reach"] >= x["square"] * least))
    return units.select("*", F.inline(found)).drop("reach")


def row_cosines(spark: SparkSession, units: DataFrame, key: str, by: Weights = TEMPLATE_WEIGHTS) -> DataFrame:
    """As :func:`cosines`, from the ``known`` and ``square`` of :func:`may_reach`; each key is one row."""
    vectors = spark.createDataFrame(
        [(k, TEMPLATES[k][0], t, x * by.idf[t]) for k, v in enumerate(template_vectors(weights=by)) for t, x in sorted(v.items())],
        "template int, license string, term string, part double")
    dot = (units.select(key, "square", F.explode("known").alias("term")).join(F.broadcast(vectors), "term")
           .groupBy(key, "template", "license").agg(F.sum("part").alias("dot"), F.first("square").alias("square")))
    scored = dot.withColumn("cosine", F.round(F.col("dot") / F.sqrt("square"), 9))
    return (scored.groupBy(key).agg(F.min(F.struct((-F.col("cosine")).alias("c"), "license")).alias("best"))
            .select(key, F.col("best.license").alias("license"), (-F.col("best.c")).alias("cosine")))


def scan(spark: SparkSession, files: DataFrame, header_cosine: float = HEADER_COSINE,
         file_cosine: float = FILE_COSINE) -> DataFrame:
    """What each file states itself: ``path, license, cosine, covers`` (``covers``: a licence file)."""
    by = corpus_weights(files)
    named = F.col("path").rlike(FILE_NAMES)
    lines = files.select("path", F.explode(F.split("text", "\n")).alias("line"))
    lines = stage(spark, may_reach(lines, "line", header_cosine, by=by).distinct(), "licence-lines")
    scored = stage(spark, row_cosines(spark, lines.select("line", "known", "square").dropDuplicates(["line"]), "line", by)
                   .where(F.col("cosine") >= header_cosine), "licence-scores")
    header = lines.join(scored, "line").select("path", "license", "cosine", F.lit(False).alias("covers"))
    # Different texts of one path are one file: their terms are counted together.
    mixed = (files.groupBy("path").agg(F.min(F.xxhash64("text")).alias("a"), F.max(F.xxhash64("text")).alias("b"))
             .where("a <> b").select("path"))
    mixed = stage(spark, mixed, "licence-paths")
    alone = may_reach(files.select("path", "text"), "text", file_cosine, named, by).select("path", "known", "square")
    alone = row_cosines(spark, alone.join(mixed, "path", "left_anti").dropDuplicates(["path"]), "path", by)
    together = cosines(spark, files.join(mixed, "path", "left_semi").select("path", "text").distinct(), "path", "text", by)
    whole = alone.unionByName(together)
    cover = whole.where((F.col("cosine") >= file_cosine) | named).select("path", "license", "cosine", F.lit(True).alias("covers"))
    # A licence file's own statement is that of its whole text, unless a line says it more clearly.
    both = header.unionByName(cover).withColumn("any_cover", F.max("covers").over(Window.partitionBy("path")))
    return (both.withColumn("nth", F.row_number().over(Window.partitionBy("path").orderBy(-F.col("cosine"), "license")))
            .where("nth = 1").select("path", "license", "cosine", F.col("any_cover").alias("covers")))


def parent(path: Column) -> Column:
    """Directory of a path (the root is the empty string)."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def ancestors(directory: Column) -> Column:
    """A directory and all above it, the root (empty) included."""
    parts = F.split(directory, "/")
    return F.when(directory == "", F.array(F.lit(""))).otherwise(F.concat(
        F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/")), F.array(F.lit(""))))


def inherit(spark: SparkSession, files: DataFrame, stated: DataFrame) -> DataFrame:
    """``directory, license, cosine, from_path`` of every directory with a licence file in it or above it."""
    own = (stated.where("covers").withColumn("directory", parent(F.col("path")))
           .groupBy("directory").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "path", "license")).alias("best")))
    own = stage(spark, own.select(F.col("directory").alias("above"), F.col("best.license").alias("license"),
                                  (-F.col("best.c")).alias("cosine"), F.col("best.path").alias("from_path")), "licence-directories")
    each = (files.select(parent(F.col("path")).alias("directory")).distinct()
            .withColumn("above", F.explode(ancestors(F.col("directory")))))
    return (each.join(own, "above").groupBy("directory")
            .agg(F.max(F.struct(F.length("above").alias("depth"), "license", "cosine", "from_path")).alias("near"))
            .select("directory", "near.license", "near.cosine", "near.from_path"))


def licenses(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Licence of every row of ``files`` (``path, text``, other columns kept but for these two results' names).

    Adds ``license, basis, cosine, from_path``; ``basis`` is ``file``, ``header``, ``inherited`` or ``none``.
    """
    stated = stage(spark, scan(spark, files), "licence-stated")
    near = stage(spark, inherit(spark, files, stated), "licence-inherited")
    own = stated.select("path", F.col("license").alias("own"), F.col("cosine").alias("own_cosine"), "covers")
    given = near.select("directory", F.col("license").alias("given"), F.col("cosine").alias("given_cosine"),
                        F.col("from_path").alias("given_path"))
    rows = (files.drop("text").withColumn("directory", parent(F.col("path")))
            .join(own, "path", "left").join(given, "directory", "left").drop("directory"))
    stated_here = F.col("own").isNotNull()
    return (rows.withColumn("license", F.coalesce("own", "given"))
            .withColumn("basis", F.when(stated_here & F.col("covers"), "file").when(stated_here, "header")
                        .when(F.col("given").isNotNull(), "inherited").otherwise("none"))
            .withColumn("cosine", F.coalesce("own_cosine", "given_cosine"))
            .withColumn("from_path", F.when(stated_here, F.col("path")).otherwise(F.col("given_path")))
            .drop("own", "own_cosine", "covers", "given", "given_cosine", "given_path"))


#: Documents of one directory.
DIRECTORY_DOCS = 16


def document_files(docs: DataFrame) -> DataFrame:
    """``doc_id, path, text``: documents as files ``source/lang/number/doc_id.txt``."""
    folder = F.floor(F.col("doc_id") / DIRECTORY_DOCS).cast("long")
    name = [F.coalesce(F.col(c).cast("string"), F.lit("unknown")) for c in ("source", "lang")]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.concat_ws(
        "/", *name, F.coalesce(folder.cast("string"), F.lit("unknown")),
        F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("unknown")), F.lit(".txt"))).alias("path"), "text")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = licenses(spark, document_files(table(spark, sf_dir, "documents")))
    return rows.select("doc_id", "path", "license", "basis", "cosine", "from_path")


def _values(rows) -> str:
    return ", ".join("(" + ", ".join("'" + x.replace("'", "''") + "'" if isinstance(x, str) else repr(x) for x in r) + ")" for r in rows)


def oracle() -> str:
    """The same result in DuckDB: every line and text scored, and every path's ancestors joined plainly."""
    templates = _values((k, s, t) for k, (s, t) in enumerate(TEMPLATES))
    pattern = WORD.replace("'", "''")
    common = ", ".join(f"'{t}'" for t in COMMON)

    def best(units: str) -> str:
        return f"""(with tf as (select u, term, count(*) * coalesce(any_value(idf), (select length(bin(n)) from texts)) as w
            from (select u, unnest(regexp_extract_all(lower(body), '{pattern}')) as term from {units}) left join idf using (term)
            group by u, term),
          norm as (select u, sqrt(sum(w * w)) as n from tf group by u),
          dot as (select u, license, sum(w * share) as d from tf join vectors using (term) group by u, template, license)
          select u, license, c from (select u, license, c, row_number() over (partition by u order by c desc, license) as k
            from (select u, license, round(d / n, 9) as c from dot join norm using (u))) where k = 1)"""

    return f"""
with templates as (select * from (values {templates}) t(template, license, body)),
tterm as (select template, license, term, count(*) as n from (
  select template, license, unnest(regexp_extract_all(lower(body), '{pattern}')) as term from templates) group by all),
texts as (select 1 + {PRIOR_FILES} + count(*) as n from documents where text is not null),
held as (select term, count(distinct r) as df from (
  select r, unnest(regexp_extract_all(lower(text), '{pattern}')) as term
  from (select row_number() over () as r, text from documents where text is not null)) where term in (select term from tterm) group by term),
idf as (select term, cast(length(bin((select n from texts) // (1 + coalesce(df, 0) + if(term in ({common}), {PRIOR_FILES}, 0)))) as double) as idf
  from (select distinct term from tterm) left join held using (term)),
vectors as (select template, license, term, n * idf / sqrt(sum(n * idf * n * idf) over (partition by template)) as share
  from tterm join idf using (term)),
files as (select doc_id, concat_ws('/', coalesce(source, 'unknown'), coalesce(lang, 'unknown'),
    coalesce(cast(cast(floor(doc_id / {DIRECTORY_DOCS}.0) as bigint) as varchar), 'unknown'),
    coalesce(cast(doc_id as varchar), 'unknown') || '.txt') as path, text from documents),
lines as (select distinct path, unnest(string_split(text, chr(10))) as body from files),
lunit as (select distinct body as u, body from lines where body is not null),
lbest as {best("lunit")},
header as (select path, license, c, false as covers from lines join lbest on body = u where c >= {HEADER_COSINE}),
funit as (select distinct path as u, text as body from files where text is not null),
fbest as {best("funit")},
cover as (select u as path, license, c, true as covers from fbest where c >= {FILE_COSINE}),
stated as (select path, license, c, any_cover as covers from (
  select path, license, c, max(covers) over (partition by path) as any_cover,
    row_number() over (partition by path order by c desc, license) as k from (select * from header union all select * from cover))
  where k = 1),
owns as (select above, license, c, path as from_path from (
  select regexp_replace(path, '/[^/]*$', '') as above, license, c, path,
    row_number() over (partition by regexp_replace(path, '/[^/]*$', '') order by c desc, path) as k from stated where covers) where k = 1),
given as (select path, license, c, from_path from (
  select f.path, o.license, o.c, o.from_path, row_number() over (partition by f.path order by length(above) desc) as k
  from (select distinct path from files) f join owns o on starts_with(f.path, above || '/')) where k = 1)
select doc_id, f.path as path, coalesce(s.license, g.license) as license,
  case when s.license is not null and s.covers then 'file' when s.license is not null then 'header'
       when g.license is not null then 'inherited' else 'none' end as basis,
  coalesce(s.c, g.c) as cosine, case when s.license is not null then f.path else g.from_path end as from_path
from files f left join stated s on f.path = s.path left join given g on f.path = g.path
"""
