"""Licence scan: TF-IDF cosine of sentences to templates, then inheritance by path.

Every sentence of a whole text (cut at line ends and after ``.``, ``!``, ``?``)
with a licence word is compared with the templates. Terms are lower-case runs of
letters, digits, dots and hyphens inside; a term counts once per sentence, weighted
by its rarity among the templates, ln((1 + N) / (1 + df)) + 1. The best template at
MIN_COSINE or more is the text's own licence. A short text that has one is a licence
file: it also covers its directory and what lies below. A text without an own licence
inherits from the nearest directory above it that has a licence file; of several
files in one directory the one with the best score counts, then the least name, then
the least path.

Vectors are sparse maps of the templates' terms, held as literals; everything is
column expressions and joins. Directories are made distinct before their ancestors
are listed, so a directory with a third of all texts is looked up once.

Nulls: a null text has no licence of its own; a null path is in no directory and
inherits nothing. Empty texts may inherit. Ties go to the least template name.
Repeated rows are judged each. An empty table gives an empty result. Further columns
are kept in the struct ``row``, so names can't clash.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_order, written

# Short notices by which licences are known.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "AGPL-3.0": (
        "This program is licensed under the GNU Affero General Public License, version 3.",
    ),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.",),
    "BSD-3-Clause": ("Released under the BSD 3-Clause License.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.",),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.",),
    "GPL-2.0": ("This program is licensed under the GNU General Public License, version 2.",),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.",),
    "LGPL-3.0": ("This library is licensed under the GNU Lesser General Public License, version 3.",),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy.",
    ),
    "MPL-2.0": ("Subject to the terms of the Mozilla Public License, Version 2.0.",),
    "Proprietary": ("All rights reserved.", "Copyright, all rights reserved."),
    "Public-Domain": ("This work is dedicated to the public domain.",),
}

#: A sentence without one of these is not compared.
CUE = r"licen[cs]e|copyright|rights reserved|permission is|public domain"
MIN_COSINE = 0.8
#: Words of a text that is a licence file if it has a licence of its own.
FILE_WORDS = 60

_TERM = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
_SPACE = r"[\x20\x09-\x0D]+"


def _vectors(templates: Mapping[str, tuple[str, ...]]) -> tuple[list[tuple[str, dict[str, float]]], dict[str, float], float]:
    """Unit vectors of the notices, weights of their terms, weight of any other term."""
    notices = [(n, set(re.findall(_TERM, t.lower()))) for n, texts in templates.items() for t in texts]
    df = Counter(t for _, terms in notices for t in terms)
    idf = {t: math.log((1 + len(notices)) / (1 + n)) + 1 for t, n in df.items()}
    out = []
    for name, terms in notices:
        size = math.sqrt(sum(idf[t] ** 2 for t in terms))
        out.append((name, {t: idf[t] / size for t in terms}))
    return out, idf, math.log(1 + len(notices)) + 1


def _map(values: Mapping[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for pair in sorted(values.items()) for x in pair])


def own_licence(text: Column, templates: Mapping[str, tuple[str, ...]] | None = None) -> Column:
    """The best (score, name) of a text's sentences, as a struct, or null."""
    vectors, idf, other = _vectors(templates or TEMPLATES)
    low = F.lower(F.coalesce(text, F.lit("")))
    sentences = F.split(F.regexp_replace(low, f"([.!?]){_SPACE}", "$1\n"), "\n")
    weights = _map(idf)

    def best(sentence: Column) -> Column:
        terms = F.array_distinct(F.regexp_extract_all(sentence, F.lit(f"({_TERM})"), F.lit(1)))
        square = F.aggregate(
            terms,
            F.lit(0.0),
            lambda acc, t: acc + F.pow(F.coalesce(F.try_element_at(weights, t), F.lit(other)), F.lit(2.0)),
        )
        def product(vector: Mapping[str, float]) -> Column:
            values = _map(vector)
            return F.aggregate(
                terms,
                F.lit(0.0),
                lambda acc, t: acc
                + F.coalesce(F.try_element_at(values, t), F.lit(0.0))
                * F.coalesce(F.try_element_at(weights, t), F.lit(other)),
            )

        scores = []
        for name, vector in vectors:
            # Rounded, so that equal cosines tie whatever the order of the sum.
            score = F.round(product(vector) / F.sqrt(square), 6)
            scores.append(F.struct((-score).alias("minus"), F.lit(name).alias("name")))
        return F.array_min(F.array(*scores))

    cued = F.filter(sentences, lambda s: s.rlike(CUE))
    found = F.array_min(F.transform(cued, best))
    found = F.when(low.rlike(CUE), found)
    return F.when(
        found["minus"] <= -MIN_COSINE,
        F.struct((-found["minus"]).alias("score"), found["name"].alias("name")),
    )


def directory_of(path: Column) -> Column:
    """The path without its last part; the root's own directory is empty."""
    return F.regexp_replace(path, "(^|/)[^/]*$", "")


def scan_licences(
    files: DataFrame,
    path: Column,
    text: str = "text",
    is_licence_file: Column | None = None,
    templates: Mapping[str, tuple[str, ...]] | None = None,
) -> DataFrame:
    """``row`` (the input row), path, own_licence, own_score, licence, origin, from_dir.

    ``origin`` is ``own``, ``directory`` or null; ``from_dir`` the directory that a
    licence was inherited from.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    short = F.regexp_count(body, F.lit(r"[^\x20\x09-\x0D]+")) <= FILE_WORDS
    judged = files.select(
        F.struct(*[F.col(f"`{c}`") for c in files.columns if c != text]).alias("row"),
        path.alias("path"),
        own_licence(F.col(f"`{text}`"), templates).alias("own"),
        (short if is_licence_file is None else is_licence_file).alias("is_file"),
    ).withColumn("dir", directory_of(F.col("path")))
    judged = written(judged, "own-licences")

    # The best file of a directory: least (-score, name, path).
    covers = judged.where("is_file AND own IS NOT NULL AND path IS NOT NULL").groupBy("dir").agg(
        F.min(F.struct((-F.col("own.score")).alias("minus"), "own.name", "path")).alias("file")
    )
    covers = covers.select(F.col("dir").alias("above"), F.col("file.name").alias("covered_by"))
    lacking = judged.where("own IS NULL AND path IS NOT NULL").select("dir").distinct()
    parts = F.split("dir", "/")
    above = F.transform(
        F.sequence(F.lit(0), F.size(parts)),
        lambda n: F.array_join(F.slice(parts, 1, n), "/"),
    )
    # The root is one directory of all; each other ancestor is listed once per directory.
    chains = lacking.select("dir", F.explode(F.array_distinct(above)).alias("above"))
    nearest = chains.join(covers, "above").groupBy("dir").agg(
        F.max(F.struct(F.length("above").alias("depth"), "above", "covered_by")).alias("near")
    )
    inherited = nearest.select("dir", F.col("near.above").alias("from_dir"), F.col("near.covered_by").alias("covered_by"))
    lack = F.col("own").isNull()
    return judged.join(inherited, "dir", "left").select(
        "row",
        "path",
        F.col("own.name").alias("own_licence"),
        F.col("own.score").alias("own_score"),
        F.when(lack, F.col("covered_by")).otherwise(F.col("own.name")).alias("licence"),
        F.when(~lack, "own").when(F.col("covered_by").isNotNull(), "directory").alias("origin"),
        F.when(lack, F.col("from_dir")).alias("from_dir"),
    )


def document_path(source: Column, lang: Column, doc_id: Column) -> Column:
    """A path for a table without any: source, language, then the id's digits as folders."""
    digits = F.regexp_replace(doc_id.cast("string"), "(.)(?=.)", "$1/")
    return F.concat_ws("/", F.coalesce(source, F.lit("-")), F.coalesce(lang, F.lit("-")), digits)


def op10_licence_scan(documents: DataFrame) -> DataFrame:
    docs = in_order(documents, "doc_id", "text", "source", "lang")
    path = document_path(F.col("source"), F.col("lang"), F.col("doc_id"))
    found = scan_licences(docs, F.when(F.col("doc_id").isNotNull(), path))
    return found.select(
        "row.doc_id", "path", "own_licence", "own_score", "licence", "origin", "from_dir"
    )


def _op10_sql() -> str:
    notices = ",\n    ".join(
        f"('{n}', '{t}')" for n, texts in TEMPLATES.items() for t in texts
    )
    return rf"""
WITH notices AS (
  SELECT row_number() OVER () AS k, name, list_distinct(regexp_extract_all(lower(t), '{_TERM}')) AS terms
  FROM (VALUES
    {notices}) v(name, t)
), n AS (SELECT count(*) AS n FROM notices),
idf AS (
  SELECT term, ln((1 + (SELECT n FROM n)) / (1 + count(*))) + 1 AS w
  FROM (SELECT unnest(terms) AS term FROM notices) GROUP BY term
), vectors AS (
  SELECT k, name, term, w / sqrt(sum(w * w) OVER (PARTITION BY k)) AS v
  FROM (SELECT k, name, unnest(terms) AS term FROM notices) JOIN idf USING (term)
), docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
    CASE WHEN doc_id IS NOT NULL THEN concat_ws('/', coalesce(source, '-'), coalesce(lang, '-'),
      array_to_string(string_split(doc_id::VARCHAR, ''), '/')) END AS path
  FROM documents
), sentences AS (
  SELECT r, row_number() OVER () AS s, list_distinct(regexp_extract_all(line, '{_TERM}')) AS terms
  FROM (SELECT r, unnest(string_split(regexp_replace(lower(t), '([.!?]){_SPACE}', '\1' || chr(10), 'g'), chr(10))) AS line
        FROM docs)
  WHERE regexp_matches(line, '{CUE}')
), weighted AS (
  SELECT r, s, term, coalesce(w, ln(1 + (SELECT n FROM n)) + 1) AS w
  FROM (SELECT r, s, unnest(terms) AS term FROM sentences) LEFT JOIN idf USING (term)
), sizes AS (SELECT s, sqrt(sum(w * w)) AS size FROM weighted GROUP BY s),
cosines AS (
  SELECT r, s, k, name, round(sum(w * v) / any_value(size), 6) AS score
  FROM weighted JOIN sizes USING (s) JOIN vectors USING (term) GROUP BY r, s, k, name
), own AS (
  SELECT r, name AS own_licence, score AS own_score FROM cosines
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, name) = 1
), judged AS (
  SELECT d.r, doc_id, path, regexp_replace(path, '(^|/)[^/]*$', '') AS dir,
    CASE WHEN own_score >= {MIN_COSINE} THEN own_licence END AS own_licence,
    CASE WHEN own_score >= {MIN_COSINE} THEN own_score END AS own_score,
    len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) <= {FILE_WORDS} AS is_file
  FROM docs d LEFT JOIN own USING (r)
), covers AS (
  SELECT dir AS above, own_licence AS covered_by FROM judged
  WHERE is_file AND own_licence IS NOT NULL AND path IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY own_score DESC, own_licence, path) = 1
), inherited AS (
  SELECT r, above, covered_by FROM judged JOIN covers ON dir = above OR starts_with(dir, above || '/')
  WHERE judged.own_licence IS NULL
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY length(above) DESC) = 1
)
SELECT doc_id, path, own_licence, own_score, coalesce(own_licence, covered_by) AS licence,
  CASE WHEN own_licence IS NOT NULL THEN 'own' WHEN covered_by IS NOT NULL THEN 'directory' END AS origin,
  above AS from_dir
FROM judged LEFT JOIN inherited USING (r)
"""


OP10_SQL = _op10_sql()
