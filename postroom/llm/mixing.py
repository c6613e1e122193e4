"""Mix sources to target weights by raking.

Documents are put in cells by source, language and topic, and a cell weighs its
tokens. Iterative proportional fitting scales the cells to the target share of
each source, then of each language, then of each topic, ``rounds`` times. A
document is kept with the probability of its cell, raked weight over token weight
times one factor, 1 at most. The factor is calibrated so that ``keep`` of all
tokens are expected; each of a few rounds gives what cells that are kept whole
can't take to the others. A hash of the id decides, so the sample is the same
however often it is drawn.

Targets are shares by value, or an exponent that flattens the measured shares.
Only cells are shuffled while raking. They are few beside the documents, and the
join back to the documents is left to Spark: it measures the cells before it
broadcasts them, and else splits what is skewed.

Nulls: a null source, language or topic is a value of its own; a null text has
no tokens; a null id is drawn like the text ``null``. Cells without tokens have
no weight, so their documents are dropped; ties and repeated rows share one
fate; values without a target, or with one of 0, are dropped. An empty table
gives an empty result. Further columns are kept by ``sample`` in the struct
``row``, so names can't clash.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import in_order, text_of, written

AXES = ("source", "lang", "topic")
FLATTEN = 0.7
ROUNDS = 8
#: Expected share of the tokens that stay.
KEEP = 0.6
CALIBRATIONS = 6

_WORD = r"[^\x20\x09-\x0D]+"


def topic_of(text: Column) -> Column:
    """A coarse topic by marks in the text; give a column of your own for a finer one."""
    return (
        F.when(F.contains(text, F.lit(" | ")), "listing")
        .when(F.contains(F.lower(text), F.lit("licen")), "legal")
        .when(F.contains(text, F.lit("@")), "contact")
        .otherwise("prose")
    )


def _share(axis: str, target: float | Mapping[str, float], weight: Column) -> Column:
    """The target weight of this row's value on one axis, not yet normed."""
    if isinstance(target, Mapping):
        named = F.lit(0.0)
        for value, part in target.items():
            named = F.when(F.col(axis).eqNullSafe(F.lit(value)), F.lit(float(part))).otherwise(named)
        return named
    return F.pow(weight, F.lit(float(target)))


def rake(
    cells: DataFrame,
    targets: Mapping[str, float | Mapping[str, float]] | None = None,
    rounds: int = ROUNDS,
    keep: float = KEEP,
) -> DataFrame:
    """Cells (axes, tokens) with their raked weight and probability."""
    targets = targets or {}
    start = cells.withColumn("raked", F.col("tokens").cast("double"))
    for axis in AXES:
        own = F.sum(F.col("tokens").cast("double")).over(Window.partitionBy(axis))
        start = start.withColumn(f"want_{axis}", _share(axis, targets.get(axis, FLATTEN), own))
    fixed = written(start, "cells")
    # Target shares count each value once; three numbers come back.
    norms = []
    for axis in AXES:
        values = fixed.groupBy(axis).agg(F.first(f"want_{axis}").alias("w"))
        norms.append((values.agg(F.sum("w")).first() or [0.0])[0] or 0.0)
    for _ in range(rounds):
        for axis, norm in zip(AXES, norms):
            whole = F.sum("raked").over(Window.partitionBy(axis))
            share = F.col(f"want_{axis}") / F.lit(norm or 1.0)
            fixed = fixed.withColumn(
                "raked", F.when(whole > 0, F.col("raked") * share / whole).otherwise(0.0)
            )
    raked = written(fixed, "raked")
    ratio = F.when(F.col("tokens") > 0, F.col("raked") / F.col("tokens")).otherwise(0.0)
    raked = raked.withColumn("ratio", ratio)
    factor = 0.0
    for k in range(CALIBRATIONS):  # two or three numbers come back each time
        whole = F.lit(factor) * F.col("ratio") >= 1
        sums = raked.agg(
            F.sum(F.col("tokens").cast("double")).alias("all"),
            F.sum(F.when(whole, F.col("tokens").cast("double")).otherwise(0.0)).alias("whole"),
            F.sum(F.when(~whole, F.col("raked")).otherwise(0.0)).alias("rest"),
        ).first()
        if not sums or not sums["rest"]:
            break
        factor = max(factor, (keep * sums["all"] - sums["whole"]) / sums["rest"])
    probability = F.least(F.lit(1.0), F.lit(factor) * F.col("ratio"))
    return raked.select(*AXES, "tokens", "raked", probability.alias("probability"))


def draw(doc_id: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the id only."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def sample(
    docs: DataFrame,
    targets: Mapping[str, float | Mapping[str, float]] | None = None,
    seed: str = "mix",
    rounds: int = ROUNDS,
    topic: Column | None = None,
    keep: float = KEEP,
) -> DataFrame:
    """``row`` (the input row), topic, tokens, probability and kept."""
    text = text_of()
    marked = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("source"),
        F.col("lang"),
        (topic_of(text) if topic is None else topic).alias("topic"),
        F.regexp_count(text, F.lit(_WORD)).cast("long").alias("tokens"),
    )
    cells = rake(marked.groupBy(*AXES).agg(F.sum("tokens").alias("tokens")), targets, rounds, keep)
    cells = cells.select(*[F.col(a).alias(f"cell_{a}") for a in AXES], "probability")
    same = [F.col(a).eqNullSafe(F.col(f"cell_{a}")) for a in AXES]
    return marked.join(cells, same[0] & same[1] & same[2]).select(
        "row",
        "topic",
        "tokens",
        "probability",
        (draw(F.col("row.doc_id"), seed) < F.col("probability")).alias("kept"),
    )


def op3_mix(documents: DataFrame) -> DataFrame:
    docs = in_order(documents, "doc_id", "text", "source", "lang")
    drawn = sample(docs)
    return drawn.select(
        "row.doc_id",
        "row.source",
        "row.lang",
        "topic",
        "tokens",
        F.round("probability", 6).alias("probability"),
        "kept",
    )


def _op3_sql() -> str:
    same = " AND ".join(f"m.{a} IS NOT DISTINCT FROM c.{a}" for a in AXES)
    ctes = [
        rf"""marked AS (
  SELECT doc_id, source, lang,
    CASE WHEN contains(t, ' | ') THEN 'listing' WHEN contains(lower(t), 'licen') THEN 'legal'
      WHEN contains(t, '@') THEN 'contact' ELSE 'prose' END AS topic,
    len(regexp_extract_all(t, '{_WORD}'))::BIGINT AS tokens
  FROM (SELECT *, coalesce(text, '') AS t FROM documents))""",
        """step0 AS (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens,
  sum(tokens)::DOUBLE AS raked FROM marked GROUP BY ALL)""",
    ]
    for a in AXES:
        ctes.append(
            f"""want_{a} AS (SELECT {a}, sum(tokens) ** {FLATTEN} AS w FROM step0 GROUP BY {a})"""
        )
    n = 0
    for _ in range(ROUNDS):
        for a in AXES:
            ctes.append(
                f"""step{n + 1} AS MATERIALIZED (SELECT s.source, s.lang, s.topic, s.tokens,
  CASE WHEN sum(raked) OVER v > 0 THEN raked * (w / (SELECT sum(w) FROM want_{a}))
    / sum(raked) OVER v ELSE 0 END AS raked
  FROM step{n} s JOIN want_{a} t ON s.{a} IS NOT DISTINCT FROM t.{a}
  WINDOW v AS (PARTITION BY s.{a}))"""
            )
            n += 1
    ctes.append(
        f"""cells AS MATERIALIZED (SELECT source, lang, topic, tokens, raked,
  CASE WHEN tokens > 0 THEN raked / tokens ELSE 0 END AS ratio FROM step{n}),
factor0 AS (SELECT 0.0::DOUBLE AS f)"""
    )
    for k in range(CALIBRATIONS):
        ctes.append(
            f"""factor{k + 1} AS MATERIALIZED (SELECT greatest(any_value(f), coalesce(
  ({KEEP} * sum(tokens) - sum(CASE WHEN f * ratio >= 1 THEN tokens ELSE 0 END))
  / nullif(sum(CASE WHEN f * ratio < 1 THEN raked ELSE 0 END), 0), 0)) AS f
  FROM cells, factor{k})"""
        )
    return (
        "WITH "
        + ",\n".join(ctes)
        + f"""
SELECT m.doc_id, m.source, m.lang, m.topic, m.tokens,
  round(least(1.0, f * ratio), 6) AS probability,
  ('0x' || substr(md5('mix' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT / 4294967296.0
    < least(1.0, f * ratio) AS kept
FROM marked m JOIN cells c ON {same}, factor{CALIBRATIONS}
"""
    )


OP3_SQL = _op3_sql()
