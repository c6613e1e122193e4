"""Column statistics: dates in particular, and any table in general."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import from_micros, to_micros
from .quantiles import exact_quantiles, has_quantiles, least_and_quantiles, typed

_QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def date_stats(mail: DataFrame, column: str = "date", rule: str = "nearest") -> DataFrame:
    """First date and first quartile of the dates, in one row.

    The quartile is a date that occurs: the one nearest to its rank, or with
    ``rule="discrete"`` the first that a quarter of all dates do not exceed.
    """
    return least_and_quantiles(mail, column, "min_date", {"quartile_date": 0.25}, rule)


def first_and_last(mail: DataFrame, column: str = "date") -> DataFrame:
    """Date of the first and of the last row in date order."""
    return mail.agg(F.min(column).alias("first_date"), F.max(column).alias("last_date"))


def profile(df: DataFrame, columns: Iterable[str] | None = None, rule: str = "nearest") -> DataFrame:
    """One row per column: count, nulls, mean, std, min, quartiles, max.

    Values are shown as text, as their types differ. Arrays and structs have
    counts only, text has no mean or quartiles. Counts, means and extremes are
    one aggregation over all columns; quartiles are exact, see
    :mod:`postroom.operators.quantiles`.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    names = list(columns) if columns is not None else list(types)
    stats = df.agg(*[_stats(n, types[n]).alias(f"s{i}") for i, n in enumerate(names)])
    rows = stats.select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(names))])))

    ranked = [n for n in names if has_quantiles(types[n])]
    if not ranked:
        return rows.select("*", *[F.lit(None).cast("string").alias(q) for q in _QUARTILES])
    found = exact_quantiles(df, ranked, _QUARTILES.values(), [rule])
    value = F.coalesce(
        *[F.when(F.col("column") == n, typed(types[n]).cast("string")) for n in ranked]
    )
    quartiles = (
        found.withColumn("value", value)
        .groupBy("column")
        .agg(
            *[
                F.max(F.when(F.col("prob") == p, F.col("value"))).alias(q)
                for q, p in _QUARTILES.items()
            ]
        )
    )
    # Both sides have one row per column.
    return rows.join(quartiles, "column", "left")


def _stats(name: str, dtype: T.DataType) -> Column:
    value = F.col(f"`{name}`")
    nothing = F.lit(None).cast("string")
    mean = std = low = high = nothing
    if isinstance(dtype, T.NumericType):
        mean, std = F.avg(value).cast("string"), F.stddev(value).cast("string")
    elif isinstance(dtype, T.TimestampNTZType):
        mean = from_micros(F.avg(to_micros(value).cast("decimal(20,0)")).cast("long")).cast("string")
    if isinstance(dtype, T.AtomicType) and not isinstance(dtype, T.BinaryType):
        low, high = F.min(value).cast("string"), F.max(value).cast("string")
    return F.struct(
        F.lit(name).alias("column"),
        F.count(value).alias("count"),
        F.count_if(value.isNull()).alias("nulls"),
        mean.alias("mean"),
        std.alias("std"),
        low.alias("min"),
        high.alias("max"),
    )
