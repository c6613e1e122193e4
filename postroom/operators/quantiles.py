"""Exact quantiles of several columns from one scan.

The values of all columns become rows (column, value) and are counted, so what
goes on is one row per distinct value, however often it repeats. These rows are
put in order over range partitions and written once. Each partition gives one
total per column; running sums over those totals say in which partition a rank
lies, and only that partition is added up value by value. No task holds more
than a range partition, and the driver holds nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import from_micros, to_micros
from ..sinks.scratch import materialise, scratch_dir

#: Rank of quantile q among n values, counted from 0: the value nearest to
#: position q * (n - 1), or the first one with at least q * n values up to it.
RANK_RULES = {
    "nearest": lambda q, n: F.floor(q * (n - 1) + 0.5),
    "discrete": lambda q, n: F.greatest(F.ceil(q * n) - 1, F.lit(0)),
}

# A value is a whole number or a floating one; the other column is null, so the
# two together put the values of any one column in order.
_VALUE = ("whole", "floating")
_FLOATING = (T.FloatType, T.DoubleType)
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TIMES = (T.DateType, T.TimestampNTZType, T.TimestampType)


def has_quantiles(dtype: T.DataType) -> bool:
    """Whether quantiles of this type are supported."""
    return isinstance(dtype, (*_FLOATING, *_WHOLE, *_TIMES))


def ordered_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """column, whole, floating, n, part: distinct values in order, with their counts.

    Nulls are left out. ``part`` numbers the range partitions in order of columns
    and values. The table is written once and read from there.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    items = [F.struct(F.lit(c).alias("column"), *_value(c, types[c])) for c in columns]
    values = df.select(F.inline(F.array(*items))).where(F.coalesce(*_VALUE).isNotNull())
    counts = values.groupBy("column", *_VALUE).agg(F.count(F.lit(1)).alias("n"))
    ranged = counts.repartitionByRange("column", *_VALUE)
    ranged = ranged.withColumn("part", F.spark_partition_id())
    return materialise(ranged, f"{scratch_dir(df.sparkSession)}/counts")


def ranked_values(
    counts: DataFrame, probs: Iterable[float], rules: Iterable[str] = ("nearest",)
) -> DataFrame:
    """column, rule, prob, whole, floating: the value at each rank.

    A column without values has no rows.
    """
    probs = [float(p) for p in probs]
    totals = counts.groupBy("column", "part").agg(F.sum("n").alias("total"))
    # One row per column and partition.
    of_column = Window.partitionBy("column")
    before = of_column.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    all_of_column = F.sum("total").over(of_column)
    targets = F.array(
        *[
            F.struct(
                F.lit(rule).alias("rule"),
                F.lit(p).alias("prob"),
                RANK_RULES[rule](F.lit(p), all_of_column).cast("long").alias("rank"),
            )
            for rule in rules
            for p in probs
        ]
    )
    below = F.coalesce(F.sum("total").over(before), F.lit(0).cast("long"))
    placed = totals.select("column", "part", "total", below.alias("below"), targets.alias("targets"))
    placed = placed.select("*", F.inline("targets")).where(
        (F.col("rank") >= F.col("below")) & (F.col("rank") < F.col("below") + F.col("total"))
    )
    # At most columns x rules x probs rows: safe to broadcast.
    wanted = placed.groupBy("column", "part").agg(
        F.collect_list(F.struct("rule", "prob", (F.col("rank") - F.col("below")).alias("rank"))).alias("targets")
    )
    inside = Window.partitionBy("column", "part").orderBy(*_VALUE)
    running = counts.join(F.broadcast(wanted), ["column", "part"]).withColumn(
        "upto", F.sum("n").over(inside)
    )
    found = running.select("column", *_VALUE, "n", "upto", F.inline("targets"))
    hit = (F.col("rank") >= F.col("upto") - F.col("n")) & (F.col("rank") < F.col("upto"))
    return found.where(hit).select("column", "rule", "prob", *_VALUE)


def exact_quantiles(
    df: DataFrame,
    columns: Iterable[str],
    probs: Iterable[float],
    rules: Iterable[str] = ("nearest",),
) -> DataFrame:
    """Quantiles of several columns by several rules as rows; :func:`typed` gives
    a value its column's type back."""
    return ranked_values(ordered_counts(df, columns), probs, rules)


def quantile_rows(
    df: DataFrame, column: str, probs: Mapping[str, float], rules: Iterable[str] = ("nearest",)
) -> DataFrame:
    """One row per rule: the rule, and the named quantiles in the column's own type."""
    dtype = df.schema[column].dataType
    found = exact_quantiles(df, [column], probs.values(), rules)
    return found.groupBy("rule").agg(*_named(probs, dtype))


def quantile_row(
    df: DataFrame, column: str, probs: Mapping[str, float], rule: str = "nearest"
) -> DataFrame:
    """The named quantiles of one column as one row, nulls when it has no values."""
    dtype = df.schema[column].dataType
    found = exact_quantiles(df, [column], probs.values(), [rule])
    return found.agg(*_named(probs, dtype))


def least_and_quantiles(
    df: DataFrame, column: str, least: str, probs: Mapping[str, float], rule: str = "nearest"
) -> DataFrame:
    """One row: the minimum under the name ``least``, and the named quantiles."""
    dtype = df.schema[column].dataType
    counts = ordered_counts(df, [column])
    low = counts.agg(F.min("whole").alias("whole"), F.min("floating").alias("floating"))
    low = low.select(F.lit(None).cast("double").alias("prob"), *_VALUE)
    ranked = ranked_values(counts, probs.values(), [rule]).select("prob", *_VALUE)
    smallest = F.max(F.when(F.col("prob").isNull(), typed(dtype))).alias(least)
    return low.unionByName(ranked).agg(smallest, *_named(probs, dtype))


def _named(probs: Mapping[str, float], dtype: T.DataType) -> list[Column]:
    return [F.max(F.when(F.col("prob") == float(p), typed(dtype))).alias(n) for n, p in probs.items()]


def _value(name: str, dtype: T.DataType) -> tuple[Column, Column]:
    value, whole, floating = F.col(f"`{name}`"), F.lit(None).cast("long"), F.lit(None).cast("double")
    if isinstance(dtype, T.TimestampNTZType):
        whole = to_micros(value)
    elif isinstance(dtype, T.TimestampType):
        whole = F.unix_micros(value)
    elif isinstance(dtype, T.DateType):
        whole = F.unix_date(value).cast("long")
    elif isinstance(dtype, _FLOATING):
        floating = value.cast("double")
    elif isinstance(dtype, _WHOLE):
        whole = value.cast("long")
    else:
        raise TypeError(f"no quantiles of type {dtype.simpleString()}")
    return whole.alias("whole"), floating.alias("floating")


def typed(dtype: T.DataType) -> Column:
    """The value of a row in the type of the column it came from."""
    whole = F.col("whole")
    if isinstance(dtype, T.TimestampNTZType):
        return from_micros(whole)
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_micros(whole)
    if isinstance(dtype, T.DateType):
        return F.date_from_unix_date(whole.cast("int"))
    if isinstance(dtype, _FLOATING):
        return F.col("floating").cast(dtype)
    return whole.cast(dtype)
