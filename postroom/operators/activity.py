"""Review activity over time: a sliding window sampled on a regular grid.

A mail of time ``d`` counts in every sample ``t`` with
``t - window <= d <= t + lookahead``, which is a run of consecutive samples.
So no range join is needed: each mail is reduced to the first and last sample
it counts in, mails with the same run are added up before anything is
exploded, and only those sums are spread over their samples. Work and shuffle
grow with lists x samples, not with mails, and a list that holds a third of
all mails costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import to_micros
from ..functions.trailers import count_reviewed, count_tested

_DAY = 86_400_000_000

# Window length and sampling step in days, slack after a sample.
WINDOW_DAYS = 60
STEP_DAYS = 5
LOOKAHEAD_DAYS = 1


def after(df: DataFrame, since: str, column: str = "date") -> DataFrame:
    """Rows strictly later than ``since``; rows without a date drop out."""
    return df.where(F.col(column) > F.lit(since).cast("timestamp_ntz"))


def trailer_counts(mail: DataFrame) -> DataFrame:
    """Per mail: ``list``, ``date``, and its reviewed-by and tested-by counts."""
    return mail.select(
        "list",
        "date",
        count_reviewed(F.col("trailers")).alias("reviewed"),
        count_tested(F.col("trailers")).alias("tested"),
    )


def rolling_activity(
    mail: DataFrame,
    lists: Iterable[str] | None = None,
    since: str | None = None,
    window_days: int = WINDOW_DAYS,
    step_days: int = STEP_DAYS,
) -> DataFrame:
    """Rolling reviewed-by and tested-by counts per list.

    ``lists`` prunes the read, and fixes which lists appear even if they have
    no mail in range. Columns: sample_ts, list, reviewed, tested, any.
    """
    if lists is not None:
        lists = list(lists)
        mail = mail.where(F.col("list").isin(*lists))
    if since is not None:
        mail = after(mail, since)
    counted = rolling_sums(
        trailer_counts(mail),
        time="date",
        group="list",
        values=("reviewed", "tested"),
        window_days=window_days,
        step_days=step_days,
        groups=lists,
    )
    return counted.select(
        "sample_ts",
        "list",
        "reviewed",
        "tested",
        (F.col("reviewed") + F.col("tested")).alias("any"),
    )


def rolling_sums(
    events: DataFrame,
    time: str,
    group: str,
    values: Iterable[str],
    window_days: int,
    step_days: int,
    lookahead_days: int = LOOKAHEAD_DAYS,
    groups: Iterable[str] | None = None,
) -> DataFrame:
    """Sum ``values`` per group in a sliding window, sampled every ``step_days``.

    Samples start ``window_days`` after the first event and end before the
    last; every group has a row at each of them, zero included.
    """
    values = list(values)
    timed = events.where(F.col(time).isNotNull())
    step = F.lit(step_days * _DAY)
    # First sample and number of the last one, from one column of the source.
    # Worked out inside the subquery, so that rows only meet finished numbers.
    span = (
        timed.agg(F.min(time).alias("first"), F.max(time).alias("last"))
        .select(
            (F.col("first") + F.make_dt_interval(days=F.lit(window_days))).alias("first_sample"),
            (to_micros(F.col("first")) + window_days * _DAY).alias("start"),
            to_micros(F.col("last")).alias("stop"),
        )
        .withColumn("last_sample", _ceil_div(F.col("stop") - F.col("start"), step) - 1)
        .select(F.struct("first_sample", "start", "last_sample"))
        .scalar()
    )
    at, last_sample = F.col("at"), F.col("span.last_sample")
    lowest = F.greatest(_ceil_div(at - lookahead_days * _DAY, step), F.lit(0).cast("long"))
    highest = F.least(_floor_div(at + window_days * _DAY, step), last_sample)

    runs = (
        timed.select(group, to_micros(F.col(time)).alias("at"), *values, span.alias("span"))
        .withColumn("at", F.col("at") - F.col("span.start"))
        .select(group, lowest.alias("lowest"), highest.alias("highest"), *values)
        .groupBy(group, "lowest", "highest")
        .agg(*[F.sum(v).alias(v) for v in values])
    )
    spread = runs.where(F.col("lowest") <= F.col("highest")).select(
        group, F.explode(F.sequence("lowest", "highest")).alias("sample"), *values
    )

    # The zero rows of the grid are added in, so no join fills the gaps.
    if groups is None:
        names = runs.select(group).distinct()
    else:
        schema = f"`{group}` string"
        names = events.sparkSession.createDataFrame([(g,) for g in groups], schema).distinct()
    zeros = (
        names.select(group, span.alias("span"))
        .select(group, last_sample.alias("last_sample"))
        .where(F.col("last_sample") >= 0)
        .select(
            group,
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("last_sample"))).alias("sample"),
            *[F.lit(0).cast("long").alias(v) for v in values],
        )
    )
    sums = (
        spread.unionByName(zeros)
        .groupBy(group, "sample")
        .agg(*[F.sum(v).alias(v) for v in values])
    )
    sample_ts = F.col("span.first_sample") + F.col("sample") * F.make_dt_interval(days=F.lit(step_days))
    return sums.select("*", span.alias("span")).select(
        sample_ts.alias("sample_ts"), group, *values
    )


def _floor_div(value: Column, step: Column) -> Column:
    return F.call_function("div", value - F.pmod(value, step), step)


def _ceil_div(value: Column, step: Column) -> Column:
    return -_floor_div(-value, step)
