"""How large the lists are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def list_sizes(mail: DataFrame, group: str = "list", counted: str = "from") -> DataFrame:
    """Mails per list: rows where ``counted`` is not null."""
    return mail.groupBy(group).agg(F.count(F.col(f"`{counted}`")).alias("mails"))


def list_extremes(sizes: DataFrame, group: str = "list") -> DataFrame:
    """Largest and smallest list in one row; ties go to the first name."""
    largest = F.min_by(F.struct(group, "mails"), F.struct(-F.col("mails"), F.col(group)))
    smallest = F.min_by(F.struct(group, "mails"), F.struct(F.col("mails"), F.col(group)))
    row = sizes.agg(largest.alias("largest"), smallest.alias("smallest"))
    return row.select(
        F.col(f"smallest.{group}").alias("smallest_list"),
        F.col("smallest.mails").alias("smallest_mails"),
        F.col(f"largest.{group}").alias("largest_list"),
        F.col("largest.mails").alias("largest_mails"),
    )


def size_quartiles(sizes: DataFrame) -> DataFrame:
    """Quartiles of list size, linear between neighbours.

    One input row per list, so gathering their sizes is small.
    """
    q = sizes.agg(F.percentile("mails", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"))
    return q.select(*[F.get("q", i).alias(f"q{i + 1}") for i in range(3)])


def size_report(sizes: DataFrame, group: str = "list") -> DataFrame:
    """Extremes and quartiles as labelled lines: stat, list, mails."""
    q = F.percentile("mails", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    largest = F.min_by(F.struct(group, "mails"), F.struct(-F.col("mails"), F.col(group)))
    smallest = F.min_by(F.struct(group, "mails"), F.struct(F.col("mails"), F.col(group)))
    row = sizes.agg(q.alias("q"), largest.alias("most"), smallest.alias("least"))

    def line(at: int, stat: str, name, mails):
        return F.struct(
            F.lit(at).alias("position"),
            F.lit(stat).alias("stat"),
            name.cast("string").alias("list"),
            mails.cast("double").alias("mails"),
        )

    none = F.lit(None)
    lines = [
        line(0, "Min", F.col(f"least.{group}"), F.col("least.mails")),
        *[line(i + 1, f"Q{i + 1}", none, F.get("q", i)) for i in range(3)],
        line(4, "Max", F.col(f"most.{group}"), F.col("most.mails")),
    ]
    return row.select(F.inline(F.array(*lines)))
