"""Who writes to which lists."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AUTHOR = ("__original_from", "from")


def author_list_counts(
    pairs: DataFrame, author: Iterable[str] = AUTHOR, group: str = "list"
) -> DataFrame:
    """Mails per author and list, one row each.

    Counting first is what keeps a prolific author harmless: partial sums are
    made where the data is, and no task ever holds one entry per mail.
    """
    keys = [F.col(f"`{a}`") for a in author]
    return pairs.groupBy(*keys, group).agg(F.count(F.lit(1)).alias("mails"))


def author_lists(
    pairs: DataFrame, author: Iterable[str] = AUTHOR, group: str = "list"
) -> DataFrame:
    """Per author: the lists written to, sorted, each with its number of mails.

    ``lists`` is an array of (list, mails), at most one item per list. It says
    as much as an array that repeats a list for every mail, which for one
    address may be too long for a row; :func:`repeat_lists` gives that form as
    rows.
    """
    keys = [F.col(f"`{a}`") for a in author]
    counts = author_list_counts(pairs, author, group)
    return counts.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(F.col(group), F.col("mails")))).alias("lists"),
        F.sum("mails").alias("mails"),
    )


def repeat_lists(authors: DataFrame, author: Iterable[str] = AUTHOR, group: str = "list") -> DataFrame:
    """One row per mail again: author and list, lists repeated as often as counted."""
    keys = [F.col(f"`{a}`") for a in author]
    # Repeats are spread in runs of bounded length, not as one long array.
    run = 1 << 16
    return (
        authors.select(*keys, F.inline("lists"))
        .select(
            *keys,
            group,
            "mails",
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("mails") - 1, F.lit(run).cast("long"))).alias("start"),
        )
        .select(
            *keys,
            group,
            F.explode(
                F.array_repeat(F.lit(True), F.least(F.col("mails") - F.col("start"), F.lit(run)).cast("int"))
            ).alias("_"),
        )
        .drop("_")
    )
