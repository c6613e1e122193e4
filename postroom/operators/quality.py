"""Counts that must agree, ids that must be unique, numbers that are missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .parse import split_raw

MESSAGE_ID = "message-id"

# Fixed value: what a report says of a list that lacks mails, after their number.
MISSING_NOTE = " emails missing!!"

# Article numbers are cut into blocks of as many as one bitmap holds.
_BLOCK = 1 << 15


def reconcile(raw: DataFrame, parsed: DataFrame, dead: DataFrame | None = None) -> DataFrame:
    """Raw, parsed and dead mails per list, and how many are missing.

    The three inputs are counted in one aggregation over their union: only
    ``list`` is read, rows are added up before the shuffle, and a list known
    to one side only is kept.
    """
    sides = {"raw": raw, "parsed": parsed} | ({"dead": dead} if dead is not None else {})
    ones = [
        side.select(
            "list", *[F.lit(int(n == name)).cast("long").alias(n) for n in ("raw", "parsed", "dead")]
        )
        for name, side in sides.items()
    ]
    union = ones[0]
    for more in ones[1:]:
        union = union.unionByName(more)
    return with_missing(union.groupBy("list").agg(*_sums()))


def reconcile_raw(raw: DataFrame) -> DataFrame:
    """What a parse of ``raw`` will give: all counts from one look at each mail."""
    failed = F.col("error").isNotNull()
    counts = split_raw(raw).groupBy("list").agg(
        F.count(F.lit(1)).alias("raw"),
        F.count_if(~failed).alias("parsed"),
        F.count_if(failed).alias("dead"),
    )
    return with_missing(counts)


def reconcile_total(per_list: DataFrame) -> DataFrame:
    """One row over all lists; ``list`` is null in it."""
    total = per_list.agg(*_sums()).select(F.lit(None).cast("string").alias("list"), "raw", "parsed", "dead")
    return with_missing(total)


def with_missing(counts: DataFrame) -> DataFrame:
    """Add ``missing`` (raw, less parsed and dead) and a note when it is not 0."""
    missing = F.col("raw") - F.col("parsed") - F.col("dead")
    return counts.withColumn("missing", missing).withColumn(
        "note",
        F.when(F.col("missing") == 0, F.lit("")).otherwise(
            F.concat(F.col("missing").cast("string"), F.lit(MISSING_NOTE))
        ),
    )


def _sums() -> list[Column]:
    return [F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in ("raw", "parsed", "dead")]


def duplicate_ids(mail: DataFrame, within: str | None = "list") -> DataFrame:
    """Message ids that occur more than once, in a list or (``None``) overall."""
    keys = [F.col(f"`{MESSAGE_ID}`")] + ([F.col(within)] if within else [])
    counts = mail.where(F.col(f"`{MESSAGE_ID}`") != "").groupBy(*keys)
    return counts.agg(F.count(F.lit(1)).alias("mails")).where(F.col("mails") > 1)


def missing_ids(mail: DataFrame) -> DataFrame:
    """Mails without a message id."""
    return mail.where(F.col(f"`{MESSAGE_ID}`") == "")


def find_by_id(mail: DataFrame, message_id: str) -> DataFrame:
    """The mails with this message id; the filter reaches the scan."""
    return mail.where(F.col(f"`{MESSAGE_ID}`") == message_id)


class MessageIdConflict(ValueError):
    """More than one mail has the message id that was asked for."""


def find_one(mail: DataFrame, message_id: str):
    """The one mail with this id, ``None`` when there is none, else a conflict."""
    rows = find_by_id(mail, message_id).take(2)
    if len(rows) > 1:
        raise MessageIdConflict(f"more than one mail has the message id {message_id}")
    return rows[0] if rows else None


def number_blocks(landed: DataFrame, group: str = "list", number: str = "article_no") -> DataFrame:
    """Which numbers have landed: group, block, numbers (a bitmap over the block).

    A bitmap takes 4 kB however many rows there are, and is built before the
    shuffle. Blocks of several batches go together with :func:`merge_blocks`.
    """
    n = F.col(number).cast("long")
    return (
        landed.where(n.isNotNull())
        .groupBy(group, F.shiftright(n, _BLOCK.bit_length() - 1).alias("block"))
        .agg(F.bitmap_construct_agg(n.bitwiseAND(F.lit(_BLOCK - 1))).alias("numbers"))
    )


def merge_blocks(blocks: DataFrame, group: str = "list") -> DataFrame:
    """One bitmap per group and block, of any number of them."""
    return blocks.groupBy(group, "block").agg(F.bitmap_or_agg("numbers").alias("numbers"))


def _numbers_of_block() -> Column:
    """The numbers of a block in order, from its bitmap."""
    # Within a byte the lowest bit comes first, and so must its half of the hex.
    halves = F.regexp_replace(F.hex("numbers"), "(.)(.)", "$2$1")
    bits = F.translate(halves, "0123456789ABCDEF", "abcdefghijklmnop")
    for i, letter in enumerate("abcdefghijklmnop"):
        bits = F.replace(bits, F.lit(letter), F.lit(f"{i:04b}"[::-1]))
    start = F.col("block") * _BLOCK
    places = F.transform(
        F.split(bits, ""), lambda bit, i: F.when(bit == "1", start + i.cast("long"))
    )
    return F.array_compact(places)


def gap_ranges(
    landed: DataFrame,
    group: str = "list",
    number: str = "article_no",
    catalogue: DataFrame | None = None,
) -> DataFrame:
    """Runs of missing numbers between the lowest and highest one of each group.

    ``catalogue`` (group, low, high) says which numbers there should be: then what
    is missing at both ends counts too, and groups with nothing landed.
    Columns: group, first_missing, last_missing, missing.
    """
    return block_gaps(number_blocks(landed, group, number), group, catalogue)


def block_gaps(
    blocks: DataFrame, group: str = "list", catalogue: DataFrame | None = None
) -> DataFrame:
    """As :func:`gap_ranges`, from merged blocks.

    Neighbours are compared inside blocks, then block ends with block starts, so
    what one row holds is bounded however long or uneven the groups are.
    """
    if catalogue is not None:
        # As if the numbers just outside had landed: the ends are gaps like others.
        outside = F.array(F.col("low").cast("long") - 1, F.col("high").cast("long") + 1)
        ends = catalogue.where("low <= high").select(group, F.explode(outside).alias("n"))
        blocks = merge_blocks(blocks.unionByName(number_blocks(ends, group, "n")), group)
    blocks = blocks.select(group, "block", _numbers_of_block().alias("ns"))
    pairs = F.arrays_zip(
        F.slice("ns", F.lit(1), F.size("ns") - 1).alias("n"),
        F.slice("ns", F.lit(2), F.size("ns") - 1).alias("next"),
    )
    apart = F.filter(pairs, lambda p: p["next"] > p["n"] + 1)
    within = blocks.select(group, F.inline(apart).alias("n", "next"))
    across = Window.partitionBy(group).orderBy("block")
    between = blocks.select(
        group,
        F.element_at("ns", -1).alias("n"),
        F.lead(F.get("ns", 0)).over(across).alias("next"),
    )

    first, last = F.col("n") + 1, F.col("next") - 1
    return (
        within.unionByName(between)
        .where(F.col("next") > F.col("n") + 1)
        .select(
            group,
            first.alias("first_missing"),
            last.alias("last_missing"),
            (last - first + 1).alias("missing"),
        )
    )


def gaps(
    landed: DataFrame,
    group: str = "list",
    number: str = "article_no",
    catalogue: DataFrame | None = None,
) -> DataFrame:
    """Every missing number as a row with the reason, spread in bounded runs."""
    return spread_gaps(gap_ranges(landed, group, number, catalogue), group, number)


def spread_gaps(ranges: DataFrame, group: str = "list", number: str = "article_no") -> DataFrame:
    """Runs of missing numbers as one row each."""
    runs = ranges.select(
        group,
        "last_missing",
        F.explode(F.sequence("first_missing", "last_missing", F.lit(_BLOCK).cast("long"))).alias("start"),
    )
    stop = F.least(F.col("start") + (_BLOCK - 1), F.col("last_missing"))
    return runs.select(
        group, F.explode(F.sequence(F.col("start"), stop)).alias(number)
    ).withColumn("error", F.lit("article unavailable"))
