"""Contiguous shards of equal bytes, from per-partition totals.

The rows are put in order of their id over range partitions. Each partition
gives one total; the running sum of the totals (one row per partition) is the
offset of each partition, and a running sum inside the partition places every
row in the corpus. A row goes to the shard in which its middle byte lies, so
shards are contiguous and differ by no more than a row's size. Only ids, sizes
and checksums are shuffled, unless the rows themselves are asked for.

Nulls: a null text has no bytes, a null id comes first. Ties and repeated rows
are ordered by checksum, size and place in the input; each keeps a slot of its
own. An empty table gives an empty result; more shards than rows leave shards
empty. Further columns are ignored or, on request, kept in the struct ``row``,
so their names can't clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import in_order, text_of, written

#: Bytes that a row counts besides its text.
ROW_BYTES = 8


def assign_shards(
    docs: DataFrame,
    n_shards: int = 24,
    doc_id: str = "doc_id",
    text: str = "text",
    keep_rows: bool = False,
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, position.

    ``position`` is the row's place in the corpus, ``slot`` its place in the
    shard. Sums are exact up to 2^63 / (2 * n_shards) bytes.
    """
    if n_shards < 1:
        raise ValueError("at least one shard is needed")
    body = F.encode(text_of(text), "UTF-8")
    kept = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if keep_rows else []
    slim = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        (F.octet_length(body) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.monotonically_increasing_id().alias("arrival"),
        *kept,
    )
    order = ["doc_id", "text_crc32", "size", "arrival"]
    # Written once: which partition a row is in must not change between the two
    # uses below, also when an executor is lost.
    ranged = written(
        slim.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranged"
    )

    # One row per range partition, so one task and a broadcast are enough.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    parts = parts.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(Window.partitionBy()).alias("all_bytes"),
    )

    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        ranged.withColumn("to_here", F.sum("size").over(inside))
        .withColumn("nth", F.count(F.lit(1)).over(inside))
        .join(F.broadcast(parts), "part")
        .withColumn("position", F.col("rows_before") + F.col("nth") - 1)
        .withColumn("middle2", 2 * (F.col("bytes_before") + F.col("to_here")) - F.col("size"))
        .withColumn("shard", F.expr(f"CAST(middle2 * {n_shards} DIV (2 * all_bytes) AS INT)"))
    )
    firsts = placed.groupBy("shard").agg(F.min("position").alias("first"))  # a row per shard
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("position") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "position",
        *(["row"] if keep_rows else []),
    )


def write_shards(docs: DataFrame, path: str, n_shards: int = 24) -> None:
    """Write the rows of each shard to its own folder, in order of their slots.

    A shard is cut into files by runs of its slots; a null or repeated id is
    written like any other.
    """
    placed = assign_shards(docs, n_shards, keep_rows=True)
    rows = placed.select("shard", "slot", "row").repartitionByRange("shard", "slot")
    rows = rows.sortWithinPartitions("shard", "slot")
    rows.write.mode("overwrite").partitionBy("shard").parquet(path)


def op4_byte_shards(documents: DataFrame) -> DataFrame:
    """All documents in 24 shards."""
    placed = assign_shards(in_order(documents, "doc_id", "text"), 24)
    return in_order(
        placed, "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "position"
    )
