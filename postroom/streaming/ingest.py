"""Incremental ingest of landed mail files.

Each micro-batch writes its mails and, beside them, what later questions need
without the contents: the highest number per list (``marks``), the numbers that
have come, as bitmaps (``numbers``), and the keys of the mails (``keys``). All of
them become visible in one commit (:mod:`postroom.sinks.versions`), which also
takes away what an earlier attempt at the same batch left: a batch that runs again
after a failure leaves the same result.

Which copy of a mail counts is decided from the keys alone. Only lists and batches
that hold a copy which lost are joined with those keys when they are read; all
others are plain scans, and :func:`compact` makes plain scans of the rest.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.quality import block_gaps, merge_blocks, number_blocks, spread_gaps
from ..schema import FILE_SCHEMA, MARK_SCHEMA, RAW_SCHEMA
from ..sinks.scratch import materialise, scratch, scratch_dir
from ..sinks.tables import write_partitioned
from ..sinks.versions import (
    Entry,
    Version,
    commit,
    current_version,
    list_name,
    new_run,
    read_table,
    run_folder,
    split_root,
)
from ..sources.files import CATALOGUE, catalogue, read_catalogued
from ..sources.raw import MAIL_GLOB, with_origin
from ..sources.selection import article_range

# What a status line says, before and after the number of mails and
# before the list's name in quotes.
COLLECTED = ("Collected ", " new e-mails from ")
NOTHING_NEW = "No New e-mails from "

# Fixed value: how often a running ingest looks for new mails.
POLL = "1 hour"

#: Files older than this beside the newest one seen are passed over without a word.
#: Archives keep the times of old mails, so the default never is.
MAX_AGE = "36500d"

#: Files that one call adds to a listing at least, if there are as many mails, and the
#: mails that one of them names at most.
LISTING_PARTS = 12
LISTING_ROWS = 50_000

# The table of mails: a mail's place in its batch tells equal copies apart.
MAILS = "mails"
_MAILS = T.StructType(
    [
        *RAW_SCHEMA.fields,
        T.StructField("batch", T.LongType()),
        T.StructField("row", T.LongType()),
    ]
)
_AGE = ("modificationTime", "batch", "path")
_KEYS = (
    "name string, modificationTime timestamp, batch long, path string, row long, mails_run string, list string"
)
_NUMBERS = "block long, numbers binary, list string"


def mail_stream(
    spark: SparkSession, root: str, max_files: int | None = None, max_age: str = MAX_AGE
) -> DataFrame:
    """New ``.eml`` files under ``root`` as they appear, however old.

    The driver lists all files and remembers them, and Spark reads a few dozen in a
    task. For more than some ten thousand mails use :func:`listed_stream` or
    :func:`landed_stream`, whose files are few.
    """
    reader = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", MAIL_GLOB)
        .option("recursiveFileLookup", "true")
    )
    return with_origin(_rate(reader, max_files, max_age).load(root))


def landed_stream(
    spark: SparkSession, root: str, max_files: int | None = None, max_age: str = MAX_AGE
) -> DataFrame:
    """New files of a landed raw table as they appear, however old.

    Of a table that is landed in versions, the runs of all of them are followed.
    """
    home, table = split_root(root)
    version = current_version(spark, home)
    if version is not None and any(e.table == table for e in version.entries):
        root = f"{home}/runs/run=*/table={table}"
    return _rate(spark.readStream.schema(RAW_SCHEMA), max_files, max_age).parquet(root)


def note_files(spark: SparkSession, root: str, listing: str) -> None:
    """Add to the table ``listing`` the mail files under ``root`` that it doesn't name yet.

    Tasks list the folders, so the driver knows no file. A file is known by its path,
    as it is to :func:`mail_stream`. Run one at a time for a listing.
    """
    found = catalogue(spark, root)
    try:
        known = spark.read.schema(CATALOGUE).parquet(listing).select("path")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    else:
        found = found.join(known, "path", "left_anti").select(*found.columns)
    found = materialise(found, f"{scratch_dir(spark)}/found")  # the folders are listed once
    parts = max(LISTING_PARTS, spark.sparkContext.defaultParallelism)
    spread = found.repartitionByRange(parts, "list", "path")
    spread.write.mode("append").option("maxRecordsPerFile", LISTING_ROWS).parquet(listing)


def listed_stream(
    spark: SparkSession, listing: str, max_files: int | None = None, max_age: str = MAX_AGE
) -> DataFrame:
    """The mail files that :func:`note_files` adds to ``listing`` as they appear there.

    Rows name the files; give :func:`ingest` a :func:`listed_reader`, which has tasks
    read them, many to a task. ``max_files`` counts files of the listing.
    """
    return _rate(spark.readStream.schema(CATALOGUE), max_files, max_age).parquet(listing)


def listed_reader(root: str) -> Callable[[DataFrame], DataFrame]:
    """What turns a batch of a listing of ``root`` into its raw mails."""

    def read(batch: DataFrame) -> DataFrame:
        # Written first, so the stream's progress counts each mail once.
        names = materialise(batch, f"{scratch_dir(batch.sparkSession)}/batch")
        return read_catalogued(names, root)

    return read


def _rate(reader, max_files: int | None, max_age: str):
    reader = reader.option("maxFileAge", max_age)
    return reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)


def ingest(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    once: bool = True,
    every: str = POLL,
    read: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> StreamingQuery:
    """Start the ingest: everything there is now, or again and again.

    ``read`` makes raw mails of a batch that only names them (:func:`listed_reader`).
    """
    trigger = {"availableNow": True} if once else {"processingTime": every}
    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, number: store_batch(read(batch), number, target))
        .trigger(**trigger)
        .start()
    )


def store_batch(batch: DataFrame, number: int, target: str) -> Version:
    """Store one batch of raw mails with its marks, numbers and keys."""
    spark, run = batch.sparkSession, new_run()
    rows = batch.select(*RAW_SCHEMA.fieldNames()).withColumns(
        # Tells copies in one batch apart, whatever else they share.
        {"row": F.monotonically_increasing_id(), "batch": F.lit(number).cast("long")}
    )
    return _store(spark, rows, number, target, run, lambda e: e.batch == number)


def _store(
    spark: SparkSession,
    rows: DataFrame,
    number: int,
    target: str,
    run: str,
    replaced: Callable[[Entry], bool],
    beside: tuple[str, ...] = ("marks", "numbers", "keys"),
) -> Version:
    """Write mails and what is known of them; commit them in place of entries ``replaced``."""
    folder = run_folder(target, run)
    rows = rows.withColumn("table", F.lit(MAILS))
    write_partitioned(rows, folder, "errorifexists", order_by=["article_no"], above=("table",))
    # All else comes from what was just written, so the source is read only once.
    written = spark.read.schema(_MAILS).parquet(folder).drop("content", "table")
    written = written.withColumn("list", list_name())
    counts = written.groupBy("list").agg(
        F.count(F.lit(1)).alias("rows"),
        F.max("article_no").alias("last_article"),
        F.countDistinct("article_no").alias("new_mails"),
    )
    found = counts.collect()  # one row per list
    entries = [Entry(MAILS, r["list"], run, r["rows"], number) for r in found]
    if found:
        marks = [(r["list"], r["last_article"], r["new_mails"], number) for r in found]
        known = {
            "marks": spark.createDataFrame(marks, MARK_SCHEMA),
            "numbers": number_blocks(written),
            "keys": written.select("list", _name().alias("name"), *_AGE, "row", F.lit(run).alias("mails_run")),
        }
        parts = [known[t].withColumn("table", F.lit(t)) for t in beside]
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part, allowMissingColumns=True)
        other = new_run()
        write_partitioned(rows, run_folder(target, other), "errorifexists", above=("table",))
        entries += [Entry(t, r["list"], other, 0, number) for t in beside for r in found]

    return commit(spark, target, lambda old: [*[e for e in old if not replaced(e)], *entries])


def backfill(raw: DataFrame, articles: str, target: str, number: int) -> None:
    """Store the named article numbers of a batch read, whatever the marks say.

    ``number`` is the batch to write; take negative ones to stay clear of the
    stream's. A mark is the maximum over batches, so this never lowers it.
    """
    store_batch(raw.where(article_range(articles)), number, target)


def read_ingested(spark: SparkSession, target: str) -> DataFrame:
    """Every stored copy of every mail, with the batch it came in."""
    return read_table(spark, f"{target}/{MAILS}", _MAILS).drop("row")


def _name() -> Column:
    """What a mail is known by in its list: its number, or else the path of its file."""
    return F.coalesce(F.col("article_no").cast("string"), F.col("path"))


def latest(ingested: DataFrame) -> DataFrame:
    """One copy per list and article: the newest file, then the newest batch.

    For any table of mails with their batch. Few mails come more than once; they
    are found by their keys alone, and only their copies are compared.
    """
    age = F.struct(*_AGE)
    keyed = ingested.withColumn("__name", _name())
    newest = (
        keyed.groupBy("list", "__name")
        .agg(F.count(F.lit(1)).alias("__copies"), F.max(age).alias("__newest"))
        .where(F.col("__copies") > 1)
        .drop("__copies")
    )
    joined = keyed.join(newest, ["list", "__name"], "left")
    single = joined.where(F.col("__newest").isNull())
    chosen = joined.where(age == F.col("__newest")).dropDuplicates(["list", "__name"])
    return single.unionByName(chosen).drop("__name", "__newest")


def lost_copies(spark: SparkSession, target: str, version: Version | None = None) -> DataFrame:
    """list, mails_run, batch, row of copies that a newer one stands in for, from the keys alone."""
    keys = read_table(spark, f"{target}/keys", _KEYS, version=version)
    age = F.struct(*_AGE, "row")
    newest = (
        keys.groupBy("list", "name")
        .agg(F.count(F.lit(1)).alias("copies"), F.max(age).alias("newest"))
        .where(F.col("copies") > 1)
        .select("list", "name", "newest")
    )
    losers = keys.join(newest, ["list", "name"]).where(age < F.col("newest"))
    return losers.select("list", "mails_run", "batch", "row")


def _touched(lost: DataFrame) -> set[tuple[str, str]]:
    """Lists and runs with lost copies: at most as many as the version has entries."""
    pairs = lost.select("list", "mails_run").distinct().collect()
    return {(r["list"], r["mails_run"]) for r in pairs}


def read_latest(spark: SparkSession, target: str) -> DataFrame:
    """One copy per list and article of what was ingested, with its batch.

    Each file is read once. Mails of lists and batches without a lost copy are
    neither joined nor shuffled.
    """
    version = current_version(spark, target)
    lost = materialise(lost_copies(spark, target, version), f"{scratch_dir(spark)}/lost")
    touched = _touched(lost)
    if not touched:
        return read_ingested(spark, target)

    def read(inside: bool) -> DataFrame:
        only = lambda e: ((e.list, e.run) in touched) == inside
        return read_table(spark, f"{target}/{MAILS}", _MAILS, only=only, version=version)

    kept = read(True).join(lost.select("batch", "row"), ["batch", "row"], "left_anti")
    return read(False).unionByName(kept).drop("row")


def compact(spark: SparkSession, target: str) -> int:
    """Write lists and batches with lost copies anew, without them; returns how many.

    Afterwards :func:`read_latest` is a plain scan. Readers of the old version
    are not disturbed.
    """
    version = current_version(spark, target)
    if version is None:
        return 0
    with scratch(spark) as kept:
        lost = kept.keep(lost_copies(spark, target, version), "lost")
        touched = _touched(lost)
        batches = {e.run: e.batch for e in version.entries if e.table == MAILS}
        for number in sorted({batches[run] for _, run in touched}):
            names = {name for name, run in touched if batches[run] == number}
            # What has come when stays as it was; marks and numbers are not touched.
            of_it = partial(_holds, (MAILS, "keys"), number, names)
            rows = read_table(spark, f"{target}/{MAILS}", _MAILS, only=of_it, version=version)
            rows = rows.join(lost.select("batch", "row"), ["batch", "row"], "left_anti")
            _store(spark, rows, number, target, new_run(), of_it, ("keys",))
        return len(touched)


def _holds(tables: tuple[str, ...], batch: int, names: set[str], entry: Entry) -> bool:
    return entry.table in tables and entry.batch == batch and entry.list in names


def read_numbers(spark: SparkSession, target: str) -> DataFrame:
    """Bitmaps of the numbers that have come, put together from all batches."""
    return merge_blocks(read_table(spark, f"{target}/numbers", _NUMBERS))


def ingested_gaps(spark: SparkSession, target: str, catalogue: DataFrame | None = None) -> DataFrame:
    """The numbers that are missing so far, from the bitmaps of the batches."""
    return spread_gaps(block_gaps(read_numbers(spark, target), "list", catalogue))


def read_marks(spark: SparkSession, target: str) -> DataFrame:
    """Marks as written, one row per list and batch."""
    return read_table(spark, f"{target}/marks", MARK_SCHEMA)


def high_water_marks(marks: DataFrame) -> DataFrame:
    """Highest article number per list so far."""
    return marks.groupBy("list").agg(F.max("last_article").alias("last_article"))


def above_marks(raw: DataFrame, marks: DataFrame) -> DataFrame:
    """Mails at or above the mark of their list, and all mails of new lists.

    The mark itself is fetched again; :func:`latest` keeps one copy of it. So are
    files whose name is not a number, as no mark can tell whether they are new.
    """
    return (
        raw.join(high_water_marks(marks), "list", "left")
        .where(
            F.col("article_no").isNull()
            | (F.col("article_no") >= F.coalesce("last_article", F.lit(0)))
        )
        .drop("last_article")
    )


def ingest_status(catalogue: DataFrame, marks: DataFrame, batch: int) -> DataFrame:
    """Per list of the catalogue (``list``, ``high``): what one batch brought,
    how far the list is, and what is left."""
    seen = marks.groupBy("list").agg(
        F.max("last_article").alias("last_article"),
        F.sum(F.when(F.col("batch") == batch, F.col("new_mails")).otherwise(0)).alias("new_mails"),
    )
    last = F.coalesce("last_article", F.lit(0).cast("long"))
    new = F.coalesce("new_mails", F.lit(0).cast("long"))
    return catalogue.join(seen, "list", "left").select(
        "list",
        "high",
        last.alias("last_article"),
        new.alias("new_mails"),
        F.greatest(F.col("high") - last, F.lit(0)).alias("backlog"),
        percent(last, F.col("high")).alias("percent"),
        status_text(F.col("list"), new).alias("status"),
    )


def percent(current: Column, high: Column) -> Column:
    """Progress in per cent, two decimals; null for an empty list."""
    return F.when(high > 0, F.round(current / high * 100, 2))


def status_text(name: Column, new: Column) -> Column:
    """One line on what was fetched."""
    quoted = F.concat(F.lit('"'), name, F.lit('"'))
    return F.when(
        new > 0, F.concat(F.lit(COLLECTED[0]), new.cast("string"), F.lit(COLLECTED[1]), quoted)
    ).otherwise(F.concat(F.lit(NOTHING_NEW), quoted))
