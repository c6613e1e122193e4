"""Every operator as a query on the given tables: ``name -> f(spark, sf_dir)``.

All of them read whole tables. Arrays and structs are unfolded into plain
columns, so results compare without regard to nested types.
"""

from __future__ import annotations

import time
import warnings
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import streaming
from ..functions.text import join_list, split_trimmed
from ..operators import (
    activity,
    authors,
    parse,
    profiling,
    pseudonyms,
    quality,
    quantiles,
    sizes,
)
from ..sinks import materialise, scratch_dir, versions
from ..sinks.tables import land_raw, write_archive, write_dead_letters, write_mail, write_report
from ..sources import files, selection
from ..sources.mail import (
    list_names,
    read_dead_letters,
    read_identity_map,
    read_mail,
    read_tolerant,
)
from ..sources.raw import read_landed, read_raw
from . import jobs
from .corpus import mail_archive, mail_texts, table

Query = Callable[[SparkSession, str], DataFrame]


def _text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def _mail(spark: SparkSession, sf: str) -> DataFrame:
    return parse.parse_mail(mail_archive(spark, sf))


def _items(df: DataFrame, column: str) -> DataFrame:
    return df.select("list", "article_no", F.posexplode(f"`{column}`").alias("pos", "item"))


# --- parsing -------------------------------------------------------------


def review_counts(spark, sf):
    counted = activity.trailer_counts(_mail(spark, sf))
    return counted.groupBy("list").agg(
        F.count(F.lit(1)).alias("mails"),
        F.sum("reviewed").alias("reviewed"),
        F.sum("tested").alias("tested"),
        F.sum(F.col("reviewed") + F.col("tested")).alias("any"),
    )


def raw_mails(spark, sf):
    raw = mail_archive(spark, sf)
    return raw.groupBy("list").agg(
        F.count(F.lit(1)).alias("mails"),
        F.min("article_no").alias("lowest"),
        F.max("article_no").alias("highest"),
    )


def split_messages(spark, sf):
    split = parse.split_raw(mail_archive(spark, sf)).where(F.col("error").isNull())
    return split.select(
        "list",
        "article_no",
        F.length("body").cast("long").alias("body_chars"),
        F.md5("body").alias("body_md5"),
    )


def headers(spark, sf):
    names = ("from", "subject", "message-id", "in-reply-to", "x-mailing-list")
    renamed = [F.col(f"`{n}`").alias(n.replace("-", "_")) for n in names]
    return _mail(spark, sf).select("list", "article_no", *renamed)


def addresses(spark, sf):
    mail = _mail(spark, sf)
    both = F.explode(
        F.array(
            *[F.struct(F.lit(n).alias("field"), F.col(n).alias("items")) for n in ("to", "cc")]
        )
    )
    return mail.select("list", "article_no", both.alias("f")).select(
        "list", "article_no", "f.field", F.posexplode("f.items").alias("pos", "item")
    )


def references(spark, sf):
    return _items(_mail(spark, sf), "references")


def dates(spark, sf):
    return _mail(spark, sf).select("list", "article_no", _text(F.col("date")).alias("sent"))


def trailers(spark, sf):
    mail = _mail(spark, sf)
    return mail.select("list", "article_no", F.posexplode("trailers").alias("pos", "t")).select(
        "list", "article_no", "pos", "t.attribution", "t.identification"
    )


def patches(spark, sf):
    return _items(_mail(spark, sf), "code")


def bodies(spark, sf):
    return _mail(spark, sf).select("list", "article_no", F.md5("raw_body").alias("body_md5"))


def list_helpers(spark, sf):
    words = split_trimmed(F.col("p_name"), " ")
    return table(spark, sf, "part").select(
        "p_partkey",
        F.size(words).cast("long").alias("words"),
        join_list(words).alias("joined"),
    )


def dead_letters(spark, sf):
    dead = parse.dead_letters(mail_archive(spark, sf))
    return dead.select("list", "article_no", "error")


def dead_letter_texts(spark, sf):
    dead = parse.dead_letter_text(parse.dead_letters(mail_archive(spark, sf)))
    return dead.select("list", "article_no", F.md5("text").alias("text_md5"))


# --- sinks and sources ---------------------------------------------------


def _stored(spark, sf) -> str:
    root = scratch_dir(spark)
    write_mail(_mail(spark, sf), f"{root}/parsed")
    return f"{root}/parsed"


def stored_mail(spark, sf):
    mail = read_mail(spark, _stored(spark, sf), with_article=True)
    return mail.select(
        "list",
        "article_no",
        F.col("from").alias("sender"),
        _text(F.col("date")).alias("sent"),
        F.size("trailers").cast("long").alias("trailers"),
        F.size("code").cast("long").alias("patches"),
    )


def stored_lists(spark, sf):
    return list_names(read_mail(spark, _stored(spark, sf)))


def stored_some_lists(spark, sf):
    mail = read_mail(spark, _stored(spark, sf), lists=["list-user", "src3"])
    return mail.groupBy("list").agg(F.count(F.lit(1)).alias("mails"))


def stored_reparse(spark, sf):
    """One list parsed again: it is replaced whole, the others stay."""
    root = _stored(spark, sf)
    again = mail_archive(spark, sf).where(F.col("list") == "list-user")
    write_mail(parse.parse_mail(again), root, processed=["list-user"])
    return read_mail(spark, root).groupBy("list").agg(F.count(F.lit(1)).alias("mails"))


def stored_reparse_emptied(spark, sf):
    """A list whose mails no longer parse: none of them is left among the parsed."""
    root = scratch_dir(spark)
    raw = mail_archive(spark, sf)
    jobs.parse_archive(raw, root)
    broken = F.concat(F.col("content"), F.unhex(F.lit("FF")))
    jobs.parse_archive(raw.withColumn("content", broken), root, lists=["list-user"])
    return jobs.check_archive(raw, root).select("list", "raw", "parsed", "dead", "missing")


def parse_counts(spark, sf):
    """What a parse of the whole archive says it has stored, table by table."""
    version = jobs.parse_archive(mail_archive(spark, sf), scratch_dir(spark))
    rows = [(e.table, e.list, e.rows) for e in version.entries]
    return spark.createDataFrame(rows, "outcome string, list string, mails long")


def stored_unnamed_list(spark, sf):
    """One list loses its name; then its mails are gone, and all is parsed again."""
    root = scratch_dir(spark)
    name = F.when(F.col("list") == "list-system", "").otherwise(F.col("list"))
    raw = mail_archive(spark, sf).withColumn("list", name)
    jobs.parse_archive(raw, root)
    first = _stage_counts(spark, root, "with unnamed")
    jobs.parse_archive(raw.where("list <> ''"), root)
    return first.unionByName(_stage_counts(spark, root, "without"))


def stored_versions(spark, sf):
    """A reader from before a rewrite of one list, and one from after it."""
    root = scratch_dir(spark)
    raw = mail_archive(spark, sf)
    jobs.parse_archive(raw, root)
    before = _stage_counts(spark, root, "before")
    half = raw.where((F.col("list") == "list-user") & (F.col("article_no") % 2 == 0))
    jobs.parse_archive(half, root, lists=["list-user"])
    return before.unionByName(_stage_counts(spark, root, "after"))


def _stage_counts(spark, root: str, stage: str) -> DataFrame:
    sides = [read_mail(spark, f"{root}/parsed"), read_dead_letters(spark, f"{root}/errors")]
    both = sides[0].select("list", F.lit("parsed").alias("outcome"))
    both = both.unionByName(sides[1].select("list", F.lit("errors").alias("outcome")))
    counts = both.groupBy("list", "outcome").agg(F.count(F.lit(1)).alias("mails"))
    return counts.withColumn("stage", F.lit(stage))


def _write_files(raw: DataFrame, root: str) -> int:
    """The mails as real files, with control files beside them; returns how many mails."""
    counts = files.write_raw_files(raw, root).collect()
    for row in counts:
        for name in ("__last_article_number", "__errors", "errors.md", "errors.txt"):
            files.write_file(f"{root}/{row['list']}/{name}", b"last_email: 1")
    return sum(row["mails"] for row in counts)


def raw_files(spark, sf):
    """All mails written as files, listed and read back by tasks."""
    root = f"{scratch_dir(spark)}/in"
    _write_files(mail_archive(spark, sf), root)
    found = files.read_catalogued(files.catalogue(spark, root), root, pack_bytes=1 << 20)
    return found.select("list", "article_no", "length", F.md5("content").alias("content_md5"))


def raw_scan(spark, sf):
    """The same files by Spark's own reader, some lists by name."""
    root = f"{scratch_dir(spark)}/in"
    _write_files(mail_archive(spark, sf), root)
    found = read_raw(spark, root, lists=["list-user", "src3"])
    return found.groupBy("list").agg(
        F.count(F.lit(1)).alias("mails"), F.max("article_no").alias("highest"), F.sum("length").alias("bytes")
    )


def tolerant_read(spark, sf):
    """A table in which one list has a file that is no Parquet: the rest, and a report."""
    root = _stored(spark, sf)
    folder = versions.table_folders(spark, root)["list-system"][0]
    files.write_file(f"{folder}/part-broken.parquet", b"PAR1 no table at all PAR1")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        mail, report = read_tolerant(spark, root)
    counts = mail.groupBy("list").agg(F.count(F.lit(1)).alias("mails"))
    skipped = report.select("list", F.col("files").alias("broken_files"))
    return counts.unionByName(skipped, allowMissingColumns=True)


def landed_mails(spark, sf):
    root = scratch_dir(spark)
    land_raw(mail_archive(spark, sf), root)
    return read_landed(spark, root).groupBy("list").agg(
        F.count(F.lit(1)).alias("mails"), F.sum("article_no").alias("articles")
    )


def stored_dead_letters(spark, sf):
    """Dead letters written for all lists, then again for one that has none left."""
    root = scratch_dir(spark)
    dead = parse.dead_letters(mail_archive(spark, sf))
    write_dead_letters(dead, root)
    write_dead_letters(dead.where(F.lit(False)), root, processed=["list-user"])
    return read_dead_letters(spark, root).groupBy("list").agg(F.count(F.lit(1)).alias("mails"))


def retried_mails(spark, sf):
    """Mails whose bytes were repaired after a first run; the rest stay dead."""
    root = scratch_dir(spark)
    raw = mail_archive(spark, sf)
    jobs.parse_archive(raw, root)
    ends_broken = F.substring("content", -1, 1) == F.unhex(F.lit("FF"))
    repaired = F.expr("substring(content, 1, octet_length(content) - 1)")
    fixed = raw.withColumn("content", F.when(ends_broken, repaired).otherwise(F.col("content")))
    jobs.retry_dead_letters(fixed, root)
    return jobs.check_archive(fixed, root).select("list", "raw", "parsed", "dead", "missing")


def reconcile(spark, sf):
    raw = mail_archive(spark, sf)
    return quality.reconcile(raw, parse.parse_mail(raw))


def reconcile_with_dead(spark, sf):
    return quality.reconcile_raw(mail_archive(spark, sf))


def reconcile_total(spark, sf):
    return quality.reconcile_total(reconcile(spark, sf)).drop("list")


# --- quality -------------------------------------------------------------


def duplicate_ids(spark, sf):
    return quality.duplicate_ids(_mail(spark, sf)).withColumnRenamed("message-id", "message_id")


def missing_ids(spark, sf):
    return quality.missing_ids(_mail(spark, sf)).select("list", "article_no")


def find_by_id(spark, sf):
    found = quality.find_by_id(_mail(spark, sf), "<9.d@mail.example>")
    return found.select("list", "article_no", "subject")


def gap_ranges(spark, sf):
    return quality.gap_ranges(_turn_numbers(spark, sf))


def gaps(spark, sf):
    return quality.gaps(_turn_numbers(spark, sf))


def gaps_to_catalogue(spark, sf):
    """Against a catalogue that begins lower, ends higher and names one list more."""
    landed = mail_texts(spark, sf).select("list", "article_no")
    catalogue = landed.groupBy("list").agg(
        F.lit(-2).cast("long").alias("low"), (F.max("article_no") + 3).alias("high")
    )
    empty = spark.createDataFrame([("list-empty", 5, 9)], "list string, low long, high long")
    return quality.gaps(landed, catalogue=catalogue.unionByName(empty))


def order_gaps(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey")
    return quality.gaps(lines, group="l_returnflag", number="l_orderkey").drop("error")


def _turn_numbers(spark, sf) -> DataFrame:
    return mail_texts(spark, sf).select("list", "article_no")


# --- selection -----------------------------------------------------------


def select_lists(spark, sf):
    catalogue = mail_texts(spark, sf).select("list")
    asked = ["list-user", "src3", "src3", "no-such-list"]
    available, missing = selection.select_lists(catalogue, asked)
    return available.withColumn("available", F.lit(1)).unionByName(
        missing.withColumn("available", F.lit(0))
    )


def select_all_lists(spark, sf):
    return selection.select_lists(mail_texts(spark, sf), [selection.ALL_LISTS])[0]


def article_range(spark, sf):
    named = selection.article_range(" 1, 100-207 , 205-304, 7", "l_orderkey")
    return table(spark, sf, "lineitem").where(named).select("l_orderkey", "l_linenumber", "l_partkey")


def mails_after(spark, sf):
    mail = activity.after(_mail(spark, sf), "2020-01-01")
    return mail.groupBy("list").agg(
        F.count(F.lit(1)).alias("mails"), _text(F.min("date")).alias("first_date")
    )


# --- pseudonyms ----------------------------------------------------------


def hash_columns(spark, sf):
    customer = table(spark, sf, "customer")
    return pseudonyms.hash_columns(customer, ["c_name"], []).select("c_custkey", "c_name")


def hash_keyed(spark, sf):
    """Digests under a secret key, for a scalar and for the items of a list."""
    parts = table(spark, sf, "part").select("p_partkey", "p_name", F.split("p_name", " ").alias("words"))
    hashed = pseudonyms.hash_columns(parts, ["p_name", "words"], [], key="key of the archive")
    return hashed.select("p_partkey", F.col("p_name").alias("name_digest"), join_list(F.col("words"), ",").alias("digests"))


def hash_missing_column(spark, sf):
    """A column that the table doesn't have is passed over."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    return pseudonyms.hash_columns(customers, ["c_name", "no_such_column"], [])


def hash_lists(spark, sf):
    words = table(spark, sf, "part").select("p_partkey", F.split("p_name", " ").alias("words"))
    hashed = pseudonyms.hash_columns(words, ["words"], [])
    return hashed.select("p_partkey", F.posexplode("words").alias("pos", "digest"))


def hash_fields(spark, sf):
    parts = table(spark, sf, "part").select(
        "p_partkey",
        F.array(
            F.struct(F.lit("name").alias("kind"), F.col("p_name").alias("value")),
            F.struct(F.lit("brand").alias("kind"), F.col("p_brand").alias("value")),
        ).alias("labels"),
    )
    hashed = pseudonyms.hash_columns(parts, [], ["labels.value"])
    return hashed.select("p_partkey", F.inline("labels"))


def hash_struct(spark, sf):
    parts = table(spark, sf, "part").select(
        "p_partkey", F.struct(F.col("p_name").alias("name"), F.col("p_size").alias("size")).alias("label")
    )
    return pseudonyms.hash_columns(parts, [], ["label.name"]).select("p_partkey", "label.*")


def identity_map(spark, sf):
    return pseudonyms.identity_map(_mail(spark, sf), "from").select(
        F.col("__original_from").alias("original"), F.col("from").alias("pseudonym"), "list"
    )


def identity_map_distinct(spark, sf):
    pairs = table(spark, sf, "orders").join(
        table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    named = pairs.select(F.col("c_name").alias("from"), F.col("o_orderpriority").alias("list"))
    return pseudonyms.identity_map(named, "from", distinct=True).select(
        F.col("__original_from").alias("original"), F.col("from").alias("pseudonym"), "list"
    )


def pseudonymised_mail(spark, sf):
    hashed = pseudonyms.hash_columns(_mail(spark, sf))
    return hashed.select(
        "list",
        "article_no",
        F.col("from").alias("sender"),
        join_list(F.col("to"), ",").alias("receivers"),
        join_list(F.col("cc"), ",").alias("copies"),
        join_list(F.transform("trailers", lambda t: t["identification"]), ",").alias("people"),
        join_list(F.transform("trailers", lambda t: t["attribution"]), ",").alias("roles"),
    )


def stored_archive(spark, sf):
    """The pseudonymised copy and its identity map, written and read back.

    Every list keeps its own files. The slowest level costs a fixed set-up for each
    column of each file, minutes for tables as small as these, so a lower one is passed.
    """
    root = scratch_dir(spark)
    write_archive(pseudonyms.pseudonymised_datasets(_mail(spark, sf)), root, level=9)
    main = read_mail(spark, f"{root}/{pseudonyms.MAIN_DATASET}")
    pairs = read_identity_map(spark, f"{root}/{pseudonyms.MAP_PREFIX}from")
    both = main.select("list", F.lit("main").alias("dataset"), "from").unionByName(
        pairs.select("list", F.lit("map").alias("dataset"), "from")
    )
    return both.groupBy("list", "dataset").agg(
        F.count(F.lit(1)).alias("mails"), F.min("from").alias("lowest")
    )


# --- analyses ------------------------------------------------------------


def list_sizes(spark, sf):
    return sizes.list_sizes(_mail(spark, sf))


def list_extremes(spark, sf):
    return sizes.list_extremes(_source_sizes(spark, sf), group="source")


def size_quartiles(spark, sf):
    return sizes.size_quartiles(_source_sizes(spark, sf))


def size_report(spark, sf):
    return sizes.size_report(_source_sizes(spark, sf), group="source").drop("position")


def _source_sizes(spark, sf) -> DataFrame:
    return sizes.list_sizes(table(spark, sf, "documents"), group="source", counted="text")


def author_list_counts(spark, sf):
    return authors.author_list_counts(_author_pairs(spark, sf), author=("c_name",))


def author_lists(spark, sf):
    found = authors.author_lists(_author_pairs(spark, sf), author=("c_name",))
    shown = F.transform("lists", lambda x: F.concat(x["list"], F.lit(":"), x["mails"].cast("string")))
    return found.select("c_name", join_list(shown, ";").alias("lists"), "mails")


def author_lists_repeated(spark, sf):
    pairs = pseudonyms.identity_map(_mail(spark, sf), "from")
    repeated = authors.repeat_lists(authors.author_lists(pairs))
    return repeated.select(
        F.col("__original_from").alias("original"), F.col("from").alias("pseudonym"), "list"
    )


def _author_pairs(spark, sf) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_custkey", F.col("o_orderpriority").alias("list"))
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return orders.join(customer, "o_custkey").select("c_name", "list")


def date_stats(spark, sf):
    return _date_stats(spark, sf, "nearest")


def date_stats_discrete(spark, sf):
    return _date_stats(spark, sf, "discrete")


def _date_stats(spark, sf, rule):
    stats = profiling.date_stats(table(spark, sf, "events"), column="ts", rule=rule)
    return stats.select(_text(F.col("min_date")).alias("min_date"), _text(F.col("quartile_date")).alias("quartile_date"))


def first_and_last(spark, sf):
    ends = profiling.first_and_last(_mail(spark, sf))
    return ends.select(_text(F.col("first_date")).alias("first_date"), _text(F.col("last_date")).alias("last_date"))


def profile_events(spark, sf):
    return _profile(profiling.profile(table(spark, sf, "events")))


def profile_mail(spark, sf):
    # Two passes follow; stored first, the mails are parsed once.
    stored = materialise(_mail(spark, sf).drop("article_no"), scratch_dir(spark))
    return _profile(profiling.profile(stored))


def _profile(stats: DataFrame) -> DataFrame:
    return stats.select(
        "column",
        "count",
        "nulls",
        F.round(F.col("mean").try_cast("double"), 6).alias("mean"),
        F.round(F.col("std").try_cast("double"), 6).alias("std"),
        F.col("min").alias("lowest"),
        "q25",
        "q50",
        "q75",
        F.col("max").alias("highest"),
    )


def value_quantiles(spark, sf):
    """Quantiles of a floating point column, by both rank rules."""
    probs = {"p1": 0.01, "p50": 0.5, "p99": 0.99}
    lines = table(spark, sf, "lineitem")
    return quantiles.quantile_rows(lines, "l_extendedprice", probs, ["nearest", "discrete"])


def dates_loose(spark, sf):
    """Dates of a shape that no pattern knows, by the second look in Python."""
    raw = mail_archive(spark, sf)
    sent = F.concat(F.lit("Date: 2012 Jun 15 16:52:"), F.lpad((F.col("article_no") % 60).cast("string"), 2, "0"))
    text = F.replace(F.col("content").cast("string"), F.lit("Date: n/a"), sent)
    content = F.when(F.is_valid_utf8(F.col("content").cast("string")), F.encode(text, "UTF-8"))
    raw = raw.withColumn("content", F.coalesce(content, F.col("content")))
    mail = parse.parse_mail(raw, loose_dates=True)
    return mail.select("list", "article_no", _text(F.col("date")).alias("sent"))


def reports(spark, sf):
    """The small results as files, read back."""
    root = scratch_dir(spark)
    write_report(sizes.size_report(_source_sizes(spark, sf), group="source"), f"{root}/list_sizes")
    dates = profiling.date_stats(table(spark, sf, "events"), column="ts")
    write_report(dates.select(*[_text(F.col(c)).alias(c) for c in dates.columns]), f"{root}/date_stats")
    found = authors.author_lists(_author_pairs(spark, sf), author=("c_name",))
    write_report(found.select("c_name", "mails"), f"{root}/unique_authors", "parquet")

    def csv(name: str) -> DataFrame:
        return spark.read.option("header", "true").csv(f"{root}/{name}")

    named = spark.read.parquet(f"{root}/unique_authors").select(
        F.lit("unique_authors").alias("report"), F.col("c_name").alias("name"), F.col("mails").cast("string").alias("value")
    )
    size = F.concat_ws(" ", "list", F.col("mails").cast("double").cast("decimal(20,2)").cast("string"))
    rows = csv("list_sizes").select(F.lit("list_sizes").alias("report"), F.col("stat").alias("name"), size.alias("value"))
    for column in ("min_date", "quartile_date"):
        one = csv("date_stats").select(F.lit("date_stats"), F.lit(column), F.col(column))
        rows = rows.union(one)
    return named.union(rows)


def rolling_activity(spark, sf):
    # Read twice, for its span and for its counts: from the stored table, as usual.
    stored = read_mail(spark, _stored(spark, sf))
    rolled = activity.rolling_activity(stored, since="2020-01-01")
    return rolled.withColumn("sample_ts", _text(F.col("sample_ts")))


def rolling_some_lists(spark, sf):
    stored = read_mail(spark, _stored(spark, sf))
    rolled = activity.rolling_activity(
        stored, lists=["list-user", "src3", "no-such-list"], window_days=90, step_days=7
    )
    return rolled.withColumn("sample_ts", _text(F.col("sample_ts")))


def rolling_events(spark, sf):
    events = table(spark, sf, "events").select(
        "ts", "event_type", F.lit(1).cast("long").alias("events"), F.col("user_id").alias("users")
    )
    rolled = activity.rolling_sums(
        events, "ts", "event_type", ["events", "users"], window_days=5, step_days=1
    )
    return rolled.withColumn("sample_ts", _text(F.col("sample_ts")))


# --- ingest --------------------------------------------------------------


def _land(raw: DataFrame, root: str) -> None:
    raw.write.parquet(f"{root}/landing", mode="append")


def _run(spark, root) -> None:
    stream = streaming.landed_stream(spark, f"{root}/landing")
    query = streaming.ingest(stream, f"{root}/store", f"{root}/checkpoint", once=True)
    query.awaitTermination()


def ingest_once(spark, sf):
    root = scratch_dir(spark)
    _land(mail_archive(spark, sf), root)
    _run(spark, root)
    marks = streaming.high_water_marks(streaming.read_marks(spark, f"{root}/store"))
    mails = streaming.read_ingested(spark, f"{root}/store")
    counts = mails.groupBy("list").agg(F.count(F.lit(1)).alias("mails"))
    return counts.join(marks, "list")


def ingest_twice(spark, sf):
    """Two passes, the second with newer copies of all documents: one copy of
    each mail counts, the newer one."""
    root = scratch_dir(spark)
    _land(mail_archive(spark, sf), root)
    _run(spark, root)
    newer = _documents(spark, sf).withColumn(
        "modificationTime", F.col("modificationTime") + F.expr("interval 1 day")
    )
    _land(newer, root)
    _run(spark, root)
    newest = streaming.read_latest(spark, f"{root}/store")
    return newest.groupBy("list").agg(
        F.count(F.lit(1)).alias("mails"),
        F.sum("batch").alias("batches"),
        F.max("article_no").alias("last_article"),
    )


def ingest_twice_contents(spark, sf):
    """As ``ingest_twice``, but each mail's contents are read as well."""
    root = scratch_dir(spark)
    _land(mail_archive(spark, sf), root)
    _run(spark, root)
    newer = _documents(spark, sf).withColumn(
        "modificationTime", F.col("modificationTime") + F.expr("interval 1 day")
    )
    _land(newer.withColumn("content", F.encode(F.col("article_no").cast("string"), "UTF-8")), root)
    _run(spark, root)
    newest = streaming.read_latest(spark, f"{root}/store")
    return newest.select("list", "article_no", F.md5("content").alias("content_md5"))


def ingest_compacted(spark, sf):
    """As ``ingest_twice``, after the copies that lost were taken out of the files."""
    root = scratch_dir(spark)
    streaming.store_batch(mail_archive(spark, sf), 0, root)
    newer = _documents(spark, sf).withColumn(
        "modificationTime", F.col("modificationTime") + F.expr("interval 1 day")
    )
    streaming.store_batch(newer, 1, root)
    streaming.compact(spark, root)
    left = streaming.read_ingested(spark, root)
    return left.groupBy("list").agg(F.count(F.lit(1)).alias("mails"), F.sum("batch").alias("batches"))


def gaps_by_batch(spark, sf):
    """Missing numbers from the bitmaps of three batches, one of them run twice."""
    root = scratch_dir(spark)
    raw = mail_archive(spark, sf)
    for number in (0, 1, 1, 2):
        streaming.store_batch(raw.where(F.pmod(F.col("article_no"), F.lit(3)) == number), number, root)
    return streaming.ingested_gaps(spark, root)


def stream_files(spark, sf):
    """Real files by a running stream that is stopped after its first batch and goes
    on from its checkpoint: each mail comes once."""
    root = scratch_dir(spark)
    _write_files(mail_archive(spark, sf), f"{root}/in")
    streaming.note_files(spark, f"{root}/in", f"{root}/listing")
    listed = len(spark.read.parquet(f"{root}/listing").inputFiles())
    log = streaming.ProgressLog()
    spark.streams.addListener(log)
    try:
        stream = streaming.listed_stream(spark, f"{root}/listing", max_files=max(1, -(-listed // 3)))
        target, read = (f"{root}/store", f"{root}/checkpoint"), streaming.listed_reader(f"{root}/in")
        query = streaming.ingest(stream, *target, once=False, every="0 seconds", read=read)
        while query.isActive and not any(p.batchId >= 0 and p.numInputRows for p in query.recentProgress):
            time.sleep(0.1)
        query.stop()
        streaming.ingest(stream, *target, read=read).awaitTermination()
        log.wait_for(lambda rows: len({run for _, run, _, mails, _ in rows if mails}) > 1)
    finally:
        spark.streams.removeListener(log)
    log.store(spark, f"{root}/store")
    runs = streaming.read_progress(spark, f"{root}/store").where("mails > 0").select(F.countDistinct("run")).first()[0]
    mails = streaming.read_ingested(spark, f"{root}/store")
    return mails.groupBy("list").agg(
        F.count(F.lit(1)).alias("mails"),
        F.countDistinct("article_no").alias("articles"),
        F.lit(runs > 1).cast("int").alias("restarted"),
    )


def ingest_late_files(spark, sf):
    """Files that are years older than those taken in before, and come later."""
    root = scratch_dir(spark)

    def run() -> None:
        streaming.note_files(spark, f"{root}/in", f"{root}/listing")
        stream = streaming.listed_stream(spark, f"{root}/listing")
        read = streaming.listed_reader(f"{root}/in")
        streaming.ingest(stream, f"{root}/store", f"{root}/checkpoint", read=read).awaitTermination()

    raw = mail_archive(spark, sf)
    _write_files(_documents(spark, sf), f"{root}/in")
    run()
    old = raw.where(F.startswith("list", F.lit("list-")))
    old = old.withColumn("modificationTime", F.timestamp_seconds(F.lit(1_000_000_000)))
    _write_files(old, f"{root}/in")
    run()
    mails = streaming.read_ingested(spark, f"{root}/store")
    return mails.groupBy("list", "batch").agg(F.count(F.lit(1)).alias("mails"))

def batch_rewritten(spark, sf):
    """One batch stored twice, the second time with fewer lists: only those are left."""
    root = scratch_dir(spark)
    streaming.store_batch(mail_archive(spark, sf), -1, root)
    streaming.store_batch(_documents(spark, sf), -1, root)
    mails = streaming.read_ingested(spark, root).groupBy("list").agg(F.count(F.lit(1)).alias("mails"))
    marks = streaming.high_water_marks(streaming.read_marks(spark, root))
    return mails.join(marks, "list", "full")


def ingest_status(spark, sf):
    root = scratch_dir(spark)
    _land(mail_archive(spark, sf), root)
    _run(spark, root)
    catalogue = mail_texts(spark, sf).groupBy("list").agg((F.max("article_no") + 10).alias("high"))
    empty = spark.createDataFrame([("list-empty", 0)], "list string, high long")
    marks = streaming.read_marks(spark, f"{root}/store")
    status = streaming.ingest_status(catalogue.unionByName(empty), marks, batch=0)
    return status.select("list", "high", "last_article", "new_mails", "backlog", "percent", "status")


def _documents(spark, sf) -> DataFrame:
    return mail_archive(spark, sf).where(F.startswith("list", F.lit("src")))


def new_articles(spark, sf):
    """Mails at or above marks taken from half of the archive."""
    raw = mail_texts(spark, sf).select("list", "article_no")
    marks = (
        raw.where(F.col("list") != "src3")
        .groupBy("list")
        .agg(F.floor(F.max("article_no") / 2).alias("last_article"))
    )
    return streaming.above_marks(raw, marks)


def backfilled(spark, sf):
    """All documents by stream, then a named range of a list that already has a
    higher mark and one of a list that has none: stored, and no mark goes down."""
    root = scratch_dir(spark)
    _land(_documents(spark, sf), root)
    _run(spark, root)
    raw = mail_archive(spark, sf)
    for number, name in ((-1, "src3"), (-2, "list-user")):
        streaming.backfill(raw.where(F.col("list") == name), "3,23,43-83,100-302", f"{root}/store", number)
    kept = streaming.latest(streaming.read_ingested(spark, f"{root}/store"))
    marks = streaming.high_water_marks(streaming.read_marks(spark, f"{root}/store"))
    return kept.groupBy("list").agg(F.count(F.lit(1)).alias("mails")).join(marks, "list")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        review_counts,
        raw_mails,
        raw_files,
        raw_scan,
        split_messages,
        headers,
        addresses,
        references,
        dates,
        trailers,
        patches,
        bodies,
        list_helpers,
        dead_letters,
        dead_letter_texts,
        stored_mail,
        stored_lists,
        stored_some_lists,
        stored_reparse,
        stored_reparse_emptied,
        parse_counts,
        stored_unnamed_list,
        stored_versions,
        tolerant_read,
        landed_mails,
        stored_dead_letters,
        retried_mails,
        reconcile,
        reconcile_with_dead,
        reconcile_total,
        duplicate_ids,
        missing_ids,
        find_by_id,
        gap_ranges,
        gaps,
        gaps_to_catalogue,
        gaps_by_batch,
        order_gaps,
        select_lists,
        select_all_lists,
        article_range,
        mails_after,
        hash_columns,
        hash_keyed,
        hash_missing_column,
        hash_lists,
        hash_fields,
        hash_struct,
        identity_map,
        identity_map_distinct,
        pseudonymised_mail,
        stored_archive,
        list_sizes,
        list_extremes,
        size_quartiles,
        size_report,
        author_list_counts,
        author_lists,
        author_lists_repeated,
        date_stats,
        date_stats_discrete,
        first_and_last,
        profile_events,
        profile_mail,
        dates_loose,
        reports,
        value_quantiles,
        rolling_activity,
        rolling_some_lists,
        rolling_events,
        ingest_once,
        ingest_twice,
        batch_rewritten,
        ingest_twice_contents,
        ingest_compacted,
        ingest_late_files,
        stream_files,
        ingest_status,
        new_articles,
        backfilled,
    )
}
