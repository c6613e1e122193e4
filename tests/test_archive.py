"""Files on disk: raw mails in, tables out, and ingest while they arrive."""

from __future__ import annotations

from types import SimpleNamespace

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from postroom import streaming
from postroom.operators import parse_mail, pseudonymised_datasets
from postroom.plans import jobs
from postroom.sinks import archive_options, land_raw, scratch_dir, write_archive, write_partitioned
from postroom.sources import list_names, read_dead_letters, read_landed, read_mail, read_raw

GOOD = "From: a@x\nDate: 1 Feb 2020 10:00:00\nMessage-ID: <{n}@x>\n\nReviewed-by: R <r@x>\n"


@pytest.fixture
def inbox(tmp_path):
    root = tmp_path / "in"

    def put(name, number, text=None):
        folder = root / name
        folder.mkdir(parents=True, exist_ok=True)
        data = (text or GOOD.format(n=number)).encode() if not isinstance(text, bytes) else text
        (folder / f"{number}.eml").write_bytes(data)

    for number in (1, 2, 3):
        put("list.a", number)
    put("2024", 1)
    put("2024", 2, " stray\n\nx")
    put("2024", 3, b"A: \xff\n\n")
    for control in ("__last_article_number", "__errors", "errors.md", "errors.txt"):
        (root / "list.a" / control).write_text("last_email: 3")
    put.root = str(root)
    return put


def _counts(df):
    return {r["list"]: r["count"] for r in df.groupBy("list").count().collect()}


def test_raw_scan_skips_control_files(spark, inbox):
    raw = read_raw(spark, inbox.root)
    assert _counts(raw) == {"list.a": 3, "2024": 3}
    assert raw.where("list = 'list.a'").agg(F.max("article_no")).first()[0] == 3
    assert _counts(read_raw(spark, inbox.root, lists=["2024"])) == {"2024": 3}


def test_parse_then_check(spark, inbox, tmp_path):
    out, raw = str(tmp_path / "out"), read_raw(spark, inbox.root)
    jobs.parse_archive(raw, out)
    mail = read_mail(spark, f"{out}/parsed")
    assert dict(mail.dtypes)["list"] == "string" and dict(mail.dtypes)["date"] == "timestamp_ntz"
    assert _counts(mail) == {"list.a": 3, "2024": 1}
    assert _counts(read_dead_letters(spark, f"{out}/errors")) == {"2024": 2}
    assert {r["missing"] for r in jobs.check_archive(raw, out).collect()} == {0}
    assert {r[0] for r in list_names(mail).collect()} == {"list.a", "2024"}
    plan = read_mail(spark, f"{out}/parsed", lists=["2024"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run" in plan or "PartitionFilters: [(run" in plan
    assert plan.count("coalesce(list") >= 1


def test_parsing_one_list_again_leaves_the_others(spark, inbox, tmp_path):
    out = str(tmp_path / "out")
    jobs.parse_archive(read_raw(spark, inbox.root), out)
    inbox("2024", 2)
    inbox("2024", 3)
    jobs.parse_archive(read_raw(spark, inbox.root), out, lists=["2024"])
    assert _counts(read_mail(spark, f"{out}/parsed")) == {"list.a": 3, "2024": 3}
    assert read_dead_letters(spark, f"{out}/errors").count() == 0


def test_retry_of_dead_letters(spark, inbox, tmp_path):
    out = str(tmp_path / "out")
    jobs.parse_archive(read_raw(spark, inbox.root), out)
    inbox("2024", 2)
    for _ in range(2):  # the second time changes nothing
        jobs.retry_dead_letters(read_raw(spark, inbox.root), out)
        assert _counts(read_mail(spark, f"{out}/parsed")) == {"list.a": 3, "2024": 2}
        assert [r["article_no"] for r in read_dead_letters(spark, f"{out}/errors").collect()] == [3]


def test_landing(spark, inbox, tmp_path):
    target = str(tmp_path / "landed")
    land_raw(read_raw(spark, inbox.root), target)
    landed = read_landed(spark, target)
    assert _counts(landed) == {"list.a": 3, "2024": 3}
    assert parse_mail(landed).count() == 4
    assert _counts(read_landed(spark, target, lists=["2024"])) == {"2024": 3}


def test_archive_is_zstd_and_complete(spark, inbox, tmp_path):
    mail = parse_mail(read_raw(spark, inbox.root, lists=["2024"])).drop("article_no")
    write_archive(pseudonymised_datasets(mail.select("from", "trailers", "list")), str(tmp_path / "anon"))
    runs = tmp_path / "anon" / "runs"
    files = [f for f in runs.rglob("*.parquet") if "table=__main_dataset" in str(f)]
    assert files and all(pq.ParquetFile(f).metadata.row_group(0).column(0).compression == "ZSTD" for f in files)
    assert archive_options()["parquet.compression.codec.zstd.level"] == "22"
    assert list(runs.glob("run=*/table=__id_map_from/list=2024"))


def test_analyses_write_their_reports(spark, inbox, tmp_path):
    out, results = str(tmp_path / "out"), str(tmp_path / "results")
    jobs.parse_archive(read_raw(spark, inbox.root), out)
    jobs.pseudonymise_archive(spark, f"{out}/parsed", f"{out}/anon", lists=["list.a"])
    jobs.analyse_archive(
        spark, f"{out}/parsed", results, since="2020-01-01", id_map=f"{out}/anon/__id_map_from"
    )
    sizes = spark.read.option("header", "true").csv(f"{results}/list_sizes")
    assert {r["stat"] for r in sizes.collect()} == {"Min", "Q1", "Q2", "Q3", "Max"}
    assert spark.read.parquet(f"{results}/unique_authors").first()["mails"] == 3


def test_a_hot_list_is_spread_over_writers(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        rows = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("list"),
            F.col("id").alias("article_no"),
            F.sha2(F.col("id").cast("string"), 512).alias("x"),
        )
        write_partitioned(rows, str(tmp_path / "t"))
        assert len(list((tmp_path / "t" / "list=hot").glob("*.parquet"))) > 2
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        write_partitioned(rows, str(tmp_path / "u"))
        assert len(list((tmp_path / "u" / "list=hot").glob("*.parquet"))) > 2
        assert spark.read.parquet(str(tmp_path / "u")).count() == 60_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_scratch_follows_the_shared_folder():
    def session(shared, master):
        conf = {"spark.checkpoint.dir": shared, "spark.master": master}
        context = SimpleNamespace(getCheckpointDir=lambda: None)
        return SimpleNamespace(conf=conf, sparkContext=context)

    assert scratch_dir(session("hdfs://shared/tmp/", "yarn")).startswith("hdfs://shared/tmp/postroom-")
    assert scratch_dir(session(None, "local[2]"))
    with pytest.raises(RuntimeError):
        scratch_dir(session(None, "yarn"))


def test_ingest_in_two_passes(spark, inbox, tmp_path):
    store, checkpoint = str(tmp_path / "store"), str(tmp_path / "checkpoint")

    def run():
        streaming.ingest(streaming.mail_stream(spark, inbox.root), store, checkpoint).awaitTermination()
        return streaming.latest(streaming.read_ingested(spark, store))

    assert run().count() == 6
    inbox("list.a", 5)
    second = run()
    assert {r["article_no"] for r in second.where("list = 'list.a'").collect()} == {1, 2, 3, 5}
    assert second.where("batch = 1").count() == 1  # only the new file was read

    # A batch that runs again leaves the same result.
    again = read_raw(spark, inbox.root).where("list = 'list.a' AND article_no = 5")
    streaming.store_batch(again, 1, store)
    assert streaming.latest(streaming.read_ingested(spark, store)).count() == 7

    # So does a copy that came twice in one batch, and a name without a number.
    odd = again.withColumn("article_no", F.lit(None).cast("long")).withColumn("path", F.lit("odd"))
    streaming.store_batch(again.unionByName(again).unionByName(odd), 2, store)
    kept = streaming.latest(streaming.read_ingested(spark, store))
    assert kept.count() == 8 and kept.where("article_no = 5").first()["batch"] == 2
    streaming.store_batch(again, 2, store)

    marks = streaming.read_marks(spark, store)
    top = {r["list"]: r["last_article"] for r in streaming.high_water_marks(marks).collect()}
    assert top == {"list.a": 5, "2024": 3}
    status = streaming.ingest_status(
        spark.createDataFrame([("list.a", 10), ("2024", 3), ("new", 0)], "list string, high long"), marks, 1
    )
    lines = {r["list"]: (r["status"], r["backlog"], r["percent"]) for r in status.collect()}
    assert lines["list.a"] == ('Collected 1 new e-mails from "list.a"', 5, 50.0)
    assert lines["2024"] == ('No New e-mails from "2024"', 0, 100.0)
    assert lines["new"][1:] == (0, None)

    # A backfill does not lower a mark; the article at the mark is fetched again.
    streaming.backfill(read_raw(spark, inbox.root, lists=["list.a"]), "1-2", store, number=-1)
    marks = streaming.read_marks(spark, store)
    assert dict(streaming.high_water_marks(marks).where("list = 'list.a'").collect()) == {"list.a": 5}
    due = streaming.above_marks(read_raw(spark, inbox.root), marks).collect()
    assert sorted((r["list"], r["article_no"]) for r in due) == [("2024", 3), ("list.a", 5)]
