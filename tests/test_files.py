"""Raw files by a catalogue, and tables with files that can't be read."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from postroom.operators import parse_mail
from postroom.plans import jobs
from postroom.sinks import write_mail
from postroom.sources import (
    catalogue,
    list_folders,
    packed,
    read_catalogued,
    read_mail,
    read_raw,
    read_tolerant,
    unreadable_files,
    write_raw_files,
)

GOOD = "From: a@x\nDate: 1 Feb 2020 10:00:00\nMessage-ID: <{n}@x>\n\nbody {n}\n"


@pytest.fixture
def inbox(tmp_path):
    root = tmp_path / "in"
    for name, count in (("a", 30), ("b c", 3), ("2024", 1)):
        (root / name).mkdir(parents=True)
        for n in range(count):
            (root / name / f"{n}.eml").write_text(GOOD.format(n=n) + "x" * (997 * n % 3000))
        for control in ("__last_article_number", "__errors", "errors.md", "errors.txt"):
            (root / name / control).write_text("last_email: 3")
    (root / "b c" / "draft.eml").write_bytes(b"\xff\x00")
    (root / "b c" / "007.eml").write_bytes(b"")
    (root / "empty").mkdir()
    (root / "note.txt").write_text("no list")
    return str(root)


def contents(df):
    return sorted(
        (r["list"], r["article_no"], os.path.basename(r["path"]), r["length"], bytes(r["content"]))
        for r in df.fillna(-1, ["article_no"]).collect()
    )


def test_catalogue_gives_what_spark_reads(spark, inbox):
    assert list_folders(inbox) == ["2024", "a", "b c", "empty"]
    found = catalogue(spark, inbox)
    assert found.count() == 36 and catalogue(spark, inbox, lists=["a", "none"]).count() == 30
    for root in (inbox, f"file://{inbox}"):
        got = read_catalogued(catalogue(spark, root), root, pack_bytes=9_000)
        assert got.columns == read_raw(spark, inbox).columns
        # Spark's reader passes over empty files.
        empty = ("b c", 7, "007.eml", 0, b"")
        assert contents(got) == sorted([*contents(read_raw(spark, inbox)), empty])
    assert read_catalogued(catalogue(spark, inbox, lists=[]), inbox).count() == 0


def test_packs_hold_about_equal_bytes(spark, inbox):
    packs = packed(catalogue(spark, inbox), 20_000).groupBy("pack").agg(
        F.sum(F.col("length") + 4096).alias("bytes"), F.count(F.lit(1)).alias("files")
    )
    rows = packs.orderBy("pack").collect()
    assert [r["pack"] for r in rows] == list(range(len(rows))) and len(rows) > 5
    assert all(r["bytes"] < 20_000 + 4096 + 3100 for r in rows)
    assert sum(r["files"] for r in rows) == 36


def test_files_that_vanish(spark, inbox):
    found = catalogue(spark, inbox)
    kept = spark.createDataFrame(found.collect(), found.schema)
    os.remove(f"{inbox}/a/5.eml")
    with pytest.raises(Exception, match="5.eml"):
        read_catalogued(kept, inbox).collect()
    assert read_catalogued(kept, inbox, tolerant=True).count() == 35


def test_written_files_keep_bytes_and_times(spark, raw, tmp_path):
    mails = raw(("a", 1, b"A: \xff\r\n\n"), ("b c", 2, b""), ("b c", 3, b"x" * 100_000))
    mails = mails.withColumn("modificationTime", F.timestamp_seconds(F.lit(1_000_000_000)))
    for _ in range(2):
        counts = write_raw_files(mails, str(tmp_path / "out")).collect()
        assert sorted(map(tuple, counts)) == [("a", 1), ("b c", 2)]
    got = read_raw(spark, str(tmp_path / "out"))
    assert [c[:2] + c[3:] for c in contents(got)] == [
        ("a", 1, 7, b"A: \xff\r\n\n"),
        ("b c", 3, 100_000, b"x" * 100_000),
    ]
    times = {r[0] for r in got.select(F.unix_seconds("modificationTime")).distinct().collect()}
    assert times == {1_000_000_000} and dt.datetime.fromtimestamp(1_000_000_000).year == 2001


def test_broken_lists_are_left_out_and_reported(spark, inbox, tmp_path):
    table = str(tmp_path / "out" / "parsed")
    write_mail(parse_mail(read_raw(spark, inbox)), table)
    assert unreadable_files(spark, table).count() == 0
    for name in ("a", "2024"):
        (folder,) = (tmp_path / "out" / "runs").glob(f"run=*/table=parsed/list={name}")
        (folder / "part-broken.parquet").write_bytes(b"PAR1 no table at all PAR1")
    (folder / "part-cut.parquet").write_bytes(b"")
    with pytest.raises(Exception):
        read_mail(spark, table).collect()
    with pytest.warns(UserWarning, match="can't be read"):
        mail, report = read_tolerant(spark, table)
    assert {r["list"] for r in mail.select("list").distinct().collect()} == {"b c"}
    assert mail.count() == 3
    assert {r["list"]: r["files"] for r in report.collect()} == {"a": 1, "2024": 2}


def test_a_copy_without_the_broken_list(spark, raw, tmp_path):
    plain, anon = str(tmp_path / "plain"), str(tmp_path / "anon")
    mails = [(name, n, GOOD.format(n=n).encode()) for name in ("a", "b=1") for n in range(3)]
    parse_mail(raw(*mails)).write.partitionBy("list").parquet(plain)
    jobs.pseudonymise_archive(spark, plain, anon)
    (tmp_path / "plain" / "list=b%3D1" / "part-broken.parquet").write_bytes(b"no table")
    with pytest.warns(UserWarning, match="b=1"):
        report = jobs.pseudonymise_archive(spark, plain, anon, tolerant=True)
    assert [tuple(r)[:2] for r in report.collect()] == [("b=1", 1)]
    copy = read_mail(spark, f"{anon}/__main_dataset")
    assert {r["list"]: r["count"] for r in copy.groupBy("list").count().collect()} == {"a": 3, "b=1": 3}
