"""Runs that come again: nothing older stays, nothing late is lost."""

from __future__ import annotations

import os
import shutil
import sys
import time

import pytest
from pyspark.sql import functions as F

from postroom import streaming
from postroom.plans import jobs
from postroom.operators import gap_ranges, gaps
from postroom.sinks import land_raw
from postroom.sources import read_dead_letters, read_identity_map, read_landed, read_mail, read_raw

ingest_module = sys.modules["postroom.streaming.ingest"]  # the package shows its function by that name

GOOD = "From: a@x\nDate: 1 Feb 2020 10:00:00\nMessage-ID: <{n}@x>\n\nbody\n"


@pytest.fixture
def inbox(tmp_path):
    def put(name, number, text=None):
        folder = tmp_path / "in" / name
        folder.mkdir(parents=True, exist_ok=True)
        file = folder / f"{number}.eml"
        file.write_text(text or GOOD.format(n=number))
        return file

    put.root = str(tmp_path / "in")
    for name in ("a", "b"):
        put(name, 1)
    return put


def counts(df):
    return {r["list"]: r["count"] for r in df.groupBy("list").count().collect()}


def test_a_list_that_loses_all_mails(spark, inbox, tmp_path):
    out = str(tmp_path / "out")
    for lists in (None, ["a"]):
        inbox("a", 1)
        jobs.parse_archive(read_raw(spark, inbox.root), out)
        inbox("a", 1, " stray\n\nx")
        jobs.parse_archive(read_raw(spark, inbox.root), out, lists)
        assert counts(read_mail(spark, f"{out}/parsed")) == {"b": 1}
        assert counts(read_dead_letters(spark, f"{out}/errors")) == {"a": 1}
        assert {r["missing"] for r in jobs.check_archive(read_raw(spark, inbox.root), out).collect()} == {0}


def test_a_list_that_is_withdrawn(spark, inbox, tmp_path):
    out, anon, landed = (str(tmp_path / n) for n in ("out", "anon", "landed"))

    def run():
        raw = read_raw(spark, inbox.root)
        land_raw(raw, landed)
        jobs.parse_archive(raw, out)
        jobs.pseudonymise_archive(spark, f"{out}/parsed", anon)
        copy = read_mail(spark, f"{anon}/__main_dataset")
        pairs = read_identity_map(spark, f"{anon}/__id_map_from")
        return [set(counts(d)) for d in (read_landed(spark, landed), copy, pairs)]

    assert run() == [{"a", "b"}] * 3
    shutil.rmtree(tmp_path / "in" / "a")
    assert run() == [{"b"}] * 3


def test_a_batch_with_fewer_lists(spark, inbox, tmp_path):
    store = str(tmp_path / "store")
    raw = read_raw(spark, inbox.root)
    streaming.store_batch(raw, -1, store)
    streaming.store_batch(raw.where("list = 'b'"), -1, store)
    assert counts(streaming.read_ingested(spark, store)) == {"b": 1}
    assert [r["list"] for r in streaming.read_marks(spark, store).collect()] == ["b"]


def test_old_files_that_come_late(spark, inbox, tmp_path):
    store, checkpoint = str(tmp_path / "store"), str(tmp_path / "checkpoint")

    def run():
        streaming.ingest(streaming.mail_stream(spark, inbox.root), store, checkpoint).awaitTermination()
        return streaming.read_ingested(spark, store).count()

    assert run() == 2
    old = inbox("a", 2)
    os.utime(old, (time.time() - 30 * 86_400,) * 2)
    inbox("a", 3)
    assert run() == 4


def test_ingest_that_goes_on(spark, inbox, tmp_path):
    store, checkpoint = str(tmp_path / "store"), str(tmp_path / "checkpoint")
    stream = streaming.mail_stream(spark, inbox.root)
    query = streaming.ingest(stream, store, checkpoint, once=False, every="1 second")
    try:
        query.processAllAvailable()
        inbox("b", 2)
        query.processAllAvailable()
    finally:
        query.stop()
    found = streaming.read_ingested(spark, store)
    assert counts(found) == {"a": 1, "b": 2} and found.agg(F.max("batch")).first()[0] == 1


def test_a_tolerant_read_passes_over_broken_files(spark, inbox, tmp_path):
    out = tmp_path / "out"
    jobs.parse_archive(read_raw(spark, inbox.root), str(out))
    (folder,) = (out / "runs").glob("run=*/table=parsed/list=a")
    (folder / "broken.parquet").write_bytes(b"PAR1 no parquet at all PAR1")
    with pytest.raises(Exception):
        read_mail(spark, f"{out}/parsed").collect()
    assert counts(read_mail(spark, f"{out}/parsed", tolerant=True)) == {"a": 1, "b": 1}


def test_loose_dates_from_the_job(spark, inbox, tmp_path):
    out = str(tmp_path / "out")
    inbox("a", 1, "From: a@x\nDate: 2012 Jun 15 16:52:52\nMessage-ID: <1@x>\n\nbody\n")
    jobs.parse_archive(read_raw(spark, inbox.root), out, loose_dates=True)
    found = read_mail(spark, f"{out}/parsed").where("list = 'a'").first()
    assert str(found["date"]) == "2012-06-15 16:52:52"


def twice(spark, raw, store):
    """Three batches: mails, newer copies of some, an older copy that comes late."""
    first = raw(*[(name, n, b"old") for name in ("a", "b", "c") for n in range(1, 5)])
    newer = raw(("a", 1, b"new"), ("a", 2, b"new"), ("b", 9, b"new"))
    later = newer.withColumn("modificationTime", F.col("modificationTime") + F.expr("interval 1 day"))
    older = raw(("c", 3, b"older")).withColumn("modificationTime", F.timestamp_seconds(F.lit(-10)))
    for number, batch in enumerate((first, later, older)):
        streaming.store_batch(batch, number, store)


def test_lost_copies_are_found_by_key(spark, raw, tmp_path):
    store = str(tmp_path / "store")
    twice(spark, raw, store)
    kept = streaming.read_latest(spark, store)
    assert kept.columns == streaming.read_ingested(spark, store).columns
    rows = {(r["list"], r["article_no"]): bytes(r["content"]) for r in kept.collect()}
    assert len(rows) == kept.count() == 13
    assert [k for k, v in sorted(rows.items()) if v == b"new"] == [("a", 1), ("a", 2), ("b", 9)]
    assert rows["c", 3] == b"old"
    same = streaming.latest(streaming.read_ingested(spark, store)).select(*kept.columns)
    assert same.exceptAll(kept).count() == 0 == kept.exceptAll(same).count()

    # Contents are read once, and only lists with lost copies are joined.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = streaming.read_latest(spark, store)
        plan = kept._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join LeftAnti") == 1
        lost = streaming.lost_copies(spark, store).collect()
        assert sorted((r["list"], r["batch"]) for r in lost) == [("a", 0), ("a", 0), ("c", 2)]

        before = streaming.read_ingested(spark, store)
        assert streaming.compact(spark, store) == 2 and streaming.compact(spark, store) == 0
        assert before.count() == 16  # a reader from before isn't disturbed
        kept = streaming.read_latest(spark, store)
        assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()
        assert same.exceptAll(kept).count() == 0 == kept.exceptAll(same).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    marks = {(r["list"], r["batch"]): r["last_article"] for r in streaming.read_marks(spark, store).collect()}
    assert marks["a", 0] == 4 and marks["c", 2] == 3

    # A batch that runs again takes the place of its first attempt, compacted or not.
    streaming.store_batch(raw(("a", 1, b"again")), 0, store)
    left = {(r["list"], r["article_no"]) for r in streaming.read_ingested(spark, store).collect()}
    assert left == {("a", 1), ("a", 2), ("b", 9)}


def test_gaps_are_kept_up_batch_by_batch(spark, raw, tmp_path):
    store = str(tmp_path / "store")
    mails = [("a", n, b"x") for n in (1, 2, 5, 40_000, 65_535, 65_536, 98_304, 5)]
    mails += [("b", n, b"x") for n in (-3, 0, 7)]
    for number in range(3):
        streaming.store_batch(raw(*mails[number::3]), number, store)
    whole = streaming.read_ingested(spark, store)
    for catalogue in (None, spark.createDataFrame([("a", 0, 98_310), ("d", 1, 3)], "list string, low long, high long")):
        kept = streaming.ingested_gaps(spark, store, catalogue)
        full = gaps(whole, catalogue=catalogue)
        assert kept.exceptAll(full).count() == 0 == full.exceptAll(kept).count()
    runs = {tuple(r) for r in gap_ranges(whole).collect()}
    assert runs == {
        ("a", 3, 4, 2),
        ("a", 6, 39_999, 39_994),
        ("a", 40_001, 65_534, 25_534),
        ("a", 65_537, 98_303, 32_767),
        ("b", -2, -1, 2),
        ("b", 1, 6, 6),
    }


def test_a_stream_that_is_killed_goes_on(spark, inbox, tmp_path):
    store, checkpoint = str(tmp_path / "store"), str(tmp_path / "checkpoint")
    for n in range(2, 8):
        inbox("b", n)
    log = streaming.ProgressLog()
    spark.streams.addListener(log)
    try:
        stream = streaming.mail_stream(spark, inbox.root, max_files=3)
        stored, calls = ingest_module.store_batch, []

        def dies(batch, number, target):
            calls.append(number)
            if len(calls) == 2:  # after the write, before the stream knows of it
                stored(batch, number, target)
                raise RuntimeError("killed")
            return stored(batch, number, target)

        ingest_module.store_batch = dies
        try:
            with pytest.raises(Exception, match="killed"):
                streaming.ingest(stream, store, checkpoint).awaitTermination()
        finally:
            ingest_module.store_batch = stored
        assert streaming.read_ingested(spark, store).count() == 6
        streaming.ingest(stream, store, checkpoint).awaitTermination()
        assert log.wait_for(lambda rows: {r[2] for r in rows if r[3]} >= {0, 1, 2})
    finally:
        spark.streams.removeListener(log)
    found = streaming.read_ingested(spark, store)
    assert counts(found) == {"a": 1, "b": 7} and found.select("path").distinct().count() == 8
    assert log.store(spark, store) >= 3 and log.store(spark, store) == 0
    progress = streaming.read_progress(spark, store).where("mails > 0")
    assert {r["batch"] for r in progress.collect()} >= {0, 1, 2}
    assert progress.select("run").distinct().count() == 2
