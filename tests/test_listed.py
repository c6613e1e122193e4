"""Mail files that a stream follows by a listing, which tasks write and read."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from postroom import streaming
from postroom.plans import queries
from postroom.sources import catalogue, packed, read_catalogued


def put(root, name, numbers, time=None):
    folder = root / name
    folder.mkdir(parents=True, exist_ok=True)
    for n in numbers:
        (folder / f"{n}.eml").write_bytes(b"From: a@x\n\nbody %d" % n)
        if time is not None:
            os.utime(folder / f"{n}.eml", (time, time))
    (folder / "__errors").write_text("no mail")


@pytest.fixture
def places(tmp_path):
    return tmp_path / "in", *(str(tmp_path / n) for n in ("in", "listing", "store", "checkpoint"))


def test_a_listing_brings_each_mail_once_however_old(spark, places):
    folder, root, listing, store, checkpoint = places

    def run():
        streaming.note_files(spark, root, listing)
        stream, read = streaming.listed_stream(spark, listing), streaming.listed_reader(root)
        query = streaming.ingest(stream, store, checkpoint, read=read)
        query.awaitTermination()
        return sum(p.numInputRows for p in query.recentProgress)

    put(folder, "a", range(40))
    put(folder, "b c", [1])
    assert run() == 41  # the progress counts each mail once
    put(folder, "a", [40, 41], time=1_000_000_000)
    put(folder, "new", [7], time=1_000_000_000)
    assert run() == 3
    assert run() == 0
    rows = streaming.read_ingested(spark, store).select("list", "article_no", "batch", "content").collect()
    want = [("a", n, 0) for n in range(40)] + [("b c", 1, 0), ("a", 40, 1), ("a", 41, 1), ("new", 7, 1)]
    assert sorted(r[:3] for r in map(tuple, rows)) == sorted(want)
    assert all(bytes(r["content"]) == b"From: a@x\n\nbody %d" % r["article_no"] for r in rows)


def test_a_listing_of_no_mail(spark, places):
    folder, root, listing, store, checkpoint = places
    folder.mkdir()
    streaming.note_files(spark, root, listing)
    stream, read = streaming.listed_stream(spark, listing), streaming.listed_reader(root)
    streaming.ingest(stream, store, checkpoint, read=read).awaitTermination()
    assert streaming.read_marks(spark, store).count() == 0
    put(folder, "a", [1])
    streaming.note_files(spark, root, listing)
    streaming.ingest(stream, store, checkpoint, read=read).awaitTermination()
    assert streaming.read_ingested(spark, store).count() == 1


def test_each_pack_is_a_task(spark, places):
    folder, root, *_ = places
    put(folder, "a", range(60))
    found = catalogue(spark, root)
    packs = packed(found, 40_000).agg(F.max("pack")).first()[0] + 1
    read = read_catalogued(found, root, pack_bytes=40_000)
    tasks = read.select(F.spark_partition_id().alias("t")).distinct().count()
    assert packs > 4 and tasks == packs


@pytest.mark.parametrize("name", ["stream_files", "ingest_late_files"])
def test_the_driver_follows_few_files(spark, tmp_path, monkeypatch, name):
    """The queries' streams see files of a listing, not the mails' own."""
    turns = [(c, t, ("user", "assistant")[t % 2], f"text {t}") for c in range(20) for t in range(10)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(
        str(tmp_path / "conversations.parquet")
    )
    documents = [(i, f"words of {i}", f"src{i % 3}") for i in range(100)]
    spark.createDataFrame(documents, "doc_id long, text string, source string").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    stored = []
    start = streaming.ingest

    def watch(stream, *args, **options):
        query = start(stream, *args, **options)
        stored.append((stream.schema.fieldNames(), args[1]))
        return query

    monkeypatch.setattr(streaming, "ingest", watch)
    rows = getattr(queries, name)(spark, str(tmp_path)).collect()
    assert sum(r["mails"] for r in rows) == 300
    for columns, checkpoint in stored:
        assert "content" not in columns
        log = [p for p in os.scandir(f"{checkpoint}/sources/0") if not p.name.startswith(".")]
        seen = {line for p in log for line in open(p.path).read().split("\n") if ".eml" in line}
        assert log and not seen
