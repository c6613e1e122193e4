"""Replaced lists: what readers see before, during and after, and after a crash."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from postroom.plans import jobs
from postroom.sinks import current_version, expire, scratch, versions, write_mail
from postroom.sinks import tables as table_sinks
from postroom.operators import parse_both, parse_mail
from postroom.sources import list_names, read_dead_letters, read_mail

GOOD = "From: a@x\nDate: 1 Feb 2020 10:00:00\nMessage-ID: <{n}@x>\n\nbody {n}\n"
BAD = b" stray\n\nx"


def mails(*names, start=1):
    return [(name, n, GOOD.format(n=n).encode()) for n, name in enumerate(names, start)]


def counts(df):
    return {r["list"]: r["count"] for r in df.groupBy("list").count().collect()}


def archive(spark, out):
    return counts(read_mail(spark, f"{out}/parsed")), counts(read_dead_letters(spark, f"{out}/errors"))


def test_the_unnamed_list_goes_like_others(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    jobs.parse_archive(raw(*mails("", "", "b"), ("", 9, BAD)), out)
    assert archive(spark, out) == ({"": 2, "b": 1}, {"": 1})
    assert counts(read_mail(spark, f"{out}/parsed", lists=[""])) == {"": 2}
    assert {r["list"] for r in list_names(read_mail(spark, f"{out}/parsed")).collect()} == {"", "b"}
    # By name, then with all lists, then with no mail left at all.
    jobs.parse_archive(raw(*mails("b")), out, lists=[""])
    assert archive(spark, out) == ({"b": 1}, {})
    jobs.parse_archive(raw(*mails("", "b")), out)
    jobs.parse_archive(raw(*mails("b", "b")), out)
    assert archive(spark, out) == ({"b": 2}, {})
    jobs.parse_archive(raw(*mails("b")).where("false"), out)
    assert archive(spark, out) == ({}, {})


def test_names_that_look_like_paths_or_numbers(spark, raw, tmp_path):
    names = ["a/b", "x=1", "2024", "1e5", "null", "%2F", " lead", "ü"]
    out = str(tmp_path / "out")
    jobs.parse_archive(raw(*mails(*names)), out)
    assert archive(spark, out)[0] == dict.fromkeys(names, 1)
    jobs.parse_archive(raw(*mails("x=1", "x=1")), out, lists=["x=1", "a/b"])
    assert archive(spark, out)[0] == {**dict.fromkeys(names[2:], 1), "x=1": 2}


def test_a_reader_sees_one_version(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    jobs.parse_archive(raw(*mails("a", "b"), ("a", 8, BAD)), out)
    before, dead_before = read_mail(spark, f"{out}/parsed"), read_dead_letters(spark, f"{out}/errors")
    seen = []

    def look(*args):
        seen.append(archive(spark, out))
        return spark_commit(*args)

    # Just before the commit all new rows are written, and nobody sees them.
    spark_commit, versions.commit = versions.commit, look
    try:
        jobs.parse_archive(raw(*mails("a", "a", "c")), out)
    finally:
        versions.commit = spark_commit
    assert seen == [({"a": 1, "b": 1}, {"a": 1})]
    assert archive(spark, out) == ({"a": 2, "c": 1}, {})
    # A reader that began before goes on with what it saw.
    assert (counts(before), counts(dead_before)) == ({"a": 1, "b": 1}, {"a": 1})


@pytest.mark.parametrize("step", ["before the write", "after the write", "in the commit"])
def test_a_crash_leaves_the_old_state(spark, raw, tmp_path, monkeypatch, step):
    out = str(tmp_path / "out")
    jobs.parse_archive(raw(*mails("a", "b"), ("a", 8, BAD)), out)
    old = archive(spark, out)

    def crash(*_, **__):
        raise KeyboardInterrupt(step)

    with monkeypatch.context() as patch:
        if step == "before the write":
            patch.setattr(table_sinks, "write_partitioned", crash)
        elif step == "after the write":
            patch.setattr(table_sinks, "entries_of", crash)
        else:
            patch.setattr(versions, "commit", crash)
        with pytest.raises(KeyboardInterrupt):
            jobs.parse_archive(raw(*mails("c")), out)
    assert archive(spark, out) == old
    jobs.parse_archive(raw(*mails("c")), out)
    assert archive(spark, out) == ({"c": 1}, {})


def test_a_commit_that_comes_second_is_made_again(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    jobs.parse_archive(raw(*mails("a", "b")), out)
    late = versions.Entry("parsed", "late", "r0", 1)
    first = versions.Entry("parsed", "first", "r1", 1)
    came_first = []

    def change(old):
        if not came_first:  # another writer commits between reading and writing
            came_first.append(versions.commit(spark, out, lambda o: [*o, first]))
        return [*old, late]

    version = versions.commit(spark, out, change)
    assert came_first[0].number == 2 and version.number == 3
    assert {e.list for e in current_version(spark, out).entries} == {"a", "b", "first", "late"}


def test_runs_no_version_names_are_emptied(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    jobs.parse_archive(raw(*mails("a", "b")), out)
    jobs.parse_archive(raw(*mails("a", start=5)), out, lists=["a"])
    assert expire(spark, out) == 0  # list b is still in the first run
    jobs.parse_archive(raw(*mails("a", "c")), out)
    assert expire(spark, out, keep=2) == 0
    assert expire(spark, out) == 2 and expire(spark, out) == 0
    assert archive(spark, out)[0] == {"a": 1, "c": 1}
    assert len(list((tmp_path / "out" / "runs").rglob("list=*"))) == 2


def test_both_outcomes_come_from_one_scan(spark, raw, tmp_path):
    source = str(tmp_path / "raw")
    raw(*mails("a", "b"), ("a", 8, BAD), ("b", 9, b"A: \xff\n\n")).write.parquet(source)
    landed = spark.read.parquet(source)
    both = parse_both(landed)
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    parsed = both.where("table = 'parsed'").select(*parse_mail(landed).columns)
    assert parsed.exceptAll(parse_mail(landed)).count() == 0 and parsed.count() == 2
    for column in ("raw", "path", "error"):
        assert both.where("table = 'parsed'").where(F.col(column).isNotNull()).count() == 0
    dead = both.where("table = 'errors'")
    assert dead.where("raw_body IS NOT NULL OR `from` IS NOT NULL OR trailers IS NOT NULL").count() == 0
    version = jobs.parse_archive(landed, str(tmp_path / "out"))
    assert {(e.table, e.list): e.rows for e in version.entries} == {
        ("parsed", "a"): 1,
        ("parsed", "b"): 1,
        ("errors", "a"): 1,
        ("errors", "b"): 1,
    }


def test_a_plain_folder_is_read_as_it_is(spark, raw, tmp_path):
    parse_mail(raw(*mails("a", "b"))).write.partitionBy("list").parquet(str(tmp_path / "plain"))
    assert counts(read_mail(spark, str(tmp_path / "plain"), lists=["a"])) == {"a": 1}
    # Also beside tables that have versions.
    write_mail(parse_mail(raw(*mails("c"))), str(tmp_path / "parsed"))
    assert counts(read_mail(spark, str(tmp_path / "plain"))) == {"a": 1, "b": 1}
    assert counts(read_mail(spark, str(tmp_path / "parsed"))) == {"c": 1}
    assert read_mail(spark, str(tmp_path / "none")).count() == 0


def test_scratch_tables_are_emptied(spark, tmp_path):
    with pytest.raises(ValueError), scratch(spark) as kept:
        table = kept.keep(spark.range(5), "numbers")
        assert table.count() == 5
        raise ValueError
    left = spark.read.parquet(f"{kept.folder}/numbers")
    assert left.columns == ["emptied"] and left.count() == 0
