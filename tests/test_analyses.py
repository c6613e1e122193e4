from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from postroom.operators import (
    MessageIdConflict,
    author_lists,
    date_stats,
    duplicate_ids,
    exact_quantiles,
    find_one,
    gap_ranges,
    gaps,
    list_extremes,
    list_sizes,
    missing_ids,
    profile,
    quantile_row,
    reconcile,
    reconcile_total,
    repeat_lists,
    rolling_activity,
    size_quartiles,
    size_report,
)

DAY = dt.timedelta(days=1)


def _mails(spark, rows):
    data = [(name, when, [(a, "x") for a in tags]) for name, when, tags in rows]
    schema = "list string, date timestamp_ntz, trailers array<struct<attribution:string,identification:string>>"
    return spark.createDataFrame(data, schema)


def test_rolling_activity_matches_brute_force(spark):
    rng = random.Random(2)
    tags = ["Reviewed-by", "REVIEWED-BY", "Tested-by", "Reviewed-and-tested-by", "Acked-by", "reviewed-by-x"]
    start = dt.datetime(2020, 1, 1)
    rows = [
        (
            rng.choice(["a", "a", "a", "b"]),
            None if rng.random() < 0.05 else start + dt.timedelta(seconds=rng.randint(-5, 400 * 86400)),
            rng.sample(tags, rng.randint(0, 3)),
        )
        for _ in range(500)
    ]
    # Mails exactly on the edges of a window.
    rows += [("b", start + dt.timedelta(days=d), ["Tested-by"]) for d in (1, 2, 61, 62, 66)]
    rows.append(("idle", start + 5 * DAY, []))

    got = {
        (r["sample_ts"], r["list"]): (r["reviewed"], r["tested"], r["any"])
        for r in rolling_activity(_mails(spark, rows), since="2020-01-01").collect()
    }
    dated = [r for r in rows if r[1] is not None and r[1] > start]
    first, last = min(r[1] for r in dated), max(r[1] for r in dated)
    want, sample = {}, first + 60 * DAY
    while sample < last:
        for name in ("a", "b", "idle"):
            inside = [t.lower() for n, w, ts in dated for t in ts if n == name and sample - 60 * DAY <= w <= sample + DAY]
            reviewed = sum(t.startswith("reviewed-by") for t in inside)
            tested = sum(t.startswith("tested-by") for t in inside)
            want[sample, name] = (reviewed, tested, reviewed + tested)
        sample += 5 * DAY
    assert got == want and len(want) > 150


def test_short_spans_have_no_samples(spark):
    rows = [("a", dt.datetime(2020, 1, 2), ["Tested-by"]), ("a", dt.datetime(2020, 2, 2), [])]
    assert rolling_activity(_mails(spark, rows)).count() == 0
    assert rolling_activity(_mails(spark, rows), lists=["none"]).count() == 0


@pytest.mark.parametrize("rule", ["nearest", "discrete"])
def test_quantiles_match_sorting(spark, rule):
    rng = random.Random(4)
    floats = [rng.choice([0.0, -0.0, 1.5, -1e300, 1e-300, rng.gauss(0, 1e6)]) for _ in range(500)]
    rows = [
        (
            rng.choice([7, 7, 7, rng.randint(-(2**62), 2**62)]),
            None if i % 9 == 0 else f,
            dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=rng.randint(-(10**15), 10**15)),
            dt.date(2000, 1, 1) + dt.timedelta(days=rng.randint(-9999, 9999)),
        )
        for i, f in enumerate(floats)
    ]
    df = spark.createDataFrame(rows, "n long, f double, t timestamp_ntz, d date")
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    for i, name in enumerate("nftd"):
        values = sorted(r[i] for r in rows if r[i] is not None)
        n, got = len(values), quantile_row(df, name, probs, rule).first()
        for column, q in probs.items():
            at = int(q * (n - 1) + 0.5) if rule == "nearest" else max(-int(-q * n // 1) - 1, 0)
            assert got[column] == values[at], (name, q)
    assert exact_quantiles(df.where("n IS NULL"), ["n"], [0.5]).count() == 0


def test_date_stats_and_profile(spark):
    rows = [(dt.datetime(2020, 1, d), "x" * d, [d]) for d in range(1, 10)] + [(None, None, None)]
    df = spark.createDataFrame(rows, "date timestamp_ntz, s string, a array<int>")
    assert [str(v) for v in date_stats(df).first()] == ["2020-01-01 00:00:00", "2020-01-03 00:00:00"]
    stats = {r["column"]: r for r in profile(df).collect()}
    assert (stats["date"]["count"], stats["date"]["nulls"]) == (9, 1)
    assert stats["date"]["mean"] == stats["date"]["q50"] == "2020-01-05 00:00:00"
    assert (stats["s"]["min"], stats["s"]["max"], stats["s"]["q50"]) == ("x", "x" * 9, None)
    assert (stats["a"]["count"], stats["a"]["min"]) == (9, None)


def test_sizes(spark):
    rows = [("a", "x")] * 3 + [("b", "x")] * 10 + [("c", "x")] + [("d", None), ("d", "x"), ("d", "x")]
    sizes = list_sizes(spark.createDataFrame(rows, "list string, `from` string"))
    assert {r["list"]: r["mails"] for r in sizes.collect()} == {"a": 3, "b": 10, "c": 1, "d": 2}
    assert tuple(list_extremes(sizes).first()) == ("c", 1, "b", 10)
    assert tuple(size_quartiles(sizes).first()) == (1.75, 2.5, 4.75)
    assert [r["stat"] for r in size_report(sizes).orderBy("position").collect()] == ["Min", "Q1", "Q2", "Q3", "Max"]
    ties = spark.createDataFrame([("z", 1), ("y", 1)], "list string, mails long")
    assert tuple(list_extremes(ties).first()) == ("y", 1, "y", 1)


def test_authors(spark):
    rows = [("A", "h", "l1")] * 70_000 + [("A", "h", "l2"), ("B", "i", "l1")]
    pairs = spark.createDataFrame(rows, "__original_from string, `from` string, list string")
    found = {r["from"]: [tuple(x) for x in r["lists"]] for r in author_lists(pairs).collect()}
    assert found == {"h": [("l1", 70_000), ("l2", 1)], "i": [("l1", 1)]}
    repeated = repeat_lists(author_lists(pairs)).groupBy("from", "list").count().collect()
    assert {tuple(r) for r in repeated} == {("h", "l1", 70_000), ("h", "l2", 1), ("i", "l1", 1)}


def test_reconcile(spark):
    def lists(*names):
        return spark.createDataFrame([(n,) for n in names], "list string")

    counts = reconcile(lists("a", "a", "a", "b"), lists("a", "b", "c"), lists("a"))
    got = {r["list"]: (r["raw"], r["parsed"], r["dead"], r["note"]) for r in counts.collect()}
    assert got == {
        "a": (3, 1, 1, "1 emails missing!!"),
        "b": (1, 1, 0, ""),
        "c": (0, 1, 0, "-1 emails missing!!"),
    }
    assert tuple(reconcile_total(counts).first())[1:5] == (4, 3, 1, 0)


def test_ids(spark):
    rows = [("1", "a"), ("1", "a"), ("1", "b"), ("2", "a"), ("", "a"), ("", "a")]
    mail = spark.createDataFrame(rows, "`message-id` string, list string")
    assert [tuple(r) for r in duplicate_ids(mail).collect()] == [("1", "a", 2)]
    assert [tuple(r) for r in duplicate_ids(mail, within=None).collect()] == [("1", 3)]
    assert missing_ids(mail).count() == 2
    assert find_one(mail, "9") is None and find_one(mail, "2")["list"] == "a"
    with pytest.raises(MessageIdConflict):
        find_one(mail, "1")


def test_gaps_across_blocks(spark):
    kept = spark.range(0, 400_000).where("id % 100000 != 7 AND id NOT BETWEEN 60000 AND 140000")
    landed = kept.select(F.lit("a").alias("list"), F.col("id").alias("article_no"))
    landed = landed.unionByName(landed.where("article_no < 100"))  # copies are no gaps
    found = {tuple(r) for r in gap_ranges(landed).select("first_missing", "last_missing", "missing").collect()}
    assert found == {(7, 7, 1), (60000, 140000, 80001), (200007, 200007, 1), (300007, 300007, 1)}
    assert gaps(landed).select("article_no").distinct().count() == 80_004
