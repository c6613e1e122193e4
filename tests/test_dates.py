from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from postroom.functions import from_micros, parse_date, to_micros
from postroom.functions.loose_dates import fill_unread_dates

CASES = {
    "Fri, 15 Jun 2012 16:52:52 +0200": "2012-06-15 16:52:52",
    "  5 Jun 12 16:52 (CEST)": "2012-06-05 16:52:00",
    "Fri Jun 15 16:52:52 CEST 2012": "2012-06-15 16:52:52",
    "Fri, Jun 15, 2012 at 4:52 PM": "2012-06-15 16:52:00",
    "2012-06-05T16:52:52Z": "2012-06-05 16:52:52",
    "2012-06-05 16:52:52.123456789 +0200": "2012-06-05 16:52:52.123456",
    "6/7/2012 10:00 PM": "2012-06-07 22:00:00",
    "13/7/2012 10:00": "2012-07-13 10:00:00",
    "15 Jun 2012 16.52.52": "2012-06-15 16:52:52",
    "Fri, 15 Jun 2012 16:52:52 +0200 junk": "2012-06-15 16:52:52",
    "Fri, 15 Jun 2012 16:52:52 -0500 (Eastern": "2012-06-15 16:52:52",
    # Cut to 24 characters, a second digit is lost: kept as it is.
    "Fri, 15 Jun 2012 16:52:60": "2012-06-15 16:52:06",
    "Thu, 1 Jan 76 00:00:00": "1976-01-01 00:00:00",
    "Thu, 1 Jan 75 00:00:00": "2075-01-01 00:00:00",
    "Mon, 05 Jan 2009 12:01 AM": "2009-01-05 00:01:00",
    "20120605T165252": "2012-06-05 16:52:52",
    "15 Jun 2012": "2012-06-15 00:00:00",
    "31 Feb 2012 10:00": None,
    "Fr, 15 Jun 2012 16:52:52": None,
    "16:52": None,
    "June 2012": None,
    "": None,
    "abc": None,
    "1|2|3|4|5|6|7|8": None,
}


def _parsed(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string").repartition(4)
    rows = df.select("i", parse_date(F.col("s")).alias("d")).collect()
    return [r["d"] for r in sorted(rows)]


def test_shapes(spark):
    got = _parsed(spark, CASES)
    assert [None if d is None else str(d) for d in got] == list(CASES.values())


def test_second_look(spark):
    df = spark.createDataFrame([("16:52:52 15 Jun 2012",), ("16:52",), ("1 Jan 2001 1:02",)], "s string")
    filled = fill_unread_dates(df.withColumn("d", parse_date(F.col("s"))), "d", "s")
    got = {r["s"]: r["d"] and str(r["d"]) for r in filled.collect()}
    assert got["16:52:52 15 Jun 2012"] == "2012-06-15 16:52:52"
    assert got["16:52"] is None and got["1 Jan 2001 1:02"] == "2001-01-01 01:02:00"


def test_random_mail_dates_match_dateutil(spark):
    parser = pytest.importorskip("dateutil.parser")
    rng = random.Random(1)
    months = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()
    texts = []
    for _ in range(2000):
        day = rng.choice(["", "Mon, ", "Tue,", "Sat "])
        date = f"{rng.randint(1, 31)} {rng.choice(months)} {rng.randint(1976, 2026)}"
        clock = f"{rng.randint(0, 24):02d}:{rng.randint(0, 60):02d}:{rng.randint(0, 60):02d}"
        texts.append(f"{day}{date} {clock}{rng.choice(['', ' +0200', ' GMT', ' -0700 PDT', ' EDT', '+0100'])}")

    def reference(text):
        for attempt in (text, text.replace(".", ":"), text[:25].strip(), text[:24].strip()):
            try:
                return parser.parse(attempt, ignoretz=True)
            except ValueError:
                pass
        return None

    assert _parsed(spark, texts) == [reference(t) for t in texts]


def test_micros_do_not_depend_on_the_zone(spark):
    times = [
        dt.datetime(2018, 11, 4, 0, 30, 0, 123456),  # skipped by the session's zone
        dt.datetime(1901, 1, 1, 23, 59, 59, 999999),
        dt.datetime(1, 1, 1),
        dt.datetime(9999, 12, 31, 23, 59, 59, 999999),
    ]
    df = spark.createDataFrame([(t,) for t in times], "d timestamp_ntz")
    for row in df.select("d", to_micros(F.col("d")).alias("m")).withColumn("back", from_micros(F.col("m"))).collect():
        assert row["m"] == (row["d"] - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
        assert row["back"] == row["d"]
