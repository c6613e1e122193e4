from __future__ import annotations

import pytest

from postroom.sources import NoListsError, RangeError, article_range, parse_range, select_lists


@pytest.mark.parametrize(
    ("text", "pairs"),
    [
        ("1,5,10", [(1, 1), (5, 5), (10, 10)]),
        ("3-7", [(3, 7)]),
        (" 1, 2 - 4 , 6 ", [(1, 1), (2, 4), (6, 6)]),
        ("5-5", [(5, 5)]),
        ("7,1-3,2", [(7, 7), (1, 3), (2, 2)]),
    ],
)
def test_ranges(text, pairs):
    assert parse_range(text) == pairs


@pytest.mark.parametrize(
    ("text", "message"),
    [
        *[(t, "empty part") for t in ("", " ", ",", "1,,5", ",1,5", "1,5,")],
        ("1,foo,5", "invalid number: 'foo'"),
        *[(t, f"invalid range: '{t}'") for t in ("a-5", "1-bar", "-42", "1-2-3")],
        ("20-10", "descending range not allowed: 20-10"),
        ("9223372036854775808", "invalid number"),
    ],
)
def test_bad_ranges_raise(text, message):
    with pytest.raises(RangeError, match=message):
        parse_range(text)


def test_range_filter(spark, tmp_path):
    spark.range(50).withColumnRenamed("id", "article_no").write.parquet(str(tmp_path / "n"))
    numbers = spark.read.parquet(str(tmp_path / "n"))
    kept = numbers.where(article_range("4,1,2-3,3,10-12,49"))
    assert sorted(r[0] for r in kept.collect()) == [1, 2, 3, 4, 10, 11, 12, 49]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(article_no,1)" in plan  # reaches the scan


def test_many_parts_stay_shallow(spark):
    text = ",".join(str(n) for n in range(0, 4000, 2))
    assert spark.range(5000).where(article_range(text, "id")).count() == 2000


def test_select_lists(spark):
    catalogue = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "list string")

    def names(df):
        return sorted(r[0] for r in df.collect())

    available, missing = select_lists(catalogue, ["b", "x", "b", "a"])
    assert (names(available), names(missing)) == (["a", "b"], ["x"])
    available, missing = select_lists(catalogue, ["ALL"])
    assert (names(available), names(missing)) == (["a", "b", "c"], [])
    with pytest.raises(NoListsError):
        select_lists(catalogue, ["x", "y"])
