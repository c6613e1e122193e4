"""Which lists and which article numbers to work on."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Selects every list of the catalogue.
ALL_LISTS = "ALL"


class RangeError(ValueError):
    """An article range that cannot be read."""


class NoListsError(ValueError):
    """None of the requested lists is in the catalogue."""


def parse_range(text: str) -> list[tuple[int, int]]:
    """``"1,3-5"`` to ``[(1, 1), (3, 5)]``: inclusive, in the order given."""
    return [_parse_part(part.strip()) for part in text.split(",")]


def _parse_part(part: str) -> tuple[int, int]:
    if not part:
        raise RangeError("empty part in sequence")
    low, dash, high = part.partition("-")
    if not dash:
        number = _number(part)
        if number is None:
            raise RangeError(f"invalid number: '{part}'")
        return number, number
    first, last = _number(low.strip()), _number(high.strip())
    if first is None or last is None:
        raise RangeError(f"invalid range: '{part}'")
    if first > last:
        raise RangeError(f"descending range not allowed: {first}-{last}")
    return first, last


def _number(text: str) -> int | None:
    digits = text.removeprefix("+")
    if not (digits.isascii() and digits.isdigit()) or int(digits) >= 2**63:
        return None
    return int(digits)


def article_range(text: str, column: str | Column = "article_no") -> Column:
    """A filter for the article numbers that ``text`` names.

    Ranges that touch or overlap are merged first. Comparisons with literals
    reach the Parquet scan, so row groups outside the range are not read.
    """
    number = F.col(column) if isinstance(column, str) else column
    merged: list[list[int]] = []
    for low, high in sorted(parse_range(text)):
        if merged and low <= merged[-1][1] + 1:
            merged[-1][1] = max(merged[-1][1], high)
        else:
            merged.append([low, high])
    tests = [number == a if a == b else number.between(a, b) for a, b in merged]
    while len(tests) > 1:  # a balanced tree keeps long lists shallow
        tests = [
            tests[i] | tests[i + 1] if i + 1 < len(tests) else tests[i]
            for i in range(0, len(tests), 2)
        ]
    return tests[0]


def select_lists(
    catalogue: DataFrame, requested: Iterable[str], column: str = "list"
) -> tuple[DataFrame, DataFrame]:
    """The requested lists that exist, and those that do not.

    ``["ALL"]`` asks for the whole catalogue. Raises :class:`NoListsError`
    when nothing is left.
    """
    spark = catalogue.sparkSession
    wanted = list(dict.fromkeys(requested))
    schema = T.StructType([T.StructField(column, T.StringType())])
    known = catalogue.select(column).distinct()
    if wanted[:1] == [ALL_LISTS]:
        available, missing = known, spark.createDataFrame([], schema)
    else:
        names = spark.createDataFrame([(w,) for w in wanted], schema)
        # The requested names are the small side; they were typed in by hand.
        available = names.join(known, column, "left_semi")
        missing = names.join(known, column, "left_anti")
    if available.isEmpty():
        raise NoListsError("none of the requested lists is available")
    return available, missing
