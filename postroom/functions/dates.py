"""Mail dates to naive timestamps.

The sender's wall clock is kept and the zone dropped. A date that does not
parse as it stands is tried again with dots as colons, then cut to 25 and to
24 characters, the lengths of ``Fri, 15 Jun 2012 16:52:52`` and of its form
with a one-digit day. Day, month and year must all be present; nothing is
filled in from today's date, so a re-run gives the same result.

Each shape rewrites a matching text to ``year|month|day|h|m|s|fraction|ampm``
in one pattern pass; a text that no shape knows comes through without a bar.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let_sql, pattern, strip_sql, with_sql

_MICROS_PER_DAY = 86_400_000_000

# English month and weekday names, whole or cut to three letters.
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_MONTH = (
    r"((?i:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?"
    r"|sep(?:t(?:ember)?)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?))"
)
_WEEKDAY = (
    r"(?:(?i:mon(?:day)?|tue(?:sday)?|wed(?:nesday)?|thu(?:rsday)?|fri(?:day)?"
    r"|sat(?:urday)?|sun(?:day)?)[\s,.]+)?"
)
# Lengths the text is cut to when it does not parse whole.
DATE_CUTS = (25, 24)
# Two-digit years from here on are 19xx.
_PIVOT_YEAR = 76
_SHORTEST = 5

_DAY = r"(\d{1,2})(?i:st|nd|rd|th)?"
_SEP = r"[\s,./-]+"
_BEFORE_TIME = r"[\s,]+(?:at\s+)?"
# An hour on its own has two digits, or an AM or PM; "4.30 PM" reads as 4 PM.
_HOUR = r"(\d{1,2}(?=:\d)|\d{2}(?=$)|\d{1,2}(?=(?:\.\d+)?\s*[AaPp][Mm]))"
_CLOCK = rf"{_HOUR}(?::(\d{{1,2}})(?::(\d{{1,2}})(?:\.(\d{{1,6}})\d*)?)?|\.\d+)?"
_TIME = rf"{_CLOCK}(?:\s*([AaPp][Mm]))?"
_ZONE = r"(?:(?:Z|(?![AP]M)[A-Z]{2,5})?\s*(?:[+-](?:\d{4}|\d{1,2}(?::\d{1,2})?))?)"
_TAIL = rf"\s*{_ZONE}[\s,;.]*"

# (pattern, rewrite); "?" marks a numeric month that is the day when above 12.
_SHAPES = (
    # Fri, 15 Jun 2012 16:52:52 +0200
    (
        rf"^{_WEEKDAY}{_DAY}{_SEP}{_MONTH}{_SEP}(\d{{1,4}})(?:{_BEFORE_TIME}{_TIME}{_TAIL})?$",
        r"$3|$2|$1|$4|$5|$6|$7|$8",
    ),
    # Fri Jun 15 16:52:52 CEST 2012
    (
        rf"^{_WEEKDAY}{_MONTH}{_SEP}{_DAY}{_BEFORE_TIME}{_TIME}\s+(?:[A-Z]{{2,5}}\s+)?(\d{{4}}){_TAIL}$",
        r"$8|$1|$2|$3|$4|$5|$6|$7",
    ),
    # Jun 15, 2012 at 4:52 PM
    (
        rf"^{_WEEKDAY}{_MONTH}{_SEP}{_DAY}{_SEP}(\d{{1,4}})(?:{_BEFORE_TIME}{_TIME}{_TAIL})?$",
        r"$3|$1|$2|$4|$5|$6|$7|$8",
    ),
    # 2012-06-15T16:52:52Z
    (
        rf"^{_WEEKDAY}(\d{{4}})[-/.](\d{{1,2}})[-/.](\d{{1,2}})(?:(?:T|{_BEFORE_TIME}){_TIME}{_TAIL})?$",
        r"$1|$2|$3|$4|$5|$6|$7|$8",
    ),
    # 6/15/2012 4:52 PM
    (
        rf"^{_WEEKDAY}(\d{{1,2}})[-/.](\d{{1,2}})[-/.](\d{{2}}|\d{{4}})(?:{_BEFORE_TIME}{_TIME}{_TAIL})?$",
        r"$3|?$1|$2|$4|$5|$6|$7|$8",
    ),
    # 20120615T165252
    (
        rf"^(\d{{4}})(\d{{2}})(\d{{2}})T?(\d{{2}})(\d{{2}})(\d{{2}})?{_TAIL}$",
        r"$1|$2|$3|$4|$5|$6||",
    ),
)


def clean_date(value: Column) -> Column:
    """Strip, drop a comment from its ``(`` on; null when too short to be a date."""
    return with_sql(value, "x", _clean("x"))


def parse_date(value: Column) -> Column:
    """A ``Date`` header to ``timestamp_ntz``; null when no attempt parses."""
    cuts = [strip_sql(f"left(d, {n})") for n in DATE_CUTS]
    tries = ", ".join(["d", "replace(d, '.', ':')", *cuts])
    # The first that parses; once there is one, the rest are not looked at.
    first = (
        f"aggregate(array({tries}), cast(NULL AS timestamp_ntz),"
        f" (found, s) -> coalesce(found, {_timestamp('s')}))"
    )
    return with_sql(value, "x", let_sql(_clean("x"), "d", first))


def _clean(value: str) -> str:
    bare = strip_sql(f"substring_index({value}, '(', 1)")
    return let_sql(bare, "b", f"if(length(b) >= {_SHORTEST}, b, NULL)")


def _timestamp(text: str) -> str:
    rewritten = f"if(contains({text}, '|'), NULL, {text})"
    for shape, rewrite in _SHAPES:
        rewritten = f"regexp_replace({rewritten}, {pattern(shape)}, {pattern(rewrite)})"
    fields = let_sql(rewritten, "r", "if(contains(r, '|'), split(r, '[|]'), NULL)")
    return let_sql(fields, "f", _assemble("f"))


def _assemble(f: str) -> str:
    """The timestamp of the eight fields; null when one is out of range."""
    numbers = ", ".join(f"try_cast(ltrim('?', {f}[{i}]) AS int) AS n{i}" for i in (0, 1, 2, 3, 4))
    year = (
        f"CASE WHEN n.n0 >= 100 THEN n.n0 WHEN n.n0 >= {_PIVOT_YEAR} THEN n.n0 + 1900"
        " ELSE n.n0 + 2000 END"
    )
    name = f"lower(left({f}[1], 3))"
    swapped = f"(startswith({f}[1], '?') AND n.n1 > 12)"
    named = f"cast((instr('{_MONTHS}', {name}) + 2) / 3 AS int)"
    month = f"CASE WHEN {swapped} THEN n.n2 WHEN n.n1 IS NULL THEN {named} ELSE n.n1 END"
    day = f"if({swapped}, n.n1, n.n2)"
    hour = (
        f"CASE WHEN {f}[7] = '' THEN coalesce(n.n3, 0) WHEN n.n3 > 12 THEN NULL"
        f" WHEN lower({f}[7]) = 'am' THEN n.n3 % 12 ELSE n.n3 % 12 + 12 END"
    )
    seconds = f"cast(concat(if({f}[5] = '', '0', {f}[5]), '.', {f}[6], '0') AS decimal(8, 6))"
    made = f"try_make_timestamp_ntz({year}, {month}, {day}, {hour}, coalesce(n.n4, 0), s)"
    return let_sql(
        f"struct({numbers})", "n", let_sql(seconds, "s", f"if(s < 60, {made}, NULL)")
    )


def to_micros(date: Column) -> Column:
    """Microseconds since 1970 of a naive timestamp, whatever the session zone."""
    day = F.unix_date(date.cast("date")).cast("long") * _MICROS_PER_DAY
    clock = (F.hour(date) * 3600 + F.minute(date) * 60).cast("long") * 1_000_000
    seconds = (F.extract(F.lit("SECOND"), date) * 1_000_000).cast("long")
    return day + clock + seconds


def from_micros(micros: Column) -> Column:
    """The naive timestamp that many microseconds after 1970."""
    day = F.floor(micros / F.lit(_MICROS_PER_DAY).cast("decimal(20,0)")).cast("int")
    rest = F.pmod(micros, F.lit(_MICROS_PER_DAY))
    return F.date_from_unix_date(day).cast("timestamp_ntz") + F.make_dt_interval(
        secs=(rest.cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    )
