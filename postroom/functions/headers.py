"""Header block: unfolding, fields, single and list values.

The header of a mail is everything before the first blank line. A line that
starts with a space or tab, or has no colon, carries on the field above it.
Cutting the block before each line that *does* start a field gives the fields
in order, repeated ones included, without a row-wise loop.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import INLINE_CLASS, INLINE_SPACE, WHITE_SPACE, let_sql, pattern, quoted, strip_sql, with_sql

# First blank line of a text, together with the line ends around it.
_BLANK_LINE = rf"(?:\A|\n)[{INLINE_CLASS}]*(?:\n|\z)"
# "\n" in front of a line that starts a field.
_FIELD_BREAK = r"\n(?![ \t])(?=[^\n:]*:)"
# A block that starts with a field.
_FIELD_FIRST = r"\A(?![ \t])[^\n:]*:"
# A line end inside a field, with the white space around it.
_FOLD = rf"(?<![{INLINE_CLASS}])[{INLINE_CLASS}]*+\n[{INLINE_CLASS}]*+"

_NEWLINE = quoted("\n")


def split_message_sql(text: str) -> str:
    """See :func:`split_message`."""
    return f"split({text}, {pattern(_BLANK_LINE)}, 2)"


def header_is_malformed_sql(head: str) -> str:
    """See :func:`header_is_malformed`."""
    return f"({head} <> '' AND NOT rlike({head}, {pattern(_FIELD_FIRST)}))"


def split_message(text: Column) -> Column:
    """``[header, body]``; one item only when there is no blank line."""
    return with_sql(text, "x", split_message_sql("x"))


def header_is_malformed(head: Column) -> Column:
    """True when the first line continues a field that does not exist."""
    return with_sql(head, "x", header_is_malformed_sql("x"))


def header_fields(head: Column, names: Iterable[str]) -> Column:
    """The named fields as ``array<struct<name,value>>``, in order of appearance."""
    wanted = ", ".join(quoted(n) for n in names)
    name = f"lower({strip_sql(field_name('b'))})"
    named = f"transform(split(x, {pattern(_FIELD_BREAK)}), b -> struct({name} AS name, b AS block))"
    kept = f"filter({named}, f -> f.name IN ({wanted}))"
    return with_sql(
        head, "x", f"transform({kept}, f -> struct(f.name AS name, {_field_value('f.block')} AS value))"
    )


def field_name(block: str) -> str:
    """The part of a field in front of its colon."""
    return f"substring_index({block}, ':', 1)"


def _field_value(block: str) -> str:
    # Strip the first line on its own before folding: "X:" + " y" is " y".
    rest = f"substring({block}, instr({block}, ':') + 1)"
    trimmed = (
        f"trim(TRAILING {quoted(WHITE_SPACE)} FROM trim(LEADING {quoted(INLINE_SPACE)} FROM {rest}))"
    )
    folded = f"if(contains(v, {_NEWLINE}), regexp_replace(v, {pattern(_FOLD)}, ' '), v)"
    return let_sql(trimmed, "v", folded)


def _values(name: str) -> str:
    return f"transform(filter(x, f -> f.name = {quoted(name)}), f -> f.value)"


def values_of(fields: Column, name: str) -> Column:
    """All values of one field, in order."""
    return with_sql(fields, "x", _values(name))


def first_value(fields: Column, name: str) -> Column:
    """The first value of a field; ``""`` when it is absent."""
    return F.coalesce(with_sql(fields, "x", f"get({_values(name)}, 0)"), F.lit(""))


def list_value(fields: Column, name: str, separator: str) -> Column:
    """A list field.

    One occurrence is split at the separator, items as they stand (so an
    absent field is ``[""]``); several occurrences are kept whole, one each.
    """
    once = f"split(coalesce(get(v, 0), ''), {pattern(re.escape(separator))})"
    body = let_sql(_values(name), "v", f"if(size(v) > 1, v, {once})")
    return with_sql(fields, "x", body)
