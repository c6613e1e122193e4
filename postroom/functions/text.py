"""White space, line ends and small list helpers as column expressions.

Python's ``str.strip`` and ``\\s`` know more white space than SQL ``trim``
and Java's ``\\s``; the character lists below spell it out once, so that no
pattern needs the slow Unicode flag.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points of the white space that ends a line, and of the
# white space inside one.
_LINE_END_POINTS = (0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x85, 0x2028, 0x2029)
_INLINE_POINTS = (0x09, 0x1F, 0x20, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000)

LINE_ENDS = "".join(map(chr, _LINE_END_POINTS))
INLINE_SPACE = "".join(map(chr, _INLINE_POINTS))
WHITE_SPACE = LINE_ENDS + INLINE_SPACE

# The same sets as bodies of Java character classes.
INLINE_CLASS = r"\t\x1f \x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}"
SPACE_CLASS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

# A line start and a line end where only "\n" ends a line. Unlike Java's
# multi-line anchors these also hold after a final "\n".
LINE_START = r"(?<![^\n])"
LINE_STOP = r"(?![^\n])"

_RARE_LINE_ENDS = [c for c in LINE_ENDS if c != "\n"]
_RARE_LINE_END = r"[\x0b\x0c\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"


# --- SQL text --------------------------------------------------------------
# Longer expressions are written as SQL text and handed to Spark in one piece:
# putting the same thing together from hundreds of Column calls takes seconds
# on the driver before anything runs.


def quoted(text: str) -> str:
    """A SQL string literal with every character escaped that needs it."""
    plain = set("\\'\"") ^ {chr(c) for c in range(0x20, 0x7F)}
    return "'" + "".join(c if c in plain else f"\\u{ord(c):04x}" for c in text) + "'"


def pattern(regex: str) -> str:
    """A SQL literal for a regular expression, taken as it stands."""
    if "'" in regex:
        raise ValueError("a pattern must not hold a quote")
    return f"r'{regex}'"


def let_sql(value: str, name: str, body: str) -> str:
    """``body`` with ``value`` bound to ``name``, so it is computed once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def with_sql(value: Column, name: str, body: str) -> Column:
    """The SQL expression ``body`` in which ``name`` stands for ``value``."""
    bound = F.call_function("transform", F.array(value), F.expr(f"{name} -> {body}"))
    return F.get(bound, 0)


def strip_sql(value: str) -> str:
    """See :func:`strip`."""
    return f"btrim({value}, {quoted(WHITE_SPACE)})"


def unify_line_ends_sql(text: str) -> str:
    """See :func:`unify_line_ends`."""
    rare = " OR ".join(f"contains(t, {quoted(c)})" for c in _RARE_LINE_ENDS)
    rest = f"if({rare}, regexp_replace(t, {pattern(_RARE_LINE_END)}, {quoted(chr(10))}), t)"
    return let_sql(f"replace({text}, {quoted(chr(13) + chr(10))}, {quoted(chr(10))})", "t", rest)


def drop_final_newline_sql(text: str) -> str:
    """See :func:`drop_final_newline`."""
    body = f"if(endswith(b, {quoted(chr(10))}), substring(b, 1, length(b) - 1), b)"
    return let_sql(text, "b", body)


# --- columns ---------------------------------------------------------------


def strip(value: Column) -> Column:
    """Drop Unicode white space at both ends."""
    return F.btrim(value, F.lit(WHITE_SPACE))


def unify_line_ends(text: Column) -> Column:
    """Turn every line end that ``str.splitlines`` knows into ``\\n``.

    Past CRLF they are so rare that looking for their bytes first, which needs
    no decoding, is cheaper than running a pattern over every mail.
    """
    return with_sql(text, "x", unify_line_ends_sql("x"))


def drop_final_newline(text: Column) -> Column:
    """A final line end closes the last line; it does not open an empty one."""
    return with_sql(text, "x", drop_final_newline_sql("x"))


def decode_utf8(content: Column) -> Column:
    """Strict UTF-8: null where the bytes are not valid."""
    return F.try_validate_utf8(content.cast("string"))


def split_trimmed(value: Column, separator: str = ",") -> Column:
    """``"a, b"`` to ``["a", "b"]``: split, each item stripped."""
    return F.transform(F.split(value, "\\Q" + separator + "\\E"), strip)


def join_list(value: Column, separator: str = ", ") -> Column:
    """``["a", "b"]`` to ``"a, b"``."""
    return F.array_join(value, separator)
