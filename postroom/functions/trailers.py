"""Review trailers: ``Reviewed-by: Name <mail>`` lines of a body."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let_sql, pattern, strip_sql, with_sql

# Fixed value: a trailer line. Letters include the four characters that fold
# to an ASCII letter when case is ignored.
_TRAILER = r"(?md)^[A-Za-z\x{130}\x{131}\x{17f}\x{212a}-]+-[bB][yY]:[^<\n]++<[^>\n]++>"


def extract_trailers(body: Column) -> Column:
    """``array<struct<attribution,identification>>``, in order; ``[]`` when none.

    A tag without a name and an address in angle brackets is not a trailer.
    """

    # The match ends with ">", and the address itself has none.
    name = strip_sql("substring_index(p, '<', 1)")
    address = strip_sql("trim(TRAILING '>' FROM substring(p, instr(p, '<') + 1))")
    identification = let_sql(
        "substring(line, instr(line, ':') + 1)", "p", f"concat({name}, ' <', {address}, '>')"
    )
    trailer = (
        "struct(substring_index(line, ':', 1) AS attribution,"
        f" {identification} AS identification)"
    )
    found = f"regexp_extract_all(x, {pattern(_TRAILER)}, 0)"
    return with_sql(body, "x", f"transform({found}, line -> {trailer})")


def is_reviewed(attribution: Column) -> Column:
    """Prefix match: ``Reviewed-by`` and anything that starts so."""
    return F.startswith(F.lower(attribution), F.lit("reviewed-by"))


def is_tested(attribution: Column) -> Column:
    """Prefix match; ``Reviewed-and-tested-by`` is neither reviewed nor tested."""
    return F.startswith(F.lower(attribution), F.lit("tested-by"))


def count_reviewed(trailers: Column) -> Column:
    """Number of reviewed-by trailers of one mail."""
    return F.size(F.filter(trailers, lambda t: is_reviewed(t["attribution"]))).cast("long")


def count_tested(trailers: Column) -> Column:
    """Number of tested-by trailers of one mail."""
    return F.size(F.filter(trailers, lambda t: is_tested(t["attribution"]))).cast("long")
