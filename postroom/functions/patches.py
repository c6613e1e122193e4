"""Patches embedded in a body.

Four shapes are tried in order; the first that occurs gives all its matches.
A plain pattern search is quadratic on a body with many patch starts and no
end mark (quoted diffs, release notes full of rules). Cutting the body after
its last end mark first keeps every search linear and changes no match, for
a match cannot reach past that mark.
"""

from __future__ import annotations

from pyspark.sql import Column

from .text import LINE_START, LINE_STOP, SPACE_CLASS, let_sql, pattern, strip_sql, with_sql

# What starts and what ends a patch.
_RULE = rf"{LINE_START}---{LINE_STOP}"
_DIFF = r"(?iu:diff --git)"
_SIGNATURE = rf"{LINE_START}--[{SPACE_CLASS}]*\n[^\n]*"
_QUOTED_SIGNATURE = rf"{LINE_START}--[{SPACE_CLASS}=]*\n[^\n]*"
_LAST_RESORT = rf"{LINE_START}-(?s:.*)\n[^\n]*"


def _up_to_last(body: str, mark: str) -> str:
    """The body through its last ``mark``; ``""`` when there is none."""
    return f"regexp_extract({body}, {pattern(rf'\A(?s:.*){mark}')}, 0)"


def _all(body: str, start: str, end: str) -> str:
    """All matches from ``start`` to the nearest ``end``; null when none."""
    found = f"regexp_extract_all({body}, {pattern(rf'{start}(?s:.*?){end}')}, 0)"
    return let_sql(found, "m", "if(size(m) > 0, m, NULL)")


def extract_patches(body: Column) -> Column:
    """``array<string>`` of patches, each stripped; ``[]`` when there is none."""
    none = "cast(array() AS array<string>)"
    quoted_part = let_sql(
        _up_to_last("x", _QUOTED_SIGNATURE), "q", _all("q", _RULE, _QUOTED_SIGNATURE)
    )
    found = let_sql(
        _up_to_last("x", _SIGNATURE),
        "part",
        f"coalesce({_all('part', _RULE, _SIGNATURE)}, {quoted_part},"
        f" {_all('part', _DIFF, _SIGNATURE)}, {_all('x', _RULE, _LAST_RESORT)}, {none})",
    )
    # Most mails hold no "--" at all; a byte search settles those.
    stripped = f"transform({found}, p -> {strip_sql('p')})"
    return with_sql(body, "x", f"if(contains(x, '--'), {stripped}, {none})")
