"""What parsing means, in plain Python, to check the column expressions against.

Fixed values: the patterns below are the definition of trailers and patches.
"""

from __future__ import annotations

import re

TRAILER = re.compile(
    r"^(?P<type>[a-zA-Z\-]+-by):[ \t]*(?P<name>[^<\n]+?)[ \t]*<(?P<email>[^>\n]+)>",
    re.MULTILINE | re.IGNORECASE,
)
PATCHES = [
    re.compile(p, re.MULTILINE | re.IGNORECASE)
    for p in (
        r"(^---$[\s\S]*?^--\s*\n+^.*$)",
        r"(^---$[\s\S]*?^--[\s=]*$\n+^.*$)",
        r"(diff --git[\s\S]*?^--\s*\n+^.*$)",
        r"(^---$[\s\S]*?^--*[\S\s=]*$\n+^.*$)",
    )
]


def trailers(body: str) -> list[tuple[str, str]]:
    return [
        (m["type"], f"{m['name'].strip()} <{m['email'].strip()}>") for m in TRAILER.finditer(body)
    ]


def patches(body: str) -> list[str]:
    return next((found for p in PATCHES if (found := [m[0].strip() for m in p.finditer(body)])), [])


def parse(content: bytes) -> dict | None:
    """Header fields (name to list of values) and body; None for a dead letter."""
    try:
        text = content.decode("utf-8")
    except UnicodeDecodeError:
        return None
    lines = re.sub("\r\n?", "\n", text).splitlines()
    blank = next((i for i, line in enumerate(lines) if not line.strip()), len(lines))
    fields: list[list[str]] = []
    for line in lines[:blank]:
        if ":" in line and line[0] not in " \t":
            name, _, value = line.partition(":")
            fields.append([name.strip().lower(), value.strip()])
        elif fields:
            fields[-1][1] += " " + line.strip()
        else:
            return None
    named: dict[str, list[str]] = {}
    for name, value in fields:
        named.setdefault(name, []).append(value)
    return {"fields": named, "body": "\n".join(lines[blank + 1 :])}


def list_field(values: list[str], separator: str) -> list[str]:
    return values if len(values) > 1 else (values or [""])[0].split(separator)
