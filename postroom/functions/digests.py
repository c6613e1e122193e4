"""Digests for pseudonyms."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import strip


def sha1_digest(value: Column, normalise: bool = False) -> Column:
    """SHA-1 hex of the UTF-8 text as it stands; null stays null.

    ``normalise`` strips and lower-cases first, so that one address has one
    digest wherever it occurs.
    """
    return F.sha1(F.lower(strip(value)) if normalise else value)


_BLOCK = 64  # bytes that SHA-256 takes at a time

# Columns that hold a secret while digests are made.
INNER, OUTER = "__digest_inner", "__digest_outer"


def with_secret(df: DataFrame, key: str | bytes) -> DataFrame:
    """Add the two padded forms of a key, for :func:`keyed_digest`.

    They come from a one-row table by subquery, so no plan or log shows the key.
    """
    raw = key.encode() if isinstance(key, str) else bytes(key)
    raw = hashlib.sha256(raw).digest() if len(raw) > _BLOCK else raw
    raw = raw.ljust(_BLOCK, b"\0")
    row = [bytearray(b ^ pad for b in raw) for pad in (0x36, 0x5C)]
    secret = df.sparkSession.createDataFrame([row], "inner binary, outer binary")
    return df.withColumns(
        {INNER: secret.select("inner").scalar(), OUTER: secret.select("outer").scalar()}
    )


def keyed_digest(value: Column, normalise: bool = False) -> Column:
    """HMAC-SHA256 hex of the UTF-8 text, by the secret of :func:`with_secret`.

    A plain digest of a mail address can be undone by trying known addresses;
    with a key that stays out of the published data it cannot.
    """
    text = F.encode(F.lower(strip(value)) if normalise else value, "UTF-8")
    inner = F.unhex(F.sha2(F.concat(F.col(INNER), text), 256))
    return F.sha2(F.concat(F.col(OUTER), inner), 256)
