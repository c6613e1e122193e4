"""Pseudonymised copies of the dataset, and the maps back.

All of it is one narrow pass: digests are built-in functions applied to
scalars, list items and struct fields inside lists; nothing is shuffled.

Note what stays in clear: ``subject``, ``raw_body`` and ``code`` quote the same
people. A plain SHA-1 of an address can be undone by hashing known addresses;
pass ``key`` for an HMAC-SHA256 when the copy leaves the house. No plan shows it.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.digests import INNER, OUTER, keyed_digest, sha1_digest, with_secret

# What is hashed by default, and what gets a map.
HASHED_COLUMNS = ("from", "to", "cc")
HASHED_FIELDS = ("trailers.identification",)
MAPPED_COLUMNS = ("from",)

MAIN_DATASET = "__main_dataset"
MAP_PREFIX = "__id_map_"
ORIGINAL_PREFIX = "__original_"

Digest = Callable[[Column], Column]


def _digest(df: DataFrame, key: str | bytes | None, normalise: bool) -> tuple[DataFrame, Digest]:
    """The digest to use, plain SHA-1 or keyed, and the data with what it needs."""
    if key is None:
        return df, partial(sha1_digest, normalise=normalise)
    return with_secret(df, key), partial(keyed_digest, normalise=normalise)


def hash_columns(
    df: DataFrame,
    columns: Iterable[str] = HASHED_COLUMNS,
    fields: Iterable[str] = HASHED_FIELDS,
    key: str | bytes | None = None,
    normalise: bool = False,
) -> DataFrame:
    """Replace identities by digests.

    ``columns`` are strings or lists of strings; ``fields`` are ``column.field``
    paths into structs or lists of structs, whose other fields are kept. A name
    the data lacks is warned about and skipped; a type that cannot be hashed
    raises before anything runs.
    """
    keyed, hashed = _digest(df, key, normalise)
    types = {f.name: f.dataType for f in df.schema.fields}
    new: dict[str, Column] = {}
    for name in columns:
        if name not in types:
            warnings.warn(f"column {name!r} is not in the data, skipped", stacklevel=2)
            continue
        new[name] = _hash_value(_quoted(name), types[name], hashed, name)
    for path in fields:
        name, _, field = path.partition(".")
        if not _has_field(types.get(name), field):
            warnings.warn(f"field {path!r} is not in the data, skipped", stacklevel=2)
            continue
        new[name] = _hash_field(new.get(name, _quoted(name)), types[name], field, hashed, path)
    return keyed.withColumns(new).drop(INNER, OUTER) if new else df


def identity_map(
    df: DataFrame,
    column: str = "from",
    key: str | bytes | None = None,
    normalise: bool = False,
    distinct: bool = False,
) -> DataFrame:
    """Original value and pseudonym, one row per mail (or per pair and list)."""
    if not isinstance(df.schema[column].dataType, T.StringType):
        raise TypeError(f"an identity map needs a string column, not {column!r}")
    keyed, hashed = _digest(df, key, normalise)
    pairs = keyed.select(
        _quoted(column).alias(ORIGINAL_PREFIX + column),
        hashed(_quoted(column)).alias(column),
        "list",
    )
    return pairs.distinct() if distinct else pairs


def pseudonymised_datasets(
    df: DataFrame,
    columns: Iterable[str] = HASHED_COLUMNS,
    fields: Iterable[str] = HASHED_FIELDS,
    mapped: Iterable[str] = MAPPED_COLUMNS,
    key: str | bytes | None = None,
    normalise: bool = False,
) -> dict[str, DataFrame]:
    """The main dataset and one identity map per mapped column, by name."""
    result = {MAIN_DATASET: hash_columns(df, columns, fields, key, normalise)}
    for name in mapped:
        result[MAP_PREFIX + name] = identity_map(df, name, key, normalise)
    return result


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def _has_field(dtype: T.DataType | None, field: str) -> bool:
    if isinstance(dtype, T.ArrayType):
        dtype = dtype.elementType
    # Anything but a struct is left to the type check that raises.
    return dtype is not None and (
        not isinstance(dtype, T.StructType) or field in dtype.fieldNames()
    )


def _hash_value(value: Column, dtype: T.DataType, hashed: Digest, name: str) -> Column:
    if isinstance(dtype, T.StringType):
        return hashed(value)
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StringType):
        return F.transform(value, lambda item: hashed(item))
    raise TypeError(f"cannot hash {name!r} of type {dtype.simpleString()}")


def _hash_field(
    value: Column, dtype: T.DataType, field: str, hashed: Digest, path: str
) -> Column:
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: _hash_field(x, dtype.elementType, field, hashed, path))
    if isinstance(dtype, T.StructType):
        inner = _hash_value(value.getField(field), dtype[field].dataType, hashed, path)
        return F.when(value.isNotNull(), value.withField(f"`{field}`", inner))
    raise TypeError(f"cannot hash {path!r}: {dtype.simpleString()} has no fields")
