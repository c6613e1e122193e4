"""Raw mails: one file each under ``<root>/<list>/<number>.eml``, or landed.

Tens of millions of small files are slow to list and open, so a large archive
is landed once into a Parquet table (:func:`postroom.sinks.land_raw`) and
parsed from there; both readers give the same columns.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import RAW_SCHEMA
from ..sinks.versions import read_table

# Only mails match, which leaves out control files such as article counters,
# error logs and notes that share the directory.
MAIL_GLOB = "*.eml"
_PATH_PARTS = r"/([^/]+)/([^/]+)\.eml$"


def with_origin(files: DataFrame) -> DataFrame:
    """Add ``list`` and ``article_no`` (null when not a number), both from ``path``."""
    number = F.regexp_extract("path", _PATH_PARTS, 2).try_cast("long")
    return files.select(
        "path",
        "modificationTime",
        "length",
        "content",
        number.alias("article_no"),
        F.regexp_extract("path", _PATH_PARTS, 1).alias("list"),
    )


def read_raw(
    spark: SparkSession,
    root: str,
    lists: Iterable[str] | None = None,
    tolerant: bool = False,
) -> DataFrame:
    """Scan raw mail files.

    ``lists`` limits the directory listing itself to those lists. ``tolerant``
    skips files that vanish or cannot be read instead of failing.
    """
    roots = [root] if lists is None else [f"{root}/{name}" for name in lists]
    reader = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", MAIL_GLOB)
        .option("recursiveFileLookup", "true")
    )
    return with_origin(reader.options(**tolerance(tolerant)).load(roots))


def read_landed(
    spark: SparkSession, root: str, lists: Iterable[str] | None = None, tolerant: bool = False
) -> DataFrame:
    """Read the landed raw table; ``lists`` prunes its partitions."""
    return read_table(spark, root, RAW_SCHEMA, lists, tolerance(tolerant))


def tolerance(tolerant: bool) -> dict[str, str]:
    """Reader options that pass over files which vanish or can't be read."""
    return {"ignoreCorruptFiles": "true", "ignoreMissingFiles": "true"} if tolerant else {}
