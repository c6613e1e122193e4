"""The parsed dataset and its side tables, partitioned by ``list``."""

from __future__ import annotations

import warnings
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import DEAD_SCHEMA, MAIL_SCHEMA, STORED_MAIL_SCHEMA
from ..sinks.versions import NO_NAME, PARTITION, has_versions, read_table, table_folders
from .files import list_folders, probe
from .raw import tolerance


def read_mail(
    spark: SparkSession,
    root: str,
    lists: Iterable[str] | None = None,
    with_article: bool = False,
    tolerant: bool = False,
) -> DataFrame:
    """Read parsed mails; ``lists`` prunes partitions before any file is opened."""
    schema = STORED_MAIL_SCHEMA if with_article else MAIL_SCHEMA
    return _partitioned(spark, root, schema, lists, tolerant)


def read_dead_letters(
    spark: SparkSession, root: str, lists: Iterable[str] | None = None, tolerant: bool = False
) -> DataFrame:
    """Read the mails that failed to parse."""
    return _partitioned(spark, root, DEAD_SCHEMA, lists, tolerant)


def read_identity_map(
    spark: SparkSession,
    root: str,
    column: str = "from",
    lists: Iterable[str] | None = None,
    tolerant: bool = False,
) -> DataFrame:
    """Read an identity map: original value, pseudonym, list."""
    names = (f"__original_{column}", column, "list")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return _partitioned(spark, root, schema, lists, tolerant)


def unreadable_files(spark: SparkSession, root: str) -> DataFrame:
    """list, path, error of the files of a table that can't be opened, found by tasks."""
    folders = table_folders(spark, root)
    if not folders and not has_versions(spark, root):  # a plain list-partitioned folder
        prefix = f"{PARTITION}="
        names = [n for n in list_folders(root) if n.startswith(prefix)]
        folders = {_list_of(n.removeprefix(prefix)): [f"{root}/{n}"] for n in names}
    return probe(spark, folders)


def _list_of(folder: str) -> str:
    return "" if folder == NO_NAME else unquote(folder)


def read_tolerant(spark: SparkSession, root: str, schema: T.StructType = MAIL_SCHEMA):
    """The lists of a table that can be read, and a report on those that can't.

    A list with a file that can't be opened is left out whole. Returns the mails
    and (list, files, errors); names of skipped lists go through the driver.
    """
    report = (
        unreadable_files(spark, root)
        .groupBy("list")
        .agg(F.count(F.lit(1)).alias("files"), F.array_sort(F.collect_set("error")).alias("errors"))
    )
    rows = report.collect()
    skipped = [r["list"] for r in rows]
    for name in skipped:
        warnings.warn(f"list {name!r} can't be read, skipped", stacklevel=2)
    readable = read_table(spark, root, schema, without=skipped)
    return readable, spark.createDataFrame(rows, report.schema)


def list_names(dataset: DataFrame) -> DataFrame:
    """The lists a dataset holds.

    Only the partition column is read, so Parquet footers are enough.
    """
    return dataset.select("list").distinct()


def _partitioned(spark, root, schema, lists, tolerant) -> DataFrame:
    return read_table(spark, root, schema, lists, tolerance(tolerant))
