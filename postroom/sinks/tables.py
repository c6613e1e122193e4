"""Writers for list-partitioned tables.

Rows are spread with a rebalance on the list: Spark measures the shuffle, cuts
a list that is too large into several files and puts small lists together, so
no task has to write a whole big list. Rows are ordered by date inside a file,
which lets date filters skip row groups.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .versions import PARTITION, Entry, Version, entries_of, new_run, replace, run_folder, split_root

# How the pseudonymised copy is stored. Level 22 is the smallest
# and slowest; files and pages are large, so that its set-up cost is spread.
ARCHIVE_LEVEL = 22
ARCHIVE_PAGE_BYTES = 4 * 1024 * 1024
#: Rows per file, so that one file holds about one row group of this size.
ARCHIVE_ROWS = 1024 * 1024

#: Writers that a list is spread over when Spark may not re-plan at run time.
FIXED_SPREAD = 64


def write_partitioned(
    df: DataFrame,
    root: str,
    mode: str = "overwrite",
    order_by: Iterable[str] = (),
    options: dict[str, str] | None = None,
    max_rows: int | None = None,
    fixed_spread: int = FIXED_SPREAD,
    whole_table: bool = False,
    above: tuple[str, ...] = (),
) -> None:
    """Write a table partitioned by list, and by the columns ``above`` it if there are any.

    ``overwrite`` replaces the lists that ``df`` holds and leaves others alone, or
    with ``whole_table`` everything; ``append`` adds files. ``max_rows`` bounds the
    rows of one file. ``fixed_spread`` counts only with run-time planning off: so
    many tasks share a list then.
    """
    folders = (*above, PARTITION)
    spread = _spread(df, fixed_spread, folders).sortWithinPartitions(*folders, *order_by)
    how = "static" if whole_table else "dynamic"
    writer = spread.write.mode(mode).option("partitionOverwriteMode", how)
    for name, value in (options or {}).items():
        writer = writer.option(name, value)
    if max_rows is not None:
        writer = writer.option("maxRecordsPerFile", max_rows)
    writer.partitionBy(*folders).parquet(root)


def write_run(df: DataFrame, home: str, **options) -> list[Entry]:
    """Write rows with their ``table`` and ``list`` into a run of its own; nobody reads it yet."""
    run = new_run()
    write_partitioned(df, run_folder(home, run), "errorifexists", above=("table",), **options)
    return entries_of(df.sparkSession, home, run)


def write_tables(
    df: DataFrame, home: str, replaced: Iterable[str], processed: Iterable[str] | None = None, **options
) -> Version:
    """Write rows of several tables of an archive and commit them together.

    Of the tables ``replaced``, ``processed`` lists (``None``: all) and those with
    rows now keep nothing older; rows of other tables are added.
    """
    return replace(df.sparkSession, home, write_run(df, home, **options), processed, replaced)


def replace_lists(
    df: DataFrame, root: str, processed: Iterable[str] | None = None, append: bool = False, **options
) -> Version:
    """Write ``df`` as the table ``root``; of ``processed`` lists (``None``: all) nothing
    older is left, or with ``append`` everything."""
    home, table = split_root(root)
    rows = df.withColumn("table", F.lit(table))
    return write_tables(rows, home, [] if append else [table], processed, **options)


def _spread(
    df: DataFrame, fixed_spread: int = FIXED_SPREAD, folders: tuple[str, ...] = (PARTITION,)
) -> DataFrame:
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true") == "true":
        return df.hint("rebalance", *folders)
    # Without run-time re-planning a hot list is salted up front, by content,
    # so that a task run again sends each row where it went before.
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in _salt_columns(df)]), F.lit(fixed_spread))
    return df.repartition(*folders, salt)


def _salt_columns(df: DataFrame) -> list[str]:
    preferred = [c for c in ("article_no", "message-id") if c in df.columns]
    return preferred or [c for c in df.columns if c != PARTITION]


def land_raw(
    raw: DataFrame, root: str, mode: str = "overwrite", processed: Iterable[str] | None = None
) -> None:
    """Gather small raw files into one Parquet table, a partition per list.

    ``overwrite`` replaces ``processed`` lists (``None``: all) whole.
    """
    columns = ("path", "modificationTime", "length", "content", "article_no", PARTITION)
    _write(raw.select(*columns), root, mode, processed, ["article_no"])


def write_mail(
    mail: DataFrame, root: str, mode: str = "overwrite", processed: Iterable[str] | None = None
) -> None:
    """Write parsed mails; ``processed`` lists (``None``: all) are replaced whole."""
    _write(mail, root, mode, processed, ["date"])


def _write(df, root, mode, processed, order_by) -> None:
    if mode not in ("overwrite", "append"):
        raise ValueError(f"unknown mode {mode}")
    replace_lists(df, root, processed, append=mode == "append", order_by=order_by)


def write_dead_letters(
    dead: DataFrame, root: str, processed: Iterable[str] | None = None
) -> None:
    """Write dead letters and clear those of earlier runs.

    ``processed`` names the lists that were parsed, ``None`` means all: a list may
    have no dead letter any more, and then its old ones go.
    """
    if processed is not None:
        processed = list(processed)
        dead = dead.where(F.col(PARTITION).isin(*processed))
    replace_lists(dead, root, processed)


def archive_options(level: int = ARCHIVE_LEVEL) -> dict[str, str]:
    """Parquet options of the pseudonymised copy."""
    return {
        "compression": "zstd",
        "parquet.compression.codec.zstd.level": str(level),
        "parquet.page.size": str(ARCHIVE_PAGE_BYTES),
    }


def write_archive(
    datasets: dict[str, DataFrame],
    root: str,
    level: int = ARCHIVE_LEVEL,
    max_rows: int = ARCHIVE_ROWS,
    processed: Iterable[str] | None = None,
) -> None:
    """Write the pseudonymised datasets, each under its own name, in one commit.

    ``processed`` lists (``None``: all) are replaced whole: one that was withdrawn
    leaves the copy and the identity maps at the same moment.
    """
    written = []
    for name, df in datasets.items():
        rows = df.withColumn("table", F.lit(name))
        written += write_run(rows, root, options=archive_options(level), max_rows=max_rows)
    if datasets:
        spark = next(iter(datasets.values())).sparkSession
        replace(spark, root, written, processed, datasets)


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write a small result as a single file; rows are few by construction."""
    writer = df.coalesce(1).write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", "true").csv(path)
    else:
        writer.format(fmt).save(path)
