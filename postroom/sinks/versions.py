"""Tables whose lists are replaced as versions, with one commit.

The tables of an archive share a home folder: table ``<home>/parsed`` is the
table ``parsed`` of ``<home>``. A write puts its rows into a run folder of its
own, ``<home>/runs/run=<id>/table=<name>/list=<name>/``, and touches nothing that
a reader may be reading. A commit then adds one small file to ``<home>/versions``
that names, for every table and list, the runs which hold it. That file appears
at once or not at all, and readers follow the newest version: they see the state
before a rewrite or after it, for all tables of the archive, and never both. A
reader keeps the files of the version it began with. Whatever a crash leaves
behind before the commit is a run that no version names.

A commit is checked after it is written: of two that claim one version the first
file counts, and the writer of the other one commits again on top of it.

Mails without a list name are kept under the empty name, and read back so.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTITION = "list"
_VERSION = "version long, commit string, table string, list string, run string, rows long, batch long"
#: How often a commit is tried again when others came first.
_TRIES = 20


@dataclass(frozen=True)
class Entry:
    """One run that holds rows of a list of a table, and the ingest batch they came in."""

    table: str
    list: str
    run: str
    rows: int
    batch: int | None = None


@dataclass(frozen=True)
class Version:
    """What one commit says: at most tables x lists entries, and more after appends."""

    number: int
    commit: str
    entries: tuple[Entry, ...]


def split_root(root: str) -> tuple[str, str]:
    """Home folder and table name of ``<home>/<table>``."""
    home, _, table = root.rstrip("/").rpartition("/")
    if not home or not table:
        raise ValueError(f"{root}: a table needs a folder and a name")
    return home, table


def list_name() -> Column:
    """The partition column with the unnamed list as an empty text."""
    return F.coalesce(F.col(PARTITION), F.lit(""))


def current_version(spark: SparkSession, home: str) -> Version | None:
    """The newest version, ``None`` before the first commit."""
    try:
        commits = spark.read.schema(_VERSION).parquet(f"{home}/versions")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    written = F.col("_metadata.file_modification_time")
    first = F.min_by(F.struct("version", "commit"), F.struct(-F.col("version"), written, "commit"))
    newest = commits.agg(first.alias("first")).first()["first"]
    if newest is None:
        return None
    of_it = (F.col("version") == newest["version"]) & (F.col("commit") == newest["commit"])
    rows = commits.where(of_it).collect()
    entries = tuple(
        Entry(r["table"], r["list"], r["run"], r["rows"], r["batch"])
        for r in rows
        if r["table"] is not None
    )
    return Version(newest["version"], newest["commit"], entries)


def commit(
    spark: SparkSession, home: str, change: Callable[[tuple[Entry, ...]], Iterable[Entry]]
) -> Version:
    """Make ``change`` of the newest entries the next version."""
    for _ in range(_TRIES):
        now = current_version(spark, home)
        number, name = (1 if now is None else now.number + 1), uuid.uuid4().hex
        entries = tuple(change(() if now is None else now.entries))
        rows = [(number, name, e.table, e.list, e.run, e.rows, e.batch) for e in entries]
        rows = rows or [(number, name, None, None, None, None, None)]  # a version without any list
        # One file: it is moved to its place whole.
        spark.createDataFrame(rows, _VERSION).coalesce(1).write.mode("append").parquet(f"{home}/versions")
        after = current_version(spark, home)
        if after is not None and (after.commit == name or after.number > number):
            return Version(number, name, entries)
    raise RuntimeError(f"{home}: no commit came first in {_TRIES} tries")


def replace(
    spark: SparkSession,
    home: str,
    written: Iterable[Entry],
    processed: Iterable[str] | None,
    tables: Iterable[str],
) -> Version:
    """Commit what was written. Of ``processed`` lists (``None``: all) nothing older is
    left in ``tables``, nor of lists that have rows now; other tables keep all they had."""
    written, tables = list(written), set(tables)
    gone = None if processed is None else set(processed)
    renewed = {(e.table, e.list) for e in written}

    def change(old: tuple[Entry, ...]) -> list[Entry]:
        kept = [
            e
            for e in old
            if e.table not in tables
            or (gone is not None and e.list not in gone and (e.table, e.list) not in renewed)
        ]
        return kept + written

    return commit(spark, home, change)


def new_run() -> str:
    return f"r{uuid.uuid4().hex}"  # never looks like a number


def run_folder(home: str, run: str) -> str:
    return f"{home}/runs/run={run}"


def entries_of(spark: SparkSession, home: str, run: str) -> list[Entry]:
    """Tables and lists that a run has written, with their rows: footers of its own files only."""
    try:
        stored = spark.read.schema("table string, list string").parquet(run_folder(home, run))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    if "table" not in stored.columns:
        return []
    counts = stored.groupBy("table", list_name().alias(PARTITION)).agg(F.count(F.lit(1)).alias("rows"))
    return [
        Entry(r["table"], r[PARTITION], run, r["rows"])
        for r in counts.collect()  # one row per list and table
        if r["table"] is not None
    ]


def read_table(
    spark: SparkSession,
    root: str,
    schema: T.StructType | str,
    lists: Iterable[str] | None = None,
    options: dict[str, str] | None = None,
    without: Iterable[str] = (),
    only: Callable[[Entry], bool] | None = None,
    version: Version | None = None,
) -> DataFrame:
    """The newest version of a table, or the one given; a folder that was never
    committed is read as it is.

    ``lists`` and the version prune folders before any file is opened; ``without``
    leaves lists out, ``only`` picks entries of the version.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    home, table = split_root(root)
    version = version or current_version(spark, home)
    reader = spark.read.schema(schema).options(**(options or {}))
    held = [] if version is None else [e for e in version.entries if e.table == table]
    skipped = set(without)
    if not held:
        if version is not None and not _exists(spark, root):
            return spark.createDataFrame([], schema)
        data = reader.parquet(root)
        if skipped:
            data = data.where(~list_name().isin(*skipped))
    else:
        asked = None if lists is None else set(lists)
        runs: dict[str, set[str]] = {}
        for e in held:
            if e.list in skipped or (only is not None and not only(e)):
                continue
            if asked is None or e.list in asked:
                runs.setdefault(e.run, set()).add(e.list)
        if not runs:
            return spark.createDataFrame([], schema)
        folders = [f"{run_folder(home, r)}/table={table}" for r in sorted(runs)]
        data = reader.option("basePath", f"{home}/runs").parquet(*folders)
        # Runs that hold the same lists are named together.
        alike: dict[frozenset[str], list[str]] = {}
        for run, names in runs.items():
            alike.setdefault(frozenset(names), []).append(run)
        wanted = None
        for names, of_runs in alike.items():
            one = F.col("run").isin(*of_runs) & list_name().isin(*sorted(names))
            wanted = one if wanted is None else wanted | one
        data = data.where(wanted)
    named = data.select(
        *[
            list_name().alias(PARTITION) if f.name == PARTITION else F.col(f"`{f.name}`")
            for f in schema.fields
        ]
    )
    return named if lists is None else named.where(F.col(PARTITION).isin(*lists))


def has_versions(spark: SparkSession, root: str) -> bool:
    """Whether the table was committed at least once, and no plain folder is there."""
    return current_version(spark, split_root(root)[0]) is not None and not _exists(spark, root)


def table_folders(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """The folders that hold each list of the newest version of a table."""
    home, table = split_root(root)
    version = current_version(spark, home)
    found: dict[str, list[str]] = {}
    for e in version.entries if version else ():
        if e.table == table:
            name = _folder_name(e.list)
            found.setdefault(e.list, []).append(f"{run_folder(home, e.run)}/table={table}/{PARTITION}={name}")
    return found


# What Spark writes as %XX in the names of partition folders, and
# the name of a partition without a value.
_ESCAPED = set('"#%\'*/:=?\\\x7f{[]^') | {chr(c) for c in range(1, 32)}
NO_NAME = "__HIVE_DEFAULT_PARTITION__"


def _folder_name(name: str) -> str:
    if not name:
        return NO_NAME
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in name)


def _exists(spark: SparkSession, root: str) -> bool:
    try:
        spark.read.schema("list string").parquet(root)
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def expire(spark: SparkSession, home: str, keep: int = 1) -> int:
    """Empty the runs that the newest ``keep`` versions don't name; returns how many.

    Runs that no version ever named are left alone: their writer may be about to
    commit. A reader of an expired version fails from then on.
    """
    commits = spark.read.schema(_VERSION).parquet(f"{home}/versions").where("run IS NOT NULL")
    newest = current_version(spark, home)
    if newest is None:
        return 0
    runs = commits.groupBy("run").agg(F.max("version").alias("last"))
    old = [r["run"] for r in runs.where(F.col("last") <= newest.number - keep).collect()]
    emptied = 0
    for run in old:
        folder = run_folder(home, run)
        if spark.read.schema("table string").parquet(folder).isEmpty():
            continue  # emptied before
        spark.createDataFrame([], "emptied boolean").write.mode("overwrite").parquet(folder)
        emptied += 1
    return emptied
