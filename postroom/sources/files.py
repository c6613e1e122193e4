"""Raw mail files by a catalogue: listed, packed and read by tasks.

A directory tree of tens of millions of small files is too much for a driver to
list. Here the driver knows the names of the lists only; tasks list the folders
and write what they find into a catalogue table. The catalogue is put in order
and cut into packs of equal bytes (running sums over one total per partition), and
each pack is read by one task, a bounded number of bytes at a time. The columns
are those of :func:`postroom.sources.read_raw`, which passes over empty files; here
they are mails without a header or body.

Files are opened through pyarrow, so ``root`` may be a local path or any URI that
it knows (``file:``, ``hdfs:``, ``s3:``, ``gs:``).
"""

from __future__ import annotations

import datetime as dt
import os
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import RAW_SCHEMA
from ..sinks.scratch import materialise, scratch_dir

MAIL_SUFFIX = ".eml"
#: Bytes that one task reads, and that one Arrow batch holds.
PACK_BYTES = 64 << 20
BATCH_BYTES = 8 << 20
#: What opening a file counts beside its bytes.
OPEN_BYTES = 4 << 10

CATALOGUE = "path string, list string, length long, modificationTime timestamp"


def _open(root: str) -> tuple[fs.FileSystem, str]:
    if "://" in root or root.startswith("file:"):
        return fs.FileSystem.from_uri(root)
    return fs.LocalFileSystem(), root


def list_folders(root: str) -> list[str]:
    """Names of the mailing lists under ``root``."""
    files, path = _open(root)
    found = files.get_file_info(fs.FileSelector(path))
    return sorted(f.base_name for f in found if f.type == fs.FileType.Directory)


def catalogue(spark: SparkSession, root: str, lists: Iterable[str] | None = None) -> DataFrame:
    """path, list, length, modificationTime of every mail file, listed by tasks.

    Control files beside the mails are left out. A task holds the names of one
    folder at a time.
    """
    names = list_folders(root) if lists is None else list(lists)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _open(root)
        for batch in batches:
            for name in batch.column("list").to_pylist():
                selector = fs.FileSelector(f"{path}/{name}", allow_not_found=lists is not None)
                found = [
                    f
                    for f in files.get_file_info(selector)
                    if f.type == fs.FileType.File and f.base_name.endswith(MAIL_SUFFIX)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([f.path for f in found], pa.string()),
                        pa.array([name] * len(found), pa.string()),
                        pa.array([f.size for f in found], pa.int64()),
                        pa.array([f.mtime for f in found], pa.timestamp("us", "UTC")),
                    ],
                    ["path", "list", "length", "modificationTime"],
                )

    if not names:
        return spark.createDataFrame([], CATALOGUE)
    folders = spark.createDataFrame([(n,) for n in names], "list string")
    spread = folders.repartition(min(len(names), 1024), "list")
    return spread.mapInArrow(look, CATALOGUE)


def packed(files: DataFrame, pack_bytes: int = PACK_BYTES) -> DataFrame:
    """The catalogue with a ``pack`` for each file; packs hold about as many bytes."""
    spark = files.sparkSession
    sized = files.withColumn("size", F.col("length") + OPEN_BYTES)
    ranged = sized.repartitionByRange("list", "path").withColumn("part", F.spark_partition_id())
    ranged = materialise(ranged, f"{scratch_dir(spark)}/catalogue")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("part").agg(F.sum("size").alias("total"))
    # One row per range partition.
    parts = parts.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("list", "path").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    placed = ranged.join(F.broadcast(parts), "part").withColumn("start", start)
    return placed.withColumn("pack", F.expr(f"start DIV {pack_bytes}")).drop("size", "part", "before", "start")


def read_catalogued(
    files: DataFrame, root: str, pack_bytes: int = PACK_BYTES, tolerant: bool = False
) -> DataFrame:
    """The mails of a catalogue of ``root``; ``tolerant`` passes over files that are gone."""
    names = RAW_SCHEMA.fieldNames()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, _ = _open(root)
        for batch in batches:
            held, size = [], 0
            for row in batch.to_pylist():
                if held and size + row["length"] > BATCH_BYTES:
                    yield _raw_batch(held)
                    held, size = [], 0
                try:
                    with opened.open_input_stream(row["path"]) as stream:
                        held.append((row, stream.read()))
                except FileNotFoundError:
                    if not tolerant:
                        raise
                    continue
                size += row["length"]
            if held:
                yield _raw_batch(held)

    placed = packed(files, pack_bytes)
    # A task for each pack: by the bytes of the names alone, Spark would join them all.
    packs = 1 + (placed.agg(F.max("pack")).first()[0] or 0)
    placed = placed.repartitionByRange(packs, "pack")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in RAW_SCHEMA.fields)
    return placed.select("path", "list", "length", "modificationTime").mapInArrow(read, ddl).select(*names)


def _raw_batch(held: list[tuple[dict, bytes]]) -> pa.RecordBatch:
    stems = [row["path"].rsplit("/", 1)[1].removesuffix(MAIL_SUFFIX) for row, _ in held]
    columns = {
        "path": pa.array([row["path"] for row, _ in held], pa.string()),
        "modificationTime": pa.array([row["modificationTime"] for row, _ in held], pa.timestamp("us", "UTC")),
        "length": pa.array([len(content) for _, content in held], pa.int64()),
        "content": pa.array([content for _, content in held], pa.binary()),
        "article_no": pa.array([_number(s) for s in stems], pa.int64()),
        "list": pa.array([row["list"] for row, _ in held], pa.string()),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _number(stem: str) -> int | None:
    """The article number of a file name, as Spark casts it; null when it is none."""
    if not re.fullmatch(r"\s*[+-]?[0-9]+\s*", stem):
        return None
    value = int(stem)
    return value if -(2**63) <= value < 2**63 else None


def write_raw_files(raw: DataFrame, root: str) -> DataFrame:
    """Write each mail as ``<root>/<list>/<article_no>.eml`` by tasks; a second run
    writes the same files. On a local disk files get their row's time.

    Returns list and mails written, and does so when it is run.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _open(root)
        local = isinstance(files, fs.LocalFileSystem)
        made: set[str] = set()
        for batch in batches:
            names = batch.column("list").to_pylist()
            for name, number, content, time in zip(
                names,
                batch.column("article_no").to_pylist(),
                batch.column("content").to_pylist(),
                batch.column("modificationTime").to_pylist(),
            ):
                folder = f"{path}/{name}"
                if folder not in made:
                    files.create_dir(folder, recursive=True)
                    made.add(folder)
                target = f"{folder}/{number}{MAIL_SUFFIX}"
                with files.open_output_stream(target) as stream:
                    stream.write(content)
                if local and time is not None:
                    stamp = time.replace(tzinfo=time.tzinfo or dt.timezone.utc).timestamp()
                    os.utime(target, (stamp, stamp))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], ["list"])

    slim = raw.select("list", "article_no", "content", "modificationTime")
    return slim.mapInArrow(write, "list string").groupBy("list").agg(F.count(F.lit(1)).alias("mails"))


def write_file(path: str, content: bytes) -> None:
    """One small file beside the mails, such as a control file."""
    files, target = _open(path)
    files.create_dir(target.rsplit("/", 1)[0], recursive=True)
    with files.open_output_stream(target) as stream:
        stream.write(content)


def probe(spark: SparkSession, folders: dict[str, list[str]]) -> DataFrame:
    """list, path, error of Parquet files whose footer can't be read.

    ``folders`` names the folders of each list. Tasks list them, the files are
    dealt out again, and tasks open nothing but their footers.
    """
    rows = [(name, folder) for name, held in sorted(folders.items()) for folder in held]
    if not rows:
        return spark.createDataFrame([], "list string, path string, error string")
    schema = "list string, path string"

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, folder in zip(batch.column("list").to_pylist(), batch.column("path").to_pylist()):
                files, path = _open(folder)
                found = files.get_file_info(fs.FileSelector(path, recursive=True))
                prefix = folder[: len(folder) - len(path)]
                paths = [
                    f"{prefix}{f.path}"
                    for f in found
                    if f.type == fs.FileType.File and not f.base_name.startswith(("_", "."))
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(paths), pa.string()), pa.array(paths, pa.string())], ["list", "path"]
                )

    def open_footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import parquet

        for batch in batches:
            bad = []
            for name, path in zip(batch.column("list").to_pylist(), batch.column("path").to_pylist()):
                files, target = _open(path)
                try:
                    with files.open_input_file(target) as file:
                        parquet.read_metadata(file)
                except Exception as e:  # whatever is wrong with the file is the report
                    bad.append((name, path, type(e).__name__))
            columns = zip(*bad) if bad else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), pa.string()) for c in columns], ["list", "path", "error"]
            )

    given = spark.createDataFrame(rows, schema).repartition(min(len(rows), 1024), "path")
    listed = given.mapInArrow(look, schema)
    return listed.repartition("path").mapInArrow(open_footers, f"{schema}, error string")
