"""A place for intermediate tables that every executor can reach."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    Without one, a local session gets a temporary folder, which goes when the
    program ends; a cluster session is refused, as its executors would not see it.
    """
    shared = spark.conf.get(_SETTING, None)
    if not shared and hasattr(spark, "sparkContext"):  # it may have been set on the context
        shared = spark.sparkContext.getCheckpointDir()
    if shared:
        return f"{shared.rstrip('/')}/postroom-{uuid.uuid4().hex}"
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="postroom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def materialise(df: DataFrame, path: str, **options: str) -> DataFrame:
    """Write ``df`` once and read it back, so that later steps share the result
    and a lost executor costs a re-read, not a re-run."""
    df.write.mode("overwrite").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Intermediate tables of one job."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.folder = spark, scratch_dir(spark)
        self.names: list[str] = []

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        self.names.append(name)
        return materialise(df, f"{self.folder}/{name}")


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """Intermediate tables that are emptied when the job ends, well or not.

    Only for jobs that are over by then: a lazy result must not read from them.
    """
    tables = Scratch(spark)
    try:
        yield tables
    finally:
        nothing = spark.createDataFrame([], "emptied boolean")
        for name in tables.names:
            nothing.write.mode("overwrite").parquet(f"{tables.folder}/{name}")
