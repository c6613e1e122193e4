"""What a running ingest has done: a listener that feeds a table."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS = "query string, run string, batch long, mails long, started string"


class ProgressLog(StreamingQueryListener):
    """Collects one row per finished batch; :meth:`store` adds them to a table.

    Rows wait in memory between two calls of :meth:`store`, at most ``most`` of them.
    """

    def __init__(self, most: int = 100_000) -> None:
        self.rows: deque[tuple] = deque(maxlen=most)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.rows.append((str(p.id), str(p.runId), p.batchId, p.numInputRows, p.timestamp))

    def wait_for(self, enough: Callable[[list[tuple]], bool], seconds: float = 30) -> bool:
        """Wait until the rows are ``enough``: news of a batch may come after the batch."""
        until = time.monotonic() + seconds
        while not (done := enough(list(self.rows))) and time.monotonic() < until:
            time.sleep(0.1)
        return done

    def store(self, spark: SparkSession, target: str) -> int:
        """Add what was collected to ``<target>/progress``; returns how many rows."""
        rows = [self.rows.popleft() for _ in range(len(self.rows))]
        if rows:
            df = spark.createDataFrame(rows, PROGRESS).coalesce(1)
            df.write.mode("append").parquet(f"{target}/progress")
        return len(rows)


def read_progress(spark: SparkSession, target: str) -> DataFrame:
    """One row per batch and attempt; empty before the first."""
    try:
        return spark.read.schema(PROGRESS).parquet(f"{target}/progress")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PROGRESS)
