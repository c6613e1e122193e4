from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(Path(__file__).resolve().parent)]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .appName("postroom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        # Naive dates must not depend on the zone, so test in one with DST.
        .config("spark.sql.session.timeZone", "America/Sao_Paulo")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """Raw mails from ``(list, article_no, bytes)``."""

    def make(*mails):
        rows = [(f"/in/{m[0]}/{m[1]}.eml", *m[:2], bytearray(m[2])) for m in mails]
        return spark.createDataFrame(
            rows, "path string, list string, article_no long, content binary"
        ).selectExpr(
            "path",
            "timestamp_seconds(0) AS modificationTime",
            "length(content) + 0L AS length",
            "content",
            "article_no",
            "list",
        )

    return make
