"""Optional second look at dates that the native shapes leave unread.

This is the one place where text goes to Python workers: in Arrow batches, and
only the dates that did not parse. It needs ``dateutil`` on the executors.
"""

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dates import DATE_CUTS, clean_date


def fill_unread_dates(df: DataFrame, date: str, text: str) -> DataFrame:
    """Where ``date`` is null, read it from ``text`` with ``dateutil``."""
    unread = F.when(F.col(date).isNull(), clean_date(F.col(text)))
    looked = df.withColumn("__unread", unread).withColumn("__found", _reader()(F.col("__unread")))
    return looked.withColumn(date, F.coalesce(F.col(date), F.col("__found"))).drop(
        "__unread", "__found"
    )


def _reader():
    # Nested, so that it travels to the workers by value.
    cuts = DATE_CUTS

    def read(text):
        from datetime import datetime

        from dateutil import parser

        if text is None:
            return None
        # Two defaults that differ in year, month and day: a text that leaves
        # one of them open gives two different dates, and counts as unread.
        defaults = (datetime(2000, 1, 1), datetime(2004, 2, 2))
        for attempt in (text, text.replace(".", ":"), *(text[:n].strip() for n in cuts)):
            try:
                found = {parser.parse(attempt, ignoretz=True, default=d) for d in defaults}
            except (ValueError, OverflowError, TypeError):
                continue
            return found.pop() if len(found) == 1 else None
        return None

    @F.pandas_udf("timestamp_ntz")
    def read_dates(texts: pd.Series) -> pd.Series:
        return pd.Series([read(t) for t in texts], dtype="datetime64[us]")

    return read_dates
