"""Fixed schemas of the archive's tables.

Every reader names its schema, so nothing is inferred: a list called ``2024``
stays a string, and a column that a partition happens to leave empty keeps
its type.
"""

from __future__ import annotations

from pyspark.sql import types as T

TRAILER = T.StructType(
    [
        T.StructField("attribution", T.StringType()),
        T.StructField("identification", T.StringType()),
    ]
)

#: One parsed mail, in published column order. ``list`` is the partition column.
MAIL_SCHEMA = T.StructType(
    [
        T.StructField("from", T.StringType()),
        T.StructField("to", T.ArrayType(T.StringType())),
        T.StructField("cc", T.ArrayType(T.StringType())),
        T.StructField("subject", T.StringType()),
        T.StructField("date", T.TimestampNTZType()),
        T.StructField("message-id", T.StringType()),
        T.StructField("in-reply-to", T.StringType()),
        T.StructField("references", T.ArrayType(T.StringType())),
        T.StructField("x-mailing-list", T.StringType()),
        T.StructField("trailers", T.ArrayType(TRAILER)),
        T.StructField("code", T.ArrayType(T.StringType())),
        T.StructField("raw_body", T.StringType()),
        T.StructField("list", T.StringType()),
    ]
)

MAIL_COLUMNS = tuple(MAIL_SCHEMA.fieldNames())

#: Parsed mails as written: the article number rides along, so that retries
#: and reconciliation can name single mails. Readers drop it unless asked.
STORED_MAIL_SCHEMA = T.StructType(
    MAIL_SCHEMA.fields[:-1]
    + [T.StructField("article_no", T.LongType()), MAIL_SCHEMA.fields[-1]]
)

#: What the binary file source gives for each file.
FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)

#: One raw mail, straight from a file or from a landed table.
RAW_SCHEMA = T.StructType(
    FILE_SCHEMA.fields
    + [T.StructField("article_no", T.LongType()), T.StructField("list", T.StringType())]
)

#: One mail that could not be parsed, with its bytes untouched.
DEAD_SCHEMA = T.StructType(
    [
        T.StructField("article_no", T.LongType()),
        T.StructField("path", T.StringType()),
        T.StructField("raw", T.BinaryType()),
        T.StructField("error", T.StringType()),
        T.StructField("list", T.StringType()),
    ]
)

#: Highest article number seen per list, one row per list and batch.
MARK_SCHEMA = T.StructType(
    [
        T.StructField("list", T.StringType()),
        T.StructField("last_article", T.LongType()),
        T.StructField("new_mails", T.LongType()),
        T.StructField("batch", T.LongType()),
    ]
)
