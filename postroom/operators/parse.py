"""Raw mails to parsed mails and dead letters.

:func:`parse_both` gives both from one look at each mail. Alone, neither drags
the other along: whether a mail is dead depends on its bytes and its first line
only, so the dead-letter plan carries no header, trailer or patch work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_date
from ..functions.headers import (
    first_value,
    header_fields,
    header_is_malformed_sql,
    list_value,
    split_message_sql,
)
from ..functions.patches import extract_patches
from ..functions.text import (
    decode_utf8,
    drop_final_newline_sql,
    let_sql,
    quoted,
    unify_line_ends_sql,
    with_sql,
)
from ..functions.trailers import extract_trailers
from ..schema import STORED_MAIL_SCHEMA

# Header fields kept, by how they are read.
TEXT_FIELDS = ("from", "subject", "message-id", "in-reply-to", "x-mailing-list")
LIST_FIELDS = {"to": ",", "cc": ",", "references": " "}
DATE_FIELD = "date"

# The tables of an archive.
PARSED, ERRORS = "parsed", "errors"

NOT_UTF8 = "content is not valid UTF-8"
NO_FIELD = "header starts with a continuation line"


def split_raw(raw: DataFrame) -> DataFrame:
    """Add ``head``, ``body`` and ``error`` (null for a mail that can be parsed).

    ``raw`` needs a binary ``content`` column; its other columns stay.
    """
    error = (
        f"CASE WHEN head IS NULL THEN {quoted(NOT_UTF8)}"
        f" WHEN {header_is_malformed_sql('head')} THEN {quoted(NO_FIELD)} END"
    )
    body = drop_final_newline_sql("coalesce(get(parts, 1), '')")
    message = let_sql(
        "get(parts, 0)", "head", f"struct(head, {body} AS body, {error} AS error)"
    )
    split = let_sql(split_message_sql(unify_line_ends_sql("x")), "parts", message)
    text = decode_utf8(F.col("content"))
    # A generator, although it gives one row each: a later filter on "error"
    # would be pushed below a projection, and decode every mail a second time.
    return raw.select("*", F.inline(F.array(with_sql(text, "x", split))))


def parse_mail(raw: DataFrame, loose_dates: bool = False) -> DataFrame:
    """The mails that parse, in the stored schema.

    ``loose_dates`` gives dates that no known shape fits a second look in Python.
    """
    split = split_raw(raw).where(F.col("error").isNull())
    return _parsed(split, {}, loose_dates)


def parse_both(raw: DataFrame, loose_dates: bool = False) -> DataFrame:
    """Parsed mails and dead letters from one look at each mail.

    ``table`` says which one a row is; the columns of the other are null.
    """
    dead = F.col("error").isNotNull()
    split = split_raw(raw)
    split = split.withColumns({n: F.when(~dead, F.col(n)) for n in ("head", "body")})
    extra = {
        "path": F.when(dead, F.col("path")),
        "raw": F.when(dead, F.col("content")),
        "error": F.col("error"),
        "table": F.when(dead, ERRORS).otherwise(PARSED),
    }
    return _parsed(split, extra, loose_dates)


def _parsed(split: DataFrame, extra: dict[str, Column], loose_dates: bool) -> DataFrame:
    names = (*TEXT_FIELDS, DATE_FIELD, *LIST_FIELDS)
    # One column for all fields: it is used many times, so Spark keeps it as a
    # projection of its own and parses each header once.
    fields = split.withColumn("fields", header_fields(F.col("head"), names))
    date_text = first_value(F.col("fields"), DATE_FIELD)
    values: dict[str, Column] = {n: first_value(F.col("fields"), n) for n in TEXT_FIELDS}
    values |= {n: list_value(F.col("fields"), n, s) for n, s in LIST_FIELDS.items()}
    values[DATE_FIELD] = parse_date(date_text)
    values["trailers"] = extract_trailers(F.col("body"))
    values["code"] = extract_patches(F.col("body"))
    values["raw_body"] = F.col("body")
    if extra:  # of a mail that does not parse nothing is stored
        values = {n: F.when(F.col("error").isNull(), v) for n, v in values.items()}
    values |= {"article_no": F.col("article_no"), "list": F.col("list")}
    columns = [values[n].alias(n) for n in STORED_MAIL_SCHEMA.fieldNames()]
    columns += [value.alias(n) for n, value in extra.items()]
    if not loose_dates:
        return fields.select(*columns)
    from ..functions.loose_dates import fill_unread_dates  # pandas, only when asked for

    parsed = fields.select(*columns, date_text.alias("__date_text"))
    return fill_unread_dates(parsed, DATE_FIELD, "__date_text").drop("__date_text")


def dead_letters(raw: DataFrame) -> DataFrame:
    """The mails that do not parse, with their bytes and the reason."""
    return split_raw(raw).where(F.col("error").isNotNull()).select(
        "article_no", "path", F.col("content").alias("raw"), "error", "list"
    )


def dead_letter_text(dead: DataFrame) -> DataFrame:
    """Dead letters as one text each: the mail, a ruler, and the reason.

    Bytes that are not UTF-8 show as replacement characters here; the ``raw``
    column keeps them.
    """
    text = F.coalesce(decode_utf8(F.col("raw")), F.make_valid_utf8(F.col("raw").cast("string")))
    ruler = F.lit("\n" + "=" * 30 + " Exception:\n")
    return dead.select("list", "article_no", F.concat(text, ruler, F.col("error")).alias("text"))
