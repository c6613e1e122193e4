"""A mail archive made from the tables at hand.

Every row of ``conversations`` and of ``documents`` becomes one raw mail: the
text is the body, whole, and headers, trailers and patches follow from the
row's ids. That gives the parser every shape it has to know (folded, repeated
and absent headers, two line-end and six date styles, five trailer and six
patch styles, mails that cannot be parsed), and what must come out can be
stated from the ids alone.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FIRST_DATE = "2019-07-01 00:00:00"
_DATE_STEP, _DATE_SPAN = 790_001, 94_608_000  # seconds

_DATE_STYLES = (
    "EEE, dd MMM yyyy HH:mm:ss +0200",
    "yyyy-MM-dd'T'HH:mm:ss'Z'",
    "EEE MMM d HH:mm:ss yyyy",
    "EEE, dd MMM yyyy HH.mm.ss",
    "M/d/yyyy h:mm:ss a",
    "EEE, dd MMM yyyy HH:mm:ss -0700 'PDT'",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mail_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bodies: list, article_no, src, k (the number all variety hangs on), text."""
    turns = table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("list-"), F.col("role")).alias("list"),
        (F.col("conv_id") * 100 + F.col("turn")).alias("article_no"),
        F.lit("c").alias("src"),
        (F.col("conv_id") * 8 + F.col("turn")).alias("k"),
        "text",
    )
    documents = table(spark, sf_dir, "documents").select(
        F.col("source").alias("list"),
        F.col("doc_id").alias("article_no"),
        F.lit("d").alias("src"),
        F.col("doc_id").alias("k"),
        "text",
    )
    return _spread(turns.unionByName(documents), "list", "article_no")


def _spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread rows that come in fewer splits than there are cores.

    A table of a single row group is one task otherwise, with all the parsing
    in it. Tables with splits enough are left as they are: no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def mail_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw mails: path, modificationTime, length, content, article_no, list."""
    broken = f"if({_BROKEN}, X'FF', X'')"
    content = f"concat(encode(concat({_stray()}, {_message()}), 'UTF-8'), {broken})"
    return mail_texts(spark, sf_dir).selectExpr(
        "concat('/archive/', list, '/', article_no, '.eml') AS path",
        "timestamp_seconds(1700000000 + k) AS modificationTime",
        f"{content} AS content",
        "article_no",
        "list",
    ).selectExpr(
        "path",
        "modificationTime",
        "cast(octet_length(content) AS bigint) AS length",
        "content",
        "article_no",
        "list",
    )


# The texts are SQL expressions of k, src and text; one parse each is much
# quicker to plan than the same thing put together from hundreds of columns.

_BROKEN = "k % 13 = 5"
_STRAY = "k % 11 = 3"
_KIND = "k % 8"


def _stray() -> str:
    return f"if({_STRAY}, ' stray continuation\\n', '')"


def _message() -> str:
    text = f"concat({_header()}, '\\n\\n', {_body()})"
    return f"if({_KIND} = 1, replace({text}, '\\n', '\\r\\n'), {text})"


def _fill(template: str) -> str:
    """A text with ``{k}``, ``{k%n}`` and ``{src}`` filled in."""
    parts = []
    for piece in re.split(r"(\{[^}]+\})", template):
        if piece.startswith("{"):
            parts.append(piece[1:-1])
        elif piece:
            escaped = piece.replace("\\", "\\\\").replace("'", "\\'")
            parts.append("'" + escaped.replace("\n", "\\n").replace("\t", "\\t") + "'")
    return f"concat({', '.join(parts)})" if parts else "''"


def _pick(index: str, templates: dict[int, str], default: str | None) -> str:
    """The template for ``index``, filled in; null (no line) when there is none."""
    cases = " ".join(f"WHEN {v} THEN {_fill(t)}" for v, t in templates.items())
    rest = "NULL" if default is None else _fill(default)
    return f"CASE {index} {cases} ELSE {rest} END"


def _header() -> str:
    known = f"{_KIND} <> 5"
    receivers = _pick(
        _KIND,
        {3: "To: x{k}@one.example\nTo: y{k}@two.example, z@two.example"},
        "To: p{k%7}@one.example, q{k%5}@two.example",
    )
    mail_id = (
        f"if(k % 19 = 7 AND k >= 40, {_fill('Message-ID: <{k-40}.{src}@mail.example>')},"
        f" {_fill('Message-ID: <{k}.{src}@mail.example>')})"
    )
    thread = (
        f"CASE WHEN {_KIND} = 2 THEN {_fill('References: <r1.{k}@x.example>' + chr(10) + ' <r2.{k}@x.example>')}"
        f" WHEN k % 3 = 1 THEN {_fill('References: <a.{k}@x.example>  <b.{k}@x.example>')} END"
    )
    lines = [
        _fill("From: Author {k%97} <a{k%97}@mail.example>"),
        f"if({known}, {receivers}, NULL)",
        _pick(_KIND, {6: "Cc: c1@x.example,c2@x.example,  c3@x.example"}, None),
        _pick(
            _KIND,
            {2: "Subject: part {k}\n\tcontinued  \n  end", 4: "SUBJECT : Topic {k} "},
            "Subject: Re: topic: {k}",
        ),
        f"concat('Date: ', {_date()})",
        _pick(_KIND, {3: "Date: Mon, 01 Jan 1990 00:00:00 +0000"}, None),
        f"if({known}, {mail_id}, NULL)",
        f"if({known} AND k % 3 = 1, {_fill('In-Reply-To: <{k-1}.{src}@mail.example>')}, NULL)",
        f"if({known}, {thread}, NULL)",
        _pick(_KIND, {7: "X-Mailing-List: box{k%5}@lists.example"}, None),
    ]
    return f"concat_ws('\\n', {', '.join(lines)})"


def _date() -> str:
    sent = (
        f"(timestamp_ntz'{_FIRST_DATE}' +"
        f" make_dt_interval(0, 0, 0, (k * {_DATE_STEP}) % {_DATE_SPAN}))"
    )
    styles = " ".join(
        f"WHEN {i} THEN date_format({sent}, '{style}')"
        for i, style in enumerate(s.replace("'", "\\'") for s in _DATE_STYLES)
    )
    return f"CASE k % 17 WHEN 4 THEN 'n/a' WHEN 9 THEN 'yesterday at noon' ELSE CASE k % 6 {styles} END END"


def _body() -> str:
    trailers = _pick(
        "k % 5",
        {
            1: "\n\nReviewed-by: Rev {k%50} <rev{k%50}@lab.example>",
            2: "\n\nreviewed-by:   Rev B <revb@lab.example>  # ok\nTested-by: T {k%3} <t@lab.example>",
            3: "\n\nReviewed-and-tested-by: RT <rt@lab.example>\n Reviewed-by: In <in@lab.example>"
            "\nReported-by: nobody@lab.example",
            4: "\n\nAcked-by:\t Ann  < ann@lab.example >\nTested-by: U <u@lab.example>",
        },
        "",
    )
    patch = _pick(
        "k % 6",
        {
            1: "\n---\n f{k}.c | 2 +-\n\ndiff --git a/f{k}.c b/f{k}.c\n+x\n--\n2.40.1",
            2: "\nprose\ndiff --git a/g{k} b/g{k}\n-y\n-- \n2.30\n",
            3: "\n---\n a{k}\n-- \n2.1\nbetween\n---\n b{k}\n--\n2.2\n",
            4: "\n---\n q{k}\n-- =\n\n2.26.2\n",
            5: "\n---\n u{k}\n- item\ntail line",
        },
        "",
    )
    return f"concat(text, {trailers}, {patch})"
