"""The jobs a user runs: parse an archive, pseudonymise it, analyse it."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.activity import rolling_activity
from ..operators.authors import author_lists
from ..operators.parse import ERRORS, PARSED, parse_both
from ..operators.profiling import date_stats
from ..operators.pseudonyms import pseudonymised_datasets
from ..operators.quality import reconcile
from ..operators.sizes import list_sizes, size_report
from ..sinks.scratch import scratch
from ..sinks.tables import write_archive, write_partitioned, write_report, write_tables
from ..sinks.versions import Version
from ..sources.mail import (
    list_names,
    read_dead_letters,
    read_identity_map,
    read_mail,
    read_tolerant,
)

_ORDER = ["date", "article_no"]


def parse_archive(
    raw: DataFrame, out: str, lists: Iterable[str] | None = None, loose_dates: bool = False
) -> Version:
    """Parse raw mails into ``<out>/parsed``; failures go to ``<out>/errors``.

    Each mail is read and parsed once, and both tables change in one commit. The
    lists that are parsed (``None``: all) are replaced whole, dead letters included;
    a list without any mail left is empty afterwards. The version that is returned
    counts the mails of each list and table.
    """
    names = None if lists is None else list(lists)
    if names is not None:
        raw = raw.where(F.col("list").isin(*names))
    both = parse_both(raw, loose_dates)
    return write_tables(both, out, [PARSED, ERRORS], names, order_by=_ORDER)


def retry_dead_letters(raw: DataFrame, out: str, loose_dates: bool = False) -> Version:
    """Parse the mails among the dead letters again, from their raw files.

    Those that parse now are added and leave the dead letters in the same commit;
    the rest stay. Mails that are stored already are left out, so running it twice
    changes nothing.
    """
    spark = raw.sparkSession
    errors, key = f"{out}/{ERRORS}", ["list", "article_no"]
    with scratch(spark) as kept:
        dead = read_dead_letters(spark, errors)
        keys = kept.keep(dead.select(*key), "keys")
        # At most one name per list; with them, other lists are not even opened.
        names = [r["list"] for r in keys.select("list").distinct().collect()]
        found = raw.where(F.col("list").isin(*names)).join(keys, key, "left_semi")
        again = kept.keep(found, "again")

        stored = read_mail(spark, f"{out}/{PARSED}", names, with_article=True).select(*key)
        stored = stored.join(keys, key, "left_semi")
        both = parse_both(again, loose_dates)
        fresh = both.where(F.col("table") == PARSED).join(stored, key, "left_anti")
        # Dead letters whose raw mail is gone stay too; nothing is lost.
        gone = dead.join(again.select(*key), key, "left_anti").withColumn("table", F.lit(ERRORS))
        rows = fresh.unionByName(both.where(F.col("table") == ERRORS))
        rows = rows.unionByName(gone, allowMissingColumns=True)
        return write_tables(rows, out, [ERRORS], order_by=_ORDER)


def pseudonymise_archive(
    spark: SparkSession,
    parsed: str,
    out: str,
    lists: Iterable[str] | None = None,
    key: str | None = None,
    tolerant: bool = False,
) -> DataFrame | None:
    """Write the pseudonymised copy and the identity maps under ``out``.

    ``tolerant`` leaves out lists with a file that can't be read, warns of each and
    returns the report on them; what ``out`` holds of them stays as it is.
    """
    names, report = None if lists is None else list(lists), None
    if tolerant:
        mail, report = read_tolerant(spark, parsed)
        skipped = {r["list"] for r in report.collect()}  # names of lists
        if skipped and names is None:
            names = [r["list"] for r in list_names(mail).collect()]
        names = None if names is None else [n for n in names if n not in skipped]
        mail = mail if names is None else mail.where(F.col("list").isin(*names))
    else:
        mail = read_mail(spark, parsed, names)
    write_archive(pseudonymised_datasets(mail, key=key), out, processed=names)
    return report


def analyse_archive(
    spark: SparkSession,
    parsed: str,
    results: str,
    lists: Iterable[str] | None = None,
    since: str | None = None,
    id_map: str | None = None,
) -> None:
    """Write the standard results: activity, dates, list sizes, authors."""
    mail = read_mail(spark, parsed)
    write_report(rolling_activity(mail, lists, since), f"{results}/activity")
    write_report(date_stats(mail), f"{results}/date_stats")
    write_report(size_report(list_sizes(mail)), f"{results}/list_sizes")
    if id_map is not None:
        authors = author_lists(read_identity_map(spark, id_map))
        authors.write.mode("overwrite").parquet(f"{results}/unique_authors")


def check_archive(raw: DataFrame, out: str) -> DataFrame:
    """Raw, parsed and dead mails per list of an archive that was parsed."""
    spark = raw.sparkSession
    return reconcile(
        raw, read_mail(spark, f"{out}/{PARSED}"), read_dead_letters(spark, f"{out}/{ERRORS}")
    )


__all__ = [
    "analyse_archive",
    "check_archive",
    "parse_archive",
    "pseudonymise_archive",
    "retry_dead_letters",
    "write_partitioned",
]
