"""DataFrame in, DataFrame out."""

from .activity import after, rolling_activity, rolling_sums, trailer_counts
from .authors import author_list_counts, author_lists, repeat_lists
from .parse import dead_letter_text, dead_letters, parse_both, parse_mail, split_raw
from .profiling import date_stats, first_and_last, profile
from .pseudonyms import hash_columns, identity_map, pseudonymised_datasets
from .quality import (
    MessageIdConflict,
    duplicate_ids,
    find_by_id,
    find_one,
    gap_ranges,
    gaps,
    missing_ids,
    reconcile,
    reconcile_total,
)
from .quantiles import exact_quantiles, quantile_row, quantile_rows
from .sizes import list_extremes, list_sizes, size_quartiles, size_report

__all__ = [
    "MessageIdConflict",
    "after",
    "author_list_counts",
    "author_lists",
    "date_stats",
    "dead_letter_text",
    "dead_letters",
    "duplicate_ids",
    "exact_quantiles",
    "find_by_id",
    "find_one",
    "first_and_last",
    "gap_ranges",
    "gaps",
    "hash_columns",
    "identity_map",
    "list_extremes",
    "list_sizes",
    "missing_ids",
    "parse_both",
    "parse_mail",
    "profile",
    "pseudonymised_datasets",
    "quantile_row",
    "quantile_rows",
    "reconcile",
    "reconcile_total",
    "repeat_lists",
    "rolling_activity",
    "rolling_sums",
    "size_quartiles",
    "size_report",
    "split_raw",
    "trailer_counts",
]
