"""Column expressions: text, headers, dates, trailers, patches, digests."""

from .dates import clean_date, parse_date, to_micros, from_micros
from .digests import keyed_digest, sha1_digest
from .headers import first_value, header_fields, header_is_malformed, list_value, split_message, values_of
from .patches import extract_patches
from .text import decode_utf8, drop_final_newline, join_list, split_trimmed, strip, unify_line_ends
from .trailers import count_reviewed, count_tested, extract_trailers, is_reviewed, is_tested

__all__ = [
    "clean_date",
    "count_reviewed",
    "count_tested",
    "decode_utf8",
    "drop_final_newline",
    "extract_patches",
    "extract_trailers",
    "first_value",
    "from_micros",
    "header_fields",
    "header_is_malformed",
    "is_reviewed",
    "is_tested",
    "join_list",
    "keyed_digest",
    "list_value",
    "parse_date",
    "sha1_digest",
    "split_message",
    "split_trimmed",
    "strip",
    "to_micros",
    "unify_line_ends",
    "values_of",
]
