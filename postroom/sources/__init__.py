"""Readers and selections."""

from .files import catalogue, list_folders, packed, read_catalogued, write_raw_files
from .mail import (
    list_names,
    read_dead_letters,
    read_identity_map,
    read_mail,
    read_tolerant,
    unreadable_files,
)
from .raw import MAIL_GLOB, read_landed, read_raw, with_origin
from .selection import ALL_LISTS, NoListsError, RangeError, article_range, parse_range, select_lists

__all__ = [
    "ALL_LISTS",
    "MAIL_GLOB",
    "NoListsError",
    "RangeError",
    "article_range",
    "catalogue",
    "list_folders",
    "list_names",
    "packed",
    "parse_range",
    "read_catalogued",
    "read_dead_letters",
    "read_identity_map",
    "read_landed",
    "read_mail",
    "read_raw",
    "read_tolerant",
    "select_lists",
    "unreadable_files",
    "with_origin",
    "write_raw_files",
]
