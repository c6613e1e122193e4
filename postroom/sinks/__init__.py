"""Writers."""

from .scratch import materialise, scratch, scratch_dir
from .tables import (
    ARCHIVE_LEVEL,
    ARCHIVE_ROWS,
    archive_options,
    land_raw,
    write_archive,
    write_dead_letters,
    write_mail,
    write_partitioned,
    write_report,
    write_tables,
)
from .versions import commit, current_version, expire, read_table

__all__ = [
    "ARCHIVE_LEVEL",
    "ARCHIVE_ROWS",
    "archive_options",
    "commit",
    "current_version",
    "expire",
    "land_raw",
    "materialise",
    "read_table",
    "scratch",
    "scratch_dir",
    "write_archive",
    "write_dead_letters",
    "write_mail",
    "write_partitioned",
    "write_report",
    "write_tables",
]
