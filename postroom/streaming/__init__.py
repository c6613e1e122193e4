"""Structured Streaming ingest."""

from .ingest import (
    above_marks,
    backfill,
    compact,
    high_water_marks,
    ingest,
    ingest_status,
    ingested_gaps,
    landed_stream,
    latest,
    listed_reader,
    listed_stream,
    lost_copies,
    mail_stream,
    note_files,
    read_ingested,
    read_latest,
    read_marks,
    read_numbers,
    store_batch,
)
from .progress import ProgressLog, read_progress

__all__ = [
    "ProgressLog",
    "above_marks",
    "backfill",
    "compact",
    "high_water_marks",
    "ingest",
    "ingest_status",
    "ingested_gaps",
    "landed_stream",
    "latest",
    "listed_reader",
    "listed_stream",
    "lost_copies",
    "mail_stream",
    "note_files",
    "read_ingested",
    "read_latest",
    "read_marks",
    "read_numbers",
    "read_progress",
    "store_batch",
]
