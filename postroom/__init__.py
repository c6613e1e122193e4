"""Mail archives on Spark: parse, pseudonymise, analyse, reconcile, ingest."""

from .schema import DEAD_SCHEMA, MAIL_COLUMNS, MAIL_SCHEMA, RAW_SCHEMA, STORED_MAIL_SCHEMA

__all__ = ["DEAD_SCHEMA", "MAIL_COLUMNS", "MAIL_SCHEMA", "RAW_SCHEMA", "STORED_MAIL_SCHEMA"]
