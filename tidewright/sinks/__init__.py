"""Keyed upserts and table writes."""

from tidewright.sinks.tables import log_results, overwrite, recent_log, replace_range, replaced_rows, write_clustered
from tidewright.sinks.upsert import DuplicateKeys, upsert, upsert_table

__all__ = [
    "DuplicateKeys",
    "log_results",
    "overwrite",
    "recent_log",
    "replace_range",
    "replaced_rows",
    "upsert",
    "upsert_table",
    "write_clustered",
]
