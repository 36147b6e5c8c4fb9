"""Readers for landed feeds and reference data, and the first shaping of their rows."""

from tidewright.sources.bronze import clean_grid, current_snapshot, enrich, tide_stats
from tidewright.sources.conform import conform, conform_union, ensure_columns
from tidewright.sources.feeds import (
    classify_variant,
    landed_files,
    landing_times,
    latest_partition,
    path_date,
    scan_feed,
)
from tidewright.sources.reference import invalid_boxes, read_points, with_bbox, zones_from_rows

__all__ = [
    "classify_variant",
    "clean_grid",
    "conform",
    "conform_union",
    "current_snapshot",
    "enrich",
    "ensure_columns",
    "invalid_boxes",
    "landed_files",
    "landing_times",
    "latest_partition",
    "path_date",
    "read_points",
    "scan_feed",
    "tide_stats",
    "with_bbox",
    "zones_from_rows",
]
