"""Queries over the given tables, one per operator, each with an independent SQL formulation."""

from tidewright.catalog import (
    aggregate_queries,
    bronze_queries,
    disk_queries,
    join_queries,
    model_queries,
    plan_queries,
    quality_queries,
    shape_queries,
    window_queries,
)
from tidewright.catalog.registry import ORACLES, QUERIES

__all__ = [
    "ORACLES",
    "QUERIES",
    "aggregate_queries",
    "bronze_queries",
    "disk_queries",
    "join_queries",
    "model_queries",
    "plan_queries",
    "quality_queries",
    "shape_queries",
    "window_queries",
]
