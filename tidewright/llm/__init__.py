"""Operators of a training-data pipeline. Nothing else in the library imports this package."""

from .catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
