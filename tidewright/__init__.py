"""Spark operators for turning sea-state forecast feeds into checked tables and risk predictions."""

__version__ = "0.1.0"
