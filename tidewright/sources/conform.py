"""Bring frames with missing columns to one schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ensure_columns(df: DataFrame, columns: dict[str, str | T.DataType]) -> DataFrame:
    """Add each named column that is missing as a typed NULL; existing columns stay as they are."""
    have = set(df.columns)
    missing = {name: F.lit(None).cast(kind) for name, kind in columns.items() if name not in have}
    return df.withColumns(missing) if missing else df


def conform(df: DataFrame, schema: T.StructType, month_of: str | None = None) -> DataFrame:
    """Exactly the columns of ``schema``, in order and type. ``month_of`` names the time column for ``year_month``."""
    if month_of is not None and "year_month" not in df.columns:
        df = df.withColumn("year_month", F.date_format(F.col(month_of), "yyyy-MM"))
    full = ensure_columns(df, {f.name: f.dataType for f in schema.fields})
    return full.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def conform_union(frames: list[DataFrame], schema: T.StructType, month_of: str | None = None) -> DataFrame:
    """Stack frames that each carry part of the columns."""
    return reduce(DataFrame.unionByName, [conform(df, schema, month_of) for df in frames])
