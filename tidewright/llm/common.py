"""Shared helpers: settled intermediate tables, range buckets in key order, bounded batches of texts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Documents and bytes that are decoded to Python objects at a time inside a task.
BATCH_ROWS = 512


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Compute once: written as Parquet to the shared folder and read again, so lost executors cost no recomputation."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to a few rows each, so that decoded texts stay small in memory."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def bucket_bounds(df: DataFrame, key: str, rows_per_bucket: int, most: int = 1 << 16) -> list[int]:
    """Ascending values of an integer key that cut its rows into buckets of about ``rows_per_bucket`` rows.

    Only the key column is read. The list has one value per bucket (at most ``most``), however many rows there are.
    """
    keys = df.select(F.col(key).cast("long").alias("k"))
    n = keys.count()
    buckets = min(most, -(-n // rows_per_bucket))
    if buckets < 2:
        return []
    shares = [i / buckets for i in range(1, buckets)]
    found = keys.agg(F.percentile_approx("k", shares, max(10_000, 4 * buckets)).alias("q")).first()["q"]
    return sorted(set(found or []))


def bucket_of(key: Column, bounds: list[int]) -> Column:
    """The number of bounds that are not above the key, by binary search; a NULL key is in bucket 0."""
    if not bounds:
        return F.lit(0)
    steps = F.array(*[F.lit(1 << s) for s in reversed(range(len(bounds).bit_length()))])
    table = F.lit(bounds)

    def step(low: Column, width: Column) -> Column:
        return F.when(F.get(table, low + width - 1) <= key, low + width).otherwise(low)

    return F.when(key.isNull(), F.lit(0)).otherwise(F.aggregate(steps, F.lit(0), step))


def ascii_lower_words(raw: bytes | None, separators: bytes) -> list[bytes]:
    """Words of a UTF-8 text: ``separators`` maps every separator byte to a space and A-Z to a-z."""
    return raw.translate(separators).split() if raw else []


#: Letters and digits of ASCII and everything beyond ASCII make words; A-Z become a-z.
ALNUM_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
