"""Writes of whole frames: range reload, overwrite, append-only log, clustered layout."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.scalars import as_literal
from tidewright.session import settle


def replaced_rows(old: DataFrame, new: DataFrame, date_col: str, start: date) -> DataFrame:
    """What a table holds after every date from ``start`` on is replaced by the new rows of those dates."""
    first = as_literal(start).cast("date")
    keep = F.coalesce(F.col(date_col) < first, F.lit(True))
    return old.where(keep).unionByName(new.where(F.col(date_col) >= first).select(*old.columns))


def replace_range(spark: SparkSession, path: str, new: DataFrame, date_col: str, start: date) -> None:
    """Idempotent reload of a table partitioned by date: drop dates from ``start`` on, then add the new rows.

    The new rows are computed once and settled. Dates that receive none are emptied by Spark's writer, which leaves a
    file without rows in their folder; then the others are swapped by dynamic partition overwrite in one commit. A reader
    in between sees the old rows of dates still to be swapped.
    """
    first = as_literal(start).cast("date")
    rows = settle(new.where(F.col(date_col) >= first), "replacement")
    try:
        held = spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        held = None
    if held is not None:
        # Dates, not rows: as few as the days of the range.
        stale = held.where(F.col(date_col) >= first).select(date_col).distinct().join(rows.select(date_col).distinct(), date_col, "left_anti")
        none = spark.createDataFrame([], held.drop(date_col).schema)
        for (day,) in stale.collect():
            overwrite(none, f"{path}/{date_col}={day}")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date_col).parquet(path)


def overwrite(df: DataFrame, path: str, partition: str | None = None) -> None:
    """Replace a whole output; it must not be read by the same query."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def log_results(log: DataFrame, path: str) -> None:
    """Append verdicts to the validation log."""
    log.write.mode("append").parquet(path)


def recent_log(log: DataFrame, n: int) -> DataFrame:
    """The latest verdicts."""
    return log.orderBy(F.col("run_at").desc(), F.col("path")).limit(n)


def write_clustered(df: DataFrame, path: str, cols: list[str], partition: str | None = None, files: int | None = None) -> None:
    """Lay a table out so that filters on ``cols`` skip most files and row groups."""
    keys = [partition, *cols] if partition else cols
    ranged = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    overwrite(ranged.sortWithinPartitions(*keys), path, partition)
