"""Insert-or-update by key on frames and on partitioned parquet tables."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


class DuplicateKeys(ValueError):
    """The source of an upsert holds a key more than once."""


def unique_by(source: DataFrame, keys: list[str], check: str = "lazy") -> DataFrame:
    """The source, guarded against repeated keys.

    ``lazy`` fails while the result is computed, ``eager`` runs a count before anything else, ``none``
    trusts the caller.
    """
    if check == "none":
        return source
    if check == "eager":
        repeated = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
        found = repeated.limit(1).collect()
        if found:
            raise DuplicateKeys(f"several source rows for {found[0].asDict()}")
        return source
    known = F.concat(*[F.col(k).cast("string") for k in keys]).isNotNull()
    # Rows without a full key match nothing and may repeat: spread them instead of gathering them.
    spread = F.when(~known, F.xxhash64(*source.columns))
    rank = F.row_number().over(Window.partitionBy(*keys, spread).orderBy(*keys))
    message = F.concat(F.lit("several source rows for key "), F.to_json(F.struct(*keys)))
    guard = F.when(known & (F.col("_rank") > 1), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return source.withColumn("_rank", rank).where(guard).drop("_rank")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update_cols: list[str] | None = None,
    check: str = "lazy",
) -> DataFrame:
    """Target rows replaced by source rows of the same key, and source rows with new keys added.

    With ``update_cols`` only those columns of matched rows change, to the source value even when it
    is NULL; target and source meet in one full outer join. Otherwise the target meets the source by an
    anti join, so a source small enough for Spark's broadcast threshold leaves the target unshuffled.
    Keys are compared with ``=``: a NULL key matches nothing.
    """
    guarded = unique_by(source, keys, check)
    if update_cols is None:
        untouched = target.join(source.select(*keys), keys, "left_anti").select(*target.columns)
        return untouched.unionByName(guarded.select(*target.columns))

    incoming = guarded.select(*[F.col(c).alias(f"_new_{c}") for c in target.columns], F.lit(True).alias("_hit"))
    held = target.withColumn("_old", F.lit(True))
    same = reduce(and_, [F.col(k) == F.col(f"_new_{k}") for k in keys])
    joined = held.join(incoming, same, "full_outer")
    changed = set(update_cols)
    return joined.select(
        *[
            F.when(F.col("_old").isNull() | (F.col("_hit") if c in changed else F.lit(False)), F.col(f"_new_{c}"))
            .otherwise(F.col(c))
            .alias(c)
            for c in target.columns
        ]
    )


def upsert_table(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: list[str],
    partition: str,
    update_cols: list[str] | None = None,
    writers: int = 4,
) -> None:
    """Upsert into a parquet table, rewriting only the partitions that the source touches.

    ``writers`` tasks share each partition value, so one large day is not written by one task.

    The partition column must be a function of the key, or a row that moves would stay behind in its
    old partition. Spark stages the new files and swaps partitions when the job commits, so a lost
    executor costs a retry and nothing else.
    """
    try:
        target = spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        target = None
    if target is None:
        rows = unique_by(source, keys)
    else:
        touched = [r[0] for r in source.select(partition).distinct().collect()]
        known = F.col(partition).isin([t for t in touched if t is not None])
        affected = known | F.col(partition).isNull() if None in touched else known
        rows = upsert(target.where(affected), source, keys, update_cols)
    writer = rows.repartition(partition, F.pmod(F.xxhash64(*keys), F.lit(writers)))
    writer.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
