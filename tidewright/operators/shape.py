"""Row shaping: exploding arrays, projecting nested values, filters on time and range, derived columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.scalars import as_literal


def explode_rows(df: DataFrame, array: str, out: str, keep: list[str], outer: bool = False) -> DataFrame:
    """One row per array element. Rows with a NULL or empty array vanish, or stay with a NULL when ``outer``."""
    split = F.explode_outer if outer else F.explode
    return df.select(*keep, split(F.col(array)).alias(out))


def project_nested(
    df: DataFrame,
    struct: str,
    names: dict[str, str],
    providers: list[str],
    keep: list[Column],
) -> DataFrame:
    """Flat double columns from a struct of per-provider structs.

    The first provider in the list that has a value wins. A field or provider missing from the schema
    gives NULL, and so does a value that cannot be cast.
    """
    fields = {f.name: f.dataType for f in df.schema[struct].dataType.fields}

    def flat(name: str) -> Column:
        kind = fields.get(name)
        if kind is None:
            return F.lit(None).cast("double")
        if not isinstance(kind, T.StructType):
            return F.col(f"{struct}.{name}").try_cast("double")
        found = [F.col(f"{struct}.{name}.{p}").try_cast("double") for p in providers if p in kind.names]
        return F.coalesce(*found) if found else F.lit(None).cast("double")

    return df.select(*keep, *[flat(name).alias(out) for name, out in names.items()])


def in_horizon(df: DataFrame, ts: str, as_of, hours: float) -> DataFrame:
    """Rows in the half-open window [as_of, as_of + hours)."""
    start = as_literal(as_of, df.schema[ts].dataType)
    end = start + F.make_dt_interval(hours=F.lit(0), secs=F.lit(hours * 3600).cast("decimal(18,6)"))
    return df.where((F.col(ts) >= start) & (F.col(ts) < end))


def since(df: DataFrame, column: str, as_of, days: int | None = None, hours: float | None = None) -> DataFrame:
    """Rows not older than a number of days (on a date column) or hours (on a timestamp)."""
    kind = df.schema[column].dataType
    if days is not None:
        start = F.date_sub(as_literal(as_of).cast("date"), days)
        if not isinstance(kind, T.DateType):
            start = start.cast(kind)
        return df.where(F.col(column) >= start)
    if hours is None:
        raise ValueError("give days or hours")
    span = F.make_dt_interval(hours=F.lit(0), secs=F.lit(hours * 3600).cast("decimal(18,6)"))
    return df.where(F.col(column) >= as_literal(as_of, kind) - span)


def latest_run(df: DataFrame, run: str = "run_ts", partition: str | None = None) -> DataFrame:
    """Rows of the newest run only; the whole frame when no row has a run.

    The newest run is a scalar subquery over the one column, so nothing passes through the driver.
    ``partition`` names a stored date of the run: filtering on it too lets the scan skip the
    partitions of all other days once the subquery is known.
    """
    newest = df.select(F.max(run).alias("newest")).scalar()
    chosen = F.col(run) == newest
    if partition is not None:
        chosen = chosen & (F.col(partition) == newest.cast("date"))
    return df.where(chosen | newest.isNull())


def any_present(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows where at least one of the columns has a value."""
    return df.where(F.coalesce(*[F.col(c) for c in cols]).isNotNull())


def out_of_range(rules: dict[str, tuple[float, float]]) -> Column:
    """True where any metric lies outside its closed range. A missing metric is valid."""
    outside = [~F.col(name).between(low, high) for name, (low, high) in rules.items()]
    return F.coalesce(reduce(Column.__or__, [F.coalesce(o, F.lit(False)) for o in outside]), F.lit(False))


def split_valid(df: DataFrame, rules: dict[str, tuple[float, float]]) -> tuple[DataFrame, DataFrame]:
    """(rows within all ranges, rows outside some range). Duplicates stay on their side."""
    bad = out_of_range(rules)
    return df.where(~bad), df.where(bad)


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join in which a missing key part matches a missing key part, as in a window partition."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, same, "left").drop(*[f"_right_{k}" for k in keys])


def key_universe(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Distinct keys over all frames."""
    stacked = reduce(DataFrame.unionByName, [df.select(*keys) for df in frames])
    return stacked.dropDuplicates(keys)


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that do not occur in ``right``."""
    return left.subtract(right.select(*left.columns))


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """The first rows in an order: each task keeps k rows, then the k best of those are merged."""
    return df.orderBy(*order).limit(k)


def interactions(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Products of column pairs."""
    return df.withColumns({out: F.col(a) * F.col(b) for out, (a, b) in pairs.items()})


def calendar(df: DataFrame, ts: str) -> DataFrame:
    """Hour of day, day of week (Sunday is 1) and weekend flag."""
    day = F.dayofweek(F.col(ts))
    return df.withColumns(
        {"hour_of_day": F.hour(F.col(ts)), "day_of_week": day, "is_weekend": day.isin(1, 7)}
    )


def with_run_date(df: DataFrame, run: str = "run_ts", out: str = "run_date") -> DataFrame:
    """The partition date of a table, as a stored column."""
    return df.withColumn(out, F.to_date(run))
