"""Per-row shaping of landed replies. Stateless, so the same code runs on batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.scalars import run_context, tide_kind
from tidewright.schemas import WEATHER_FIELDS


def current_snapshot(bronze: DataFrame, fields: list[str] | None = None, provider: str = "sg") -> DataFrame:
    """Rows that carry forecast hours, with the first hour flattened to ``datos_actuales``.

    A field that is not a per-provider struct is taken as it is; a field missing from the feed is NULL.
    """
    hours = bronze.schema["raw_data"].dataType["hours"].dataType
    known = {f.name: f.dataType for f in hours.elementType.fields}
    first = F.try_element_at(F.col("raw_data.hours"), F.lit(1))

    def value(name: str) -> Column:
        kind = known.get(name)
        if kind is None:
            return F.lit(None).cast("double")
        if isinstance(kind, T.StructType):
            return first[name][provider] if provider in kind.names else F.lit(None).cast("double")
        return first[name]

    names = fields if fields is not None else WEATHER_FIELDS
    flat = [first["time"].alias("timestamp")] + [value(name).alias(name) for name in names]
    return bronze.where(F.size("raw_data.hours") > 0).withColumn("datos_actuales", F.struct(*flat))


def tide_stats(bronze: DataFrame, digits: int = 2) -> DataFrame:
    """Height range, mean and high/low tide figures of each row's own arrays, as ``estadisticas``."""
    heights = F.filter(F.transform("raw_data.heights", lambda m: m["height"]), lambda h: h.isNotNull())
    count = F.size(heights)
    total = F.aggregate(heights, F.lit(0.0), lambda acc, h: acc + h)

    def of_kind(kind: str) -> Column:
        return F.filter("raw_data.extremes", lambda m: tide_kind(m["state"]) == kind)

    def height_of(moments: Column) -> Column:
        return F.transform(moments, lambda m: m["height"])

    def count_of(moments: Column) -> Column:
        return F.coalesce(F.greatest(F.size(moments), F.lit(0)), F.lit(0))

    highs, lows = of_kind("HIGH"), of_kind("LOW")
    top, bottom = F.array_max(heights), F.array_min(heights)
    figures = {
        "altura_min_m": F.round(bottom, digits),
        "altura_max_m": F.round(top, digits),
        "altura_prom_m": F.round(F.when(count > 0, total / count), digits),
        "rango_marea_m": F.round(top - bottom, digits),
        "total_pleamares": count_of(highs),
        "total_bajamares": count_of(lows),
        "altura_maxima_pleamar_m": F.round(F.array_max(height_of(highs)), digits),
        "altura_minima_bajamar_m": F.round(F.array_min(height_of(lows)), digits),
    }
    return bronze.withColumn("estadisticas", F.struct(*[c.alias(name) for name, c in figures.items()]))


def enrich(bronze: DataFrame, feed: str) -> DataFrame:
    """Reading events as they are published: run context plus the snapshot or the tide figures."""
    labelled = bronze.withColumn("contexto", run_context(F.try_to_timestamp(F.col("timestamp_ingesta"))))
    if feed == "weather":
        return current_snapshot(labelled)
    if feed == "tide":
        return tide_stats(labelled)
    raise ValueError(f"unknown feed: {feed}")


def clean_grid(
    grid: DataFrame,
    value_cols: list[str],
    by: list[str] | None = None,
    depth: str = "depth",
) -> DataFrame:
    """Surface cells that carry at least one ocean value; cells over land have none.

    The surface is the smallest depth within each ``by`` group (a file or a zone). Rows without a
    depth are surface data.
    """
    if by and depth in grid.columns:
        surface = grid.groupBy(*by).agg(F.min(depth).alias("surface_depth"))
        grid = (
            grid.join(surface, by, "left")
            .where(F.col(depth).isNull() | (F.col(depth) == F.col("surface_depth")))
            .drop("surface_depth")
        )
    return grid.where(F.coalesce(*[F.col(c) for c in value_cols]).isNotNull())
