"""Landed feeds to checked facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewright.functions.risk import star_rating
from tidewright.functions.scalars import as_literal, parse_ts, tide_kind, truncate
from tidewright.operators.aggregates import consolidate
from tidewright.operators.joins import next_event
from tidewright.operators.shape import any_present, explode_rows, project_nested, split_valid, with_run_date
from tidewright.operators.windows import latest_per_key
from tidewright.schemas import (
    EXTREME_KEY,
    GRID_BRONZE,
    GRID_RANGES,
    GRID_VALUES,
    TIDE_KEY,
    TIDE_RANGES,
    WEATHER_KEY,
    WEATHER_METRICS,
    WEATHER_RANGES,
)
from tidewright.sources.conform import ensure_columns

# The height is judged per reading, the wait for the next extreme once that is known.
HEIGHT_RANGE = {"altura_marea_m": TIDE_RANGES["altura_marea_m"]}
WAIT_RANGE = {"horas_hasta_cambio_marea": TIDE_RANGES["horas_hasta_cambio_marea"]}


def _complete(df: DataFrame, keys: list[str], on_null: str) -> DataFrame:
    """Guard key columns: ``fail`` raises while the rows are computed, ``drop`` removes incomplete rows, ``keep`` lets them be."""
    if on_null == "keep":
        return df
    whole = F.col(keys[0]).isNotNull()
    for k in keys[1:]:
        whole = whole & F.col(k).isNotNull()
    if on_null == "drop":
        return df.where(whole)
    names = ", ".join(keys)
    return df.where(F.when(whole, F.lit(True)).otherwise(F.raise_error(F.lit(f"NULL in {names}")).cast("boolean")))


def weather_rows(bronze: DataFrame, as_of, source: str = "stormglass", providers: list[str] | None = None) -> DataFrame:
    """One flat row per point and forecast hour, before any check."""
    hours = explode_rows(bronze, "raw_data.hours", "hour", ["punto_id", "zona_id", "timestamp_ingesta"])
    keys = [
        F.col("punto_id").cast("string").alias("punto_id"),
        F.col("zona_id").cast("string").alias("zona_id"),
        parse_ts(F.col("hour.time")).alias("timestamp_forecast"),
        parse_ts(F.col("timestamp_ingesta")).alias("run_ts"),
    ]
    flat = project_nested(hours, "hour", WEATHER_METRICS, providers or ["sg"], keys)
    return flat.withColumns({"source": F.lit(source), "created_at": as_literal(as_of)})


def silver_weather(
    bronze: DataFrame,
    as_of,
    source: str = "stormglass",
    providers: list[str] | None = None,
    on_null: str = "fail",
) -> DataFrame:
    """Weather fact: flat, in range, one row per (point, hour, run)."""
    rows = _complete(weather_rows(bronze, as_of, source, providers), [*WEATHER_KEY, "zona_id"], on_null)
    valid, _ = split_valid(rows, WEATHER_RANGES)
    return with_run_date(latest_per_key(valid, WEATHER_KEY, ["created_at"]))


def tide_rows(bronze: DataFrame, array: str, moment: str, as_of, source: str) -> DataFrame:
    """One row per element of a tide array: keys, height and state."""
    split = explode_rows(bronze, f"raw_data.{array}", "m", ["punto_id", "zona_id", "timestamp_ingesta"])
    return split.select(
        F.col("punto_id").cast("string").alias("punto_id"),
        F.col("zona_id").cast("string").alias("zona_id"),
        parse_ts(F.col("m.datetime")).alias(moment),
        parse_ts(F.col("timestamp_ingesta")).alias("run_ts"),
        F.col("m.height").cast("double").alias("height"),
        F.col("m.state").cast("string").alias("state"),
        F.lit(source).alias("source"),
        as_literal(as_of).alias("created_at"),
    )


def silver_tide(
    bronze: DataFrame,
    as_of,
    source: str = "marea",
    on_null: str = "fail",
) -> tuple[DataFrame, DataFrame]:
    """Tide facts: the height series with the next extreme, and the extremes with daily amplitude and stars."""
    heights = tide_rows(bronze, "heights", "timestamp_forecast", as_of, source)
    extremes = tide_rows(bronze, "extremes", "timestamp_extremo", as_of, source)
    extremes = extremes.withColumn("state", tide_kind("state"))
    extremes = extremes.withColumnsRenamed({"height": "altura_m", "state": "tipo"})
    return _tide_series(heights, extremes, on_null), _tide_extremes(extremes, on_null)


def _tide_series(heights: DataFrame, extremes: DataFrame, on_null: str) -> DataFrame:
    """Duplicates go first: what is left of a run has one reading per moment of its horizon, so the
    next extreme can be found in one sort per point and run."""
    series = heights.drop("state").withColumnRenamed("height", "altura_marea_m")
    valid, _ = split_valid(_complete(series, [*TIDE_KEY, "zona_id"], on_null), HEIGHT_RANGE)
    followed = next_event(
        latest_per_key(valid, TIDE_KEY, ["created_at"]),
        extremes,
        by=["punto_id", "run_ts"],
        left_ts="timestamp_forecast",
        right_ts="timestamp_extremo",
        cols=["tipo"],
        slice_seconds=None,
        hours="horas_hasta_cambio_marea",
    )
    near, _ = split_valid(followed.withColumnRenamed("tipo", "tipo_proximo_cambio"), WAIT_RANGE)
    return with_run_date(
        near.select(
            "punto_id", "zona_id", "timestamp_forecast", "run_ts", "altura_marea_m",
            "horas_hasta_cambio_marea", "tipo_proximo_cambio", "source", "created_at",
        )
    )


def _tide_extremes(extremes: DataFrame, on_null: str) -> DataFrame:
    """One row per extreme. Copies are combined first, each bringing its height into the day's amplitude."""
    whole = _complete(extremes, [*EXTREME_KEY, "zona_id", "altura_m", "tipo"], on_null)
    rest = ["created_at", "zona_id", "altura_m", "tipo", "source"]
    single = whole.groupBy(*EXTREME_KEY).agg(
        F.max(F.struct(*rest)).alias("row"),
        F.max(F.when(F.col("tipo").contains("HIGH"), F.col("altura_m"))).alias("high"),
        F.min(F.when(F.col("tipo").contains("LOW"), F.col("altura_m"))).alias("low"),
    )
    day = Window.partitionBy("punto_id", "run_ts", F.to_date("timestamp_extremo"))
    span = F.abs(F.max("high").over(day) - F.min("low").over(day))
    rated = single.select(*EXTREME_KEY, "row.*", span.alias("amplitud_dia_m"))
    rated = rated.withColumn("calidad_estrellas", star_rating("amplitud_dia_m"))
    return with_run_date(
        rated.select(
            "punto_id", "zona_id", "timestamp_extremo", "run_ts", "altura_m", "tipo",
            "amplitud_dia_m", "calidad_estrellas", "source", "created_at",
        )
    )


def silver_grid(bronze: DataFrame, as_of, source: str = "copernicus") -> DataFrame:
    """Grid fact: one row per cell, hour and run with at least one ocean value.

    Rows of files without an ingest time belong to the run at ``as_of``. Key and range findings are
    reported by the quality rules and not removed.
    """
    full = ensure_columns(bronze, {f.name: f.dataType for f in GRID_BRONZE.fields})
    run = F.coalesce(F.col("timestamp_ingesta").try_cast("timestamp"), as_literal(as_of))
    cells = full.withColumn("time", F.col("time").try_cast("timestamp"))
    cells = cells.select(
        F.col("zona_id").cast("string").alias("zona_id"),
        truncate(cells, "time").alias("timestamp_forecast"),
        F.col("latitude").cast("double").alias("lat"),
        F.col("longitude").cast("double").alias("lon"),
        run.alias("run_ts"),
        *[F.col(c).cast("double").alias(c) for c in GRID_VALUES],
    )
    keys = ["zona_id", "timestamp_forecast", "lat", "lon", "run_ts"]
    fact = any_present(consolidate(cells, keys, GRID_VALUES), list(GRID_VALUES.values()))
    fact = fact.withColumns({"source": F.lit(source), "created_at": as_literal(as_of)})
    return with_run_date(fact)


def grid_range_report(fact: DataFrame) -> DataFrame:
    """Grid cells with an impossible value."""
    return split_valid(fact, GRID_RANGES)[1]
