"""Silver facts to the zone-hour table and the current conditions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions.risk import alert_text, knots, risk_score, safety_level, speed
from tidewright.functions.scalars import as_literal, minutes_since
from tidewright.operators.aggregates import agg_grid, agg_tide_hour, agg_zone_hour
from tidewright.operators.joins import join_daily
from tidewright.operators.shape import in_horizon, latest_run, since
from tidewright.operators.windows import best_run, forward_sum, latest_per_key, pick_current
from tidewright.schemas import CURRENT_COLUMNS, GRID_VALUES, ZONE_HOUR, ZONE_METRICS


def _recent(df: DataFrame, as_of, days: int | None) -> DataFrame:
    """Rows of recent runs, by the stored partition date where the table has one so that whole partitions are skipped."""
    if days is None:
        return df
    return since(df, "run_date" if "run_date" in df.columns else "run_ts", as_of, days=days)


def _newest(df: DataFrame, as_of, days: int | None) -> DataFrame:
    partition = "run_date" if "run_date" in df.columns else None
    return latest_run(_recent(df, as_of, days), "run_ts", partition)


def _grid_per_day(dated: DataFrame, ties: str) -> DataFrame:
    """Mean grid values per zone and day, from the newest run that has data for that day."""
    keys, values = ["zona_id", "_day"], list(GRID_VALUES.values())
    if ties != "all":
        return agg_grid(best_run(dated, keys, "run_ts", ties), keys, values, "run_ts")
    # Cells are averaged per run first: one pass over the cells, and few rows left to choose from.
    per_run = agg_grid(dated, [*keys, "run_ts"], values, "run_ts")
    return latest_per_key(per_run, keys, ["run_ts"]).drop("run_ts")


def gold_zone_hour(
    weather: DataFrame,
    tide: DataFrame,
    grid: DataFrame,
    as_of,
    hours: float = 72,
    lookback_days: int | None = 2,
    grid_lookback_days: int | None = 3,
    ties: str = "all",
) -> DataFrame:
    """Forecast per zone and hour: newest weather and tide run, best grid run per day spread over its hours.

    Weather and tide define which hours exist. The grid has one value per day and lags by one, so
    each day takes the newest run that has data for it.
    """
    # The time window is put on the facts themselves, where it reaches the scan. A tide reading counts
    # for the hour it falls into, so its last hour may run past the window until it is truncated.
    weather_rows = in_horizon(_newest(weather, as_of, lookback_days), "timestamp_forecast", as_of, hours)
    weather_zone = agg_zone_hour(weather_rows, ZONE_METRICS, ZONE_HOUR, "punto_id", "run_ts")

    tide_rows = in_horizon(_newest(tide, as_of, lookback_days), "timestamp_forecast", as_of, hours + 1)
    tide_zone = agg_tide_hour(
        tide_rows, "zona_id", "timestamp_forecast", "altura_marea_m", "tipo_proximo_cambio", "run_ts"
    )
    tide_zone = in_horizon(tide_zone, "timestamp_forecast", as_of, hours)

    first_day = F.date_trunc("day", as_literal(as_of))
    grid_rows = in_horizon(_recent(grid, as_of, grid_lookback_days), "timestamp_forecast", first_day, hours + 24)
    grid_day = _grid_per_day(grid_rows.withColumn("_day", F.to_date("timestamp_forecast")), ties)

    # Both sides are grouped by the same keys already, so they meet where they are.
    joined = weather_zone.join(tide_zone, ZONE_HOUR, "full_outer")
    gold = join_daily(joined, grid_day, "zona_id", "timestamp_forecast", "_day")
    gold = gold.withColumn("updated_at", as_literal(as_of, gold.schema["timestamp_forecast"].dataType))
    return forward_sum(gold, ["zona_id"], "timestamp_forecast", "precipitation_mm", 2, 1, "precipitation_3h_mm")


def gold_current(zone_hour: DataFrame, as_of, hours: float = 3) -> DataFrame:
    """Conditions of the first forecast hour of each zone at or after ``as_of``, with score, level and alert."""
    now = as_literal(as_of, zone_hour.schema["timestamp_forecast"].dataType)
    picked = pick_current(zone_hour, ["zona_id"], "timestamp_forecast", as_of, hours)
    with_speeds = picked.withColumns(
        {
            "timestamp_forecast_actual": F.col("timestamp_forecast"),
            "wind_speed_kts": knots("wind_speed_ms"),
            "corriente_speed_ms": speed("corriente_u_ms", "corriente_v_ms"),
        }
    )
    scored = with_speeds.withColumn(
        "risk_score", risk_score("wave_height_m", "wind_speed_kts", "corriente_speed_ms", "visibility_km")
    )
    judged = scored.withColumns(
        {
            "safety_level": safety_level("risk_score", "wave_height_m", "wind_speed_kts", "visibility_km"),
            "alerta_texto": alert_text("risk_score", "wave_height_m", "wind_speed_kts"),
            "source_updated_at": F.col("updated_at"),
            "minutes_since_update": minutes_since("updated_at", now),
            "updated_at": now,
        }
    )
    return judged.select(*CURRENT_COLUMNS)
