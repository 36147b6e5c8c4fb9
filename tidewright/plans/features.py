"""Model features from the zone-hour table. One function serves training and scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions.risk import knots, risk_score, safety_level, speed
from tidewright.functions.scalars import as_literal
from tidewright.operators.shape import calendar, in_horizon, interactions
from tidewright.operators.windows import HOUR, deltas, lags, trailing_stats
from tidewright.schemas import FEATURE_COLUMNS

TRAILING = {
    "wave_height_mean_24h": ("wave_height_m", "mean", 24 * HOUR),
    "wave_height_max_24h": ("wave_height_m", "max", 24 * HOUR),
    "wave_height_std_24h": ("wave_height_m", "std", 24 * HOUR),
    "wind_speed_mean_24h": ("wind_speed_ms", "mean", 24 * HOUR),
    "wind_speed_max_24h": ("wind_speed_ms", "max", 24 * HOUR),
    "precipitation_sum_24h": ("precipitation_mm", "sum", 24 * HOUR),
    "wave_height_max_6h": ("wave_height_m", "max", 6 * HOUR),
    "wind_speed_max_6h": ("wind_speed_ms", "max", 6 * HOUR),
}
LAGGED = {
    "wave_height_lag_1h": ("wave_height_m", 1),
    "wave_height_lag_3h": ("wave_height_m", 3),
    "wave_height_lag_6h": ("wave_height_m", 6),
    "wave_height_lag_12h": ("wave_height_m", 12),
    "wind_speed_lag_1h": ("wind_speed_ms", 1),
    "wind_speed_lag_3h": ("wind_speed_ms", 3),
}
TRENDS = {"wave_height_delta_3h": "wave_height_m", "wind_speed_delta_3h": "wind_speed_ms"}
PRODUCTS = {
    "wave_wind_interaction": ("wave_height_m", "wind_speed_ms"),
    "wave_current_interaction": ("wave_height_m", "corriente_speed_ms"),
}


def features(
    zone_hour: DataFrame,
    as_of=None,
    horizon_hours: float | None = None,
    slice_rows: int | None = None,
) -> DataFrame:
    """Target, level and model inputs per zone and hour.

    A missing current component counts as zero here. With ``horizon_hours`` only the hours from
    ``as_of`` on are returned; earlier hours still feed the windows.
    """
    based = zone_hour.withColumn("corriente_speed_ms", speed("corriente_u_ms", "corriente_v_ms", 0.0))
    scored = based.withColumn(
        "risk_score",
        risk_score("wave_height_m", knots("wind_speed_ms"), "corriente_speed_ms", "visibility_km"),
    )
    scored = scored.withColumn(
        "safety_level", safety_level("risk_score", visibility_km="visibility_km", variant="features")
    )
    trailing = trailing_stats(scored, ["zona_id"], "timestamp_forecast", TRAILING)
    lagged = lags(trailing, ["zona_id"], "timestamp_forecast", LAGGED, slice_rows=slice_rows)
    trended = deltas(lagged, ["zona_id"], "timestamp_forecast", TRENDS, 3, slice_rows=slice_rows)
    full = calendar(interactions(trended, PRODUCTS), "timestamp_forecast").select(*FEATURE_COLUMNS)
    if horizon_hours is not None:
        full = in_horizon(full, "timestamp_forecast", as_of, horizon_hours)
    known = full.where(F.col("risk_score").isNotNull())
    if as_of is None:
        return known
    return known.withColumn("created_at", as_literal(as_of, zone_hour.schema["timestamp_forecast"].dataType))
