"""Views that the dashboards read: projections and filters of the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions.risk import LEVELS, knots, risk_score, safety_level, speed
from tidewright.operators.shape import in_horizon


def current_view(current: DataFrame) -> DataFrame:
    """Traffic light per zone."""
    return current.select(
        "zona_id", "timestamp_forecast_actual", "risk_score", "safety_level", "alerta_texto",
        "wave_height_m", "wind_speed_kts", "visibility_km", "altura_marea_m", "minutes_since_update",
    )


def forecast_view(zone_hour: DataFrame, as_of, hours: float = 72) -> DataFrame:
    """Wave, wind and rain of the coming hours per zone, with their score and level."""
    coming = in_horizon(zone_hour, "timestamp_forecast", as_of, hours)
    wind = knots("wind_speed_ms")
    scored = coming.withColumn(
        "risk_score",
        risk_score("wave_height_m", wind, speed("corriente_u_ms", "corriente_v_ms"), "visibility_km"),
    )
    leveled = scored.withColumn("safety_level", safety_level("risk_score", "wave_height_m", wind, "visibility_km"))
    return leveled.select(
        "zona_id", "timestamp_forecast", "wave_height_m", wind.alias("wind_speed_kts"),
        "precipitation_3h_mm", "visibility_km", "altura_marea_m", "risk_score", "safety_level",
    )


def favourable_view(zone_hour: DataFrame, as_of, hours: float = 72) -> DataFrame:
    """The coming hours that are safe."""
    return forecast_view(zone_hour, as_of, hours).where(F.col("safety_level") == LEVELS["safe"])


def prediction_view(predictions: DataFrame, as_of, hours: float = 72) -> DataFrame:
    """Predicted score and level of the coming hours."""
    coming = in_horizon(predictions, "timestamp_forecast", as_of, hours)
    return coming.select("zona_id", "timestamp_forecast", "risk_score_pred", "safety_level_pred", "model_version")


def importance_view(importances: DataFrame, n: int | None = None) -> DataFrame:
    """The features by importance, all of them or the ``n`` first."""
    ranked = importances.orderBy("rank")
    return ranked if n is None else ranked.limit(n)
