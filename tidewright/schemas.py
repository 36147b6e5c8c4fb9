"""Schemas of the landed feeds and the column contracts of the tables.

Fixed values: names, types and order are the data contract with existing feeds and tables.
"""

from __future__ import annotations

from pyspark.sql import types as T

WEATHER_FIELDS = [
    "waveHeight",
    "waveDirection",
    "wavePeriod",
    "swellHeight",
    "swellDirection",
    "swellPeriod",
    "windSpeed",
    "windDirection",
    "gust",
    "airTemperature",
    "pressure",
    "precipitation",
    "cloudCover",
    "visibility",
]

# Flat metric name of each nested weather field.
WEATHER_METRICS = {
    "waveHeight": "wave_height_m",
    "waveDirection": "wave_direction_deg",
    "wavePeriod": "wave_period_s",
    "swellHeight": "swell_height_m",
    "swellDirection": "swell_direction_deg",
    "swellPeriod": "swell_period_s",
    "windSpeed": "wind_speed_ms",
    "windDirection": "wind_direction_deg",
    "gust": "gust_ms",
    "airTemperature": "air_temperature_c",
    "pressure": "pressure_hpa",
    "precipitation": "precipitation_mm",
    "cloudCover": "cloud_cover_pct",
    "visibility": "visibility_km",
}

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def flat(text: str) -> T.StructType:
    """A schema from ``name type, name type, ...``; needs no running session."""
    pairs = [part.split() for part in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


POINT_COLUMNS = flat(
    """
    punto_id string, zona_id string, zona_nombre string, tipo_punto string,
    lat double, lng double, region string, provincias string,
    timestamp_ingesta string, contexto string, source string
    """
)
TIDE_MOMENT = flat("timestamp bigint, datetime string, height double, state string")


def _reply(**arrays: T.StructType) -> T.StructType:
    """The shared columns of a point feed with the reply nested in ``raw_data``."""
    raw = T.StructType([T.StructField(name, T.ArrayType(element)) for name, element in arrays.items()])
    return T.StructType([*POINT_COLUMNS.fields, T.StructField("raw_data", raw)])


def weather_bronze(providers: tuple[str, ...] = ("sg",)) -> T.StructType:
    """One row per point and run; the hourly reply is an array of structs with one value per provider."""
    value = T.StructType([T.StructField(p, T.DoubleType()) for p in providers])
    hour = T.StructType([T.StructField("time", T.StringType()), *[T.StructField(f, value) for f in WEATHER_FIELDS]])
    return _reply(hours=hour)


def tide_bronze() -> T.StructType:
    """One row per point and run with arrays of tide heights and extremes."""
    return _reply(heights=TIDE_MOMENT, extremes=TIDE_MOMENT)


GRID_BRONZE = flat(
    """
    time timestamp, depth double, latitude double, longitude double,
    thetao double, so double, uo double, vo double,
    zona_id string, nombre_zona string, tipo_dato string, timestamp_ingesta timestamp
    """
)
GRID_HISTORY = flat(
    """
    time timestamp, depth double, latitude double, longitude double,
    thetao double, so double, uo double, vo double,
    zona_id string, nombre_zona string, tipo_dato string, year_month string
    """
)
GRID_VALUES = {
    "thetao": "temperatura_mar_c",
    "so": "salinidad_psu",
    "uo": "corriente_u_ms",
    "vo": "corriente_v_ms",
}

LANDED_NOTICE = flat("source string, path string, run_ts string")

ZONES = flat(
    """
    zona_id string, zona_nombre string, provincias string, lat_centro double, lon_centro double
    """
)
POINTS_DOCUMENT = T.StructType(
    [
        T.StructField(
            "puntos_muestreo",
            T.ArrayType(
                flat(
                    """
                    id string, zona_id string, zona_nombre string, tipo_punto string,
                    lat double, lng double, provincias string, region string, activo string
                    """
                )
            ),
        )
    ]
)

WEATHER_KEY = ["punto_id", "timestamp_forecast", "run_ts"]
TIDE_KEY = ["punto_id", "timestamp_forecast", "run_ts"]
EXTREME_KEY = ["punto_id", "timestamp_extremo", "run_ts"]
GRID_KEY = ["zona_id", "timestamp_forecast", "lat", "lon", "run_ts"]
ZONE_HOUR = ["zona_id", "timestamp_forecast"]

# Closed ranges outside which a reading is physically impossible.
WEATHER_RANGES = {
    "wave_height_m": (0.0, 20.0),
    "wind_speed_ms": (0.0, 50.0),
    "air_temperature_c": (-20.0, 50.0),
    "pressure_hpa": (900.0, 1100.0),
    "cloud_cover_pct": (0.0, 100.0),
    "visibility_km": (0.0, 100.0),
}
TIDE_RANGES = {
    "altura_marea_m": (-2.0, 6.0),
    "horas_hasta_cambio_marea": (0.0, 12.0),
}
GRID_RANGES = {
    "temperatura_mar_c": (-2.0, 35.0),
    "salinidad_psu": (20.0, 45.0),
    "corriente_u_ms": (-5.0, 5.0),
    "corriente_v_ms": (-5.0, 5.0),
}
GRID_REQUIRED = ["time", "latitude", "longitude", "zona_id", "nombre_zona", "tipo_dato"]
GRID_NATURAL_KEY = ["zona_id", "time", "latitude", "longitude", "tipo_dato"]

# Metrics averaged from weather points to the zone and hour.
ZONE_METRICS = [
    "wave_height_m",
    "wind_speed_ms",
    "air_temperature_c",
    "precipitation_mm",
    "cloud_cover_pct",
    "visibility_km",
]

VALIDATION_LOG = flat(
    """
    run_at timestamp, source string, path string, status string, schema_fp string,
    puntos_cnt int, bad_puntos int, dup_keys int, violations string
    """
)

CURRENT_COLUMNS = [
    "zona_id",
    "timestamp_forecast_actual",
    "wave_height_m",
    "wind_speed_ms",
    "wind_speed_kts",
    "precipitation_mm",
    "cloud_cover_pct",
    "visibility_km",
    "altura_marea_m",
    "tipo_proximo_cambio",
    "temperatura_mar_c",
    "salinidad_psu",
    "corriente_u_ms",
    "corriente_v_ms",
    "corriente_speed_ms",
    "risk_score",
    "safety_level",
    "alerta_texto",
    "source_updated_at",
    "updated_at",
    "minutes_since_update",
]

# Model inputs in vector order; the zone code follows as the last feature.
NUMERIC_FEATURES = [
    "wave_height_m",
    "wind_speed_ms",
    "air_temperature_c",
    "precipitation_mm",
    "precipitation_3h_mm",
    "visibility_km",
    "altura_marea_m",
    "temperatura_mar_c",
    "salinidad_psu",
    "corriente_speed_ms",
    "wave_height_mean_24h",
    "wave_height_max_24h",
    "wave_height_std_24h",
    "wind_speed_mean_24h",
    "wind_speed_max_24h",
    "precipitation_sum_24h",
    "wave_height_max_6h",
    "wind_speed_max_6h",
    "wave_height_lag_1h",
    "wave_height_lag_3h",
    "wave_height_lag_6h",
    "wave_height_lag_12h",
    "wind_speed_lag_1h",
    "wind_speed_lag_3h",
    "wave_height_delta_3h",
    "wind_speed_delta_3h",
    "hour_of_day",
    "day_of_week",
]
# Derived from the target itself, so kept in the table but out of the model.
INTERACTION_COLUMNS = ["wave_wind_interaction", "wave_current_interaction"]
FEATURE_COLUMNS = [
    "zona_id",
    "timestamp_forecast",
    "risk_score",
    "safety_level",
    *NUMERIC_FEATURES[:-2],
    *INTERACTION_COLUMNS,
    *NUMERIC_FEATURES[-2:],
    "is_weekend",
]
