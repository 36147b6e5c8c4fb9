"""Whole plans: silver facts, gold tables, features, serving views, model figures."""

from pyspark.sql import functions as F

from tidewright.catalog.registry import query
from tidewright.catalog.standins import (
    AS_OF,
    GRID,
    MONTH_HOURS,
    MONTH_START,
    NOW,
    READINGS,
    TURN_WORDS,
    grid,
    rounded,
    tide,
    tide_replies,
    tide_sql,
    weather,
    weather_replies,
    weather_sql,
)
from tidewright.models.metrics import error_table, evaluate
from tidewright.models.risk import temporal_split
from tidewright.plans.features import features
from tidewright.plans.gold import gold_current, gold_zone_hour
from tidewright.plans.serving import current_view, favourable_view, forecast_view
from tidewright.plans.silver import silver_grid, silver_tide, silver_weather

FIXED = "2024-02-01 00:00:00"


@query(
    "silver_weather",
    f"""
    WITH {TURN_WORDS}
    SELECT punto_id, zona_id,
           TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * i AS timestamp_forecast, TIMESTAMP '2024-01-01' AS run_ts,
           h AS wave_height_m, h * 2 AS wind_speed_ms, h * 3 AS air_temperature_c, h * 4 AS precipitation_mm,
           h * 5 AS cloud_cover_pct, h * 6 AS visibility_km, CAST(NULL AS DOUBLE) AS pressure_hpa,
           'stormglass' AS source, DATE '2024-01-01' AS run_date
    FROM words WHERE h * 2 <= 50 AND h * 3 <= 50 AND h * 5 <= 100 AND h * 6 <= 100 AND h <= 20
    """,
)
def silver_weather_query(t):
    fact = silver_weather(weather_replies(t), FIXED)
    return fact.select(
        "punto_id", "zona_id", "timestamp_forecast", "run_ts", "wave_height_m", "wind_speed_ms", "air_temperature_c",
        "precipitation_mm", "cloud_cover_pct", "visibility_km", "pressure_hpa", "source", "run_date",
    )


TIDE_MOMENTS = f"""{TURN_WORDS},
    moments AS (SELECT punto_id, zona_id, TIMESTAMP '2024-01-01' + INTERVAL 10 MINUTE * i AS ts, h FROM words),
    extremes AS (
      SELECT punto_id, zona_id, ts, h, CASE WHEN h >= 9 THEN 'HIGH' ELSE 'LOW' END AS kind
      FROM moments WHERE h >= 9 OR h <= 2)"""


@query(
    "silver_tide_series",
    f"""
    WITH {TIDE_MOMENTS},
    n AS (
      SELECT m.punto_id, m.zona_id, m.ts, m.h, e.kind, (epoch(e.ts) - epoch(m.ts)) / 3600.0 AS hours
      FROM moments m ASOF LEFT JOIN extremes e ON m.punto_id = e.punto_id AND m.ts < e.ts)
    SELECT punto_id, zona_id, ts AS timestamp_forecast, TIMESTAMP '2024-01-01' AS run_ts, h AS altura_marea_m,
           hours AS horas_hasta_cambio_marea, kind AS tipo_proximo_cambio, 'marea' AS source, DATE '2024-01-01' AS run_date
    FROM n WHERE h <= 6 AND (hours IS NULL OR hours <= 12)
    """,
)
def silver_tide_series(t):
    series, _ = silver_tide(tide_replies(t), FIXED)
    return series.drop("created_at")


@query(
    "silver_tide_extremes",
    f"""
    WITH {TIDE_MOMENTS},
    d AS (
      SELECT punto_id, CAST(ts AS DATE) AS day, max(h) FILTER (WHERE kind = 'HIGH') - min(h) FILTER (WHERE kind = 'LOW') AS amp
      FROM extremes GROUP BY ALL)
    SELECT e.punto_id, e.zona_id, e.ts AS timestamp_extremo, TIMESTAMP '2024-01-01' AS run_ts, e.h AS altura_m,
           e.kind AS tipo, d.amp AS amplitud_dia_m,
           CASE WHEN amp >= 2 THEN 3 WHEN amp >= 0.5 THEN 2 ELSE 1 END AS calidad_estrellas,
           'marea' AS source, DATE '2024-01-01' AS run_date
    FROM extremes e JOIN d ON e.punto_id = d.punto_id AND CAST(e.ts AS DATE) = d.day
    """,
)
def silver_tide_extremes(t):
    _, extremes = silver_tide(tide_replies(t), FIXED)
    return extremes.drop("created_at")


@query(
    "silver_grid",
    """
    WITH c AS (
      SELECT l_returnflag AS zona_id, l_shipdate AS timestamp_forecast, CAST(l_suppkey AS DOUBLE) AS lat,
             CAST(l_linenumber AS DOUBLE) AS lon, l_orderkey, l_quantity
      FROM lineitem),
    g AS (
      SELECT zona_id, timestamp_forecast, lat, lon,
             max(l_quantity) FILTER (WHERE l_quantity < 10) AS temperatura_mar_c,
             max(l_quantity) FILTER (WHERE l_quantity BETWEEN 10 AND 20) AS salinidad_psu,
             max(l_quantity) FILTER (WHERE l_quantity BETWEEN 21 AND 30) AS corriente_u_ms
      FROM c GROUP BY ALL)
    SELECT *, CAST(NULL AS DOUBLE) AS corriente_v_ms, TIMESTAMP '2024-02-01' AS run_ts, 'copernicus' AS source,
           DATE '2024-02-01' AS run_date
    FROM g WHERE temperatura_mar_c IS NOT NULL OR salinidad_psu IS NOT NULL OR corriente_u_ms IS NOT NULL
    """,
)
def silver_grid_query(t):
    q = F.col("l_quantity")
    bronze = t.lineitem.select(
        F.col("l_returnflag").alias("zona_id"),
        F.col("l_shipdate").alias("time"),
        F.col("l_suppkey").alias("latitude"),
        F.col("l_linenumber").alias("longitude"),
        F.when(q < 10, q).alias("thetao"),
        F.when(q.between(10, 20), q).alias("so"),
        F.when(q.between(21, 30), q).alias("uo"),
    )
    return silver_grid(bronze, FIXED).drop("created_at")


def gold_sql(run: str, as_of: str, hours: int, days: int | None, grid_days: int | None) -> str:
    """The zone-hour table as SQL, ending in a table named gold."""
    recent = f"WHERE run_ts >= TIMESTAMP '{as_of}' - INTERVAL {days} DAY" if days is not None else ""
    grid_recent = f"WHERE run_ts >= TIMESTAMP '{as_of}' - INTERVAL {grid_days} DAY" if grid_days is not None else ""
    window = (
        f"timestamp_forecast >= TIMESTAMP '{as_of}' AND timestamp_forecast < TIMESTAMP '{as_of}' + INTERVAL {hours} HOUR"
    )
    return f"""{READINGS}, {weather_sql(run)}, {tide_sql(run)}, {GRID},
    w AS (
      SELECT zona_id, timestamp_forecast, avg(wave_height_m) AS wave_height_m, avg(wind_speed_ms) AS wind_speed_ms,
             avg(air_temperature_c) AS air_temperature_c, avg(precipitation_mm) AS precipitation_mm,
             avg(cloud_cover_pct) AS cloud_cover_pct, avg(visibility_km) AS visibility_km,
             count(DISTINCT punto_id) AS stormglass_n_puntos, max(run_ts) AS stormglass_run_ts
      FROM weather WHERE run_ts = (SELECT max(run_ts) FROM weather {recent}) GROUP BY ALL),
    m AS (
      SELECT zona_id, date_trunc('hour', timestamp_forecast) AS timestamp_forecast, avg(altura_marea_m) AS altura_marea_m,
             arg_min(tipo_proximo_cambio, timestamp_forecast) FILTER (WHERE tipo_proximo_cambio IS NOT NULL)
               AS tipo_proximo_cambio,
             count(*) AS marea_n_puntos, max(run_ts) AS marea_run_ts
      FROM tide WHERE run_ts = (SELECT max(run_ts) FROM tide {recent})
      GROUP BY zona_id, date_trunc('hour', timestamp_forecast)),
    g0 AS (SELECT *, CAST(timestamp_forecast AS DATE) AS day FROM grid {grid_recent}),
    g AS (
      SELECT zona_id, day, avg(temperatura_mar_c) AS temperatura_mar_c, avg(salinidad_psu) AS salinidad_psu,
             avg(corriente_u_ms) AS corriente_u_ms, avg(corriente_v_ms) AS corriente_v_ms,
             count(*) AS copernicus_n_grillas, max(run_ts) AS copernicus_run_ts
      FROM g0 WHERE run_ts = (SELECT max(run_ts) FROM g0 b WHERE b.zona_id = g0.zona_id AND b.day = g0.day) GROUP BY ALL),
    base AS (SELECT zona_id, timestamp_forecast FROM w WHERE {window}
             UNION SELECT zona_id, timestamp_forecast FROM m WHERE {window}),
    joined AS (
      SELECT base.zona_id, base.timestamp_forecast, wave_height_m, wind_speed_ms, air_temperature_c, precipitation_mm,
             cloud_cover_pct, visibility_km, stormglass_n_puntos, stormglass_run_ts, altura_marea_m, tipo_proximo_cambio,
             marea_n_puntos, marea_run_ts, temperatura_mar_c, salinidad_psu, corriente_u_ms, corriente_v_ms,
             copernicus_n_grillas, copernicus_run_ts, TIMESTAMP '{as_of}' AS updated_at
      FROM base
      LEFT JOIN w ON w.zona_id = base.zona_id AND w.timestamp_forecast = base.timestamp_forecast
      LEFT JOIN m ON m.zona_id = base.zona_id AND m.timestamp_forecast = base.timestamp_forecast
      LEFT JOIN g ON g.zona_id = base.zona_id AND g.day = CAST(base.timestamp_forecast AS DATE)),
    gold AS (
      SELECT * EXCLUDE (rain), {rounded("rain", 1)} AS precipitation_3h_mm
      FROM (SELECT *, coalesce(precipitation_mm, 0) + coalesce(lead(precipitation_mm, 1) OVER z, 0)
                      + coalesce(lead(precipitation_mm, 2) OVER z, 0) AS rain
            FROM joined WINDOW z AS (PARTITION BY zona_id ORDER BY timestamp_forecast)))"""


GOLD = gold_sql("week", AS_OF, 72, 2, 3)
GOLD_MONTH = gold_sql("month", MONTH_START, MONTH_HOURS, None, None)


def _gold(t):
    return gold_zone_hour(weather(t, "week"), tide(t, "week"), grid(t), AS_OF, 72, 2, 3)


def _gold_month(t):
    return gold_zone_hour(weather(t, "month"), tide(t, "month"), grid(t), MONTH_START, MONTH_HOURS, None, None)


@query("gold_zone_hour", f"WITH {GOLD} SELECT * FROM gold")
def gold_zone_hour_query(t):
    return _gold(t)


RISK = """coalesce(wave_height_m, 0) * 10.0 + coalesce(wind_speed_kts, 0) + coalesce(corriente_speed_ms, 0) * 5.0
          + CASE WHEN coalesce(visibility_km, 100) < 2 THEN 20.0 ELSE 0.0 END"""
LEVEL = """CASE WHEN coalesce(wave_height_m, 0) >= 2.5 OR coalesce(wind_speed_kts, 0) >= 25
                OR coalesce(visibility_km, 100) < 1 OR risk_score >= 40 THEN 'PELIGRO'
           WHEN risk_score >= 20 THEN 'PRECAUCION' ELSE 'SEGURO' END"""


@query(
    "gold_current",
    f"""
    WITH {GOLD},
    p AS (
      SELECT *, wind_speed_ms * 1.94384::DOUBLE AS wind_speed_kts,
             sqrt(corriente_u_ms * corriente_u_ms + corriente_v_ms * corriente_v_ms) AS corriente_speed_ms
      FROM gold WHERE timestamp_forecast >= TIMESTAMP '{NOW}' AND timestamp_forecast < TIMESTAMP '{NOW}' + INTERVAL 3 HOUR
      QUALIFY row_number() OVER (PARTITION BY zona_id ORDER BY timestamp_forecast) = 1),
    s AS (SELECT *, {RISK} AS risk_score FROM p)
    SELECT zona_id, timestamp_forecast AS timestamp_forecast_actual, wave_height_m, wind_speed_ms, wind_speed_kts,
           precipitation_mm, cloud_cover_pct, visibility_km, altura_marea_m, tipo_proximo_cambio, temperatura_mar_c,
           salinidad_psu, corriente_u_ms, corriente_v_ms, corriente_speed_ms, risk_score, {LEVEL} AS safety_level,
           CASE WHEN wave_height_m >= 2.5 THEN 'Oleaje alto' WHEN wind_speed_kts >= 25 THEN 'Viento fuerte'
                WHEN risk_score >= 40 THEN 'Condiciones riesgosas' WHEN risk_score >= 20 THEN 'Precaucion recomendada'
           END AS alerta_texto,
           updated_at AS source_updated_at, TIMESTAMP '{NOW}' AS updated_at, 630 AS minutes_since_update
    FROM s
    """,
)
def gold_current_query(t):
    return gold_current(_gold(t), NOW)


@query(
    "serving_forecast",
    f"""
    WITH {GOLD},
    p AS (SELECT *, wind_speed_ms * 1.94384::DOUBLE AS wind_speed_kts,
                 sqrt(corriente_u_ms * corriente_u_ms + corriente_v_ms * corriente_v_ms) AS corriente_speed_ms
          FROM gold WHERE timestamp_forecast >= TIMESTAMP '{NOW}' AND timestamp_forecast < TIMESTAMP '{NOW}' + INTERVAL 24 HOUR),
    s AS (SELECT *, {RISK} AS risk_score FROM p)
    SELECT zona_id, timestamp_forecast, wave_height_m, wind_speed_kts, precipitation_3h_mm, visibility_km,
           altura_marea_m, risk_score, {LEVEL} AS safety_level
    FROM s
    """,
)
def serving_forecast(t):
    return forecast_view(_gold(t), NOW, 24)


@query(
    "serving_favourable",
    f"""
    WITH {GOLD_MONTH},
    p AS (SELECT *, wind_speed_ms * 1.94384::DOUBLE AS wind_speed_kts,
                 sqrt(corriente_u_ms * corriente_u_ms + corriente_v_ms * corriente_v_ms) AS corriente_speed_ms
          FROM gold),
    s AS (SELECT *, {RISK} AS risk_score FROM p),
    l AS (SELECT *, {LEVEL} AS safety_level FROM s)
    SELECT zona_id, timestamp_forecast, wave_height_m, wind_speed_kts, precipitation_3h_mm, visibility_km,
           altura_marea_m, risk_score, safety_level
    FROM l WHERE safety_level = 'SEGURO'
    """,
)
def serving_favourable(t):
    return favourable_view(_gold_month(t), MONTH_START, MONTH_HOURS)


# Metrics at a fixed resolution, so that trailing sums are exact in any order of addition.
RESOLUTION = {"wave_height_m": 64, "wind_speed_ms": 4, "precipitation_mm": 1}


@query(
    "features_ml",
    f"""
    WITH {GOLD_MONTH},
    p AS (SELECT *, wind_speed_ms * 1.94384::DOUBLE AS wind_speed_kts,
                 sqrt(coalesce(corriente_u_ms, 0) * coalesce(corriente_u_ms, 0)
                      + coalesce(corriente_v_ms, 0) * coalesce(corriente_v_ms, 0)) AS corriente_speed_ms
          FROM (SELECT * REPLACE (floor(wave_height_m * 64) / 64 AS wave_height_m, floor(wind_speed_ms * 4) / 4 AS wind_speed_ms,
                                  floor(precipitation_mm) AS precipitation_mm) FROM gold)),
    s AS (SELECT *, {RISK} AS risk_score FROM p)
    SELECT zona_id, timestamp_forecast, risk_score,
           CASE WHEN coalesce(visibility_km, 100) < 1 THEN 'PELIGRO' WHEN risk_score < 20 THEN 'SEGURO'
                WHEN risk_score < 40 THEN 'PRECAUCION' ELSE 'PELIGRO' END AS safety_level,
           wave_height_m, wind_speed_ms, air_temperature_c, precipitation_mm, precipitation_3h_mm, visibility_km,
           altura_marea_m, temperatura_mar_c, salinidad_psu, corriente_speed_ms,
           avg(wave_height_m) OVER d AS wave_height_mean_24h, max(wave_height_m) OVER d AS wave_height_max_24h,
           round(stddev_samp(wave_height_m) OVER d, 9) AS wave_height_std_24h,
           avg(wind_speed_ms) OVER d AS wind_speed_mean_24h, max(wind_speed_ms) OVER d AS wind_speed_max_24h,
           sum(precipitation_mm) OVER d AS precipitation_sum_24h,
           max(wave_height_m) OVER q AS wave_height_max_6h, max(wind_speed_ms) OVER q AS wind_speed_max_6h,
           lag(wave_height_m, 1) OVER z AS wave_height_lag_1h, lag(wave_height_m, 3) OVER z AS wave_height_lag_3h,
           lag(wave_height_m, 6) OVER z AS wave_height_lag_6h, lag(wave_height_m, 12) OVER z AS wave_height_lag_12h,
           lag(wind_speed_ms, 1) OVER z AS wind_speed_lag_1h, lag(wind_speed_ms, 3) OVER z AS wind_speed_lag_3h,
           wave_height_m - lag(wave_height_m, 3) OVER z AS wave_height_delta_3h,
           wind_speed_ms - lag(wind_speed_ms, 3) OVER z AS wind_speed_delta_3h,
           wave_height_m * wind_speed_ms AS wave_wind_interaction,
           wave_height_m * corriente_speed_ms AS wave_current_interaction,
           CAST(hour(timestamp_forecast) AS INTEGER) AS hour_of_day,
           CAST(dayofweek(timestamp_forecast) + 1 AS INTEGER) AS day_of_week, dayofweek(timestamp_forecast) IN (0, 6) AS is_weekend
    FROM s
    WINDOW z AS (PARTITION BY zona_id ORDER BY timestamp_forecast),
           d AS (PARTITION BY zona_id ORDER BY timestamp_forecast RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW),
           q AS (PARTITION BY zona_id ORDER BY timestamp_forecast RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW)
    """,
)
def features_ml(t):
    coarse = {c: F.floor(F.col(c) * n) / F.lit(float(n)) for c, n in RESOLUTION.items()}
    rows = features(_gold_month(t).withColumns(coarse))
    return rows.withColumn("wave_height_std_24h", F.round("wave_height_std_24h", 9))


def _guesses(t):
    """Line prices with a simple guess from the quantity, split by ship date."""
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_shipdate",
        F.round("l_extendedprice").alias("actual"), (F.col("l_quantity") * 1500).alias("guess"),
    )


@query(
    "regression_metrics",
    """
    WITH p AS (SELECT year(l_shipdate)::INTEGER AS yr, round(l_extendedprice) AS actual, l_quantity * 1500 AS guess FROM lineitem)
    SELECT yr, count(*) AS n, round(sqrt(avg((guess - actual) * (guess - actual))), 4) AS rmse,
           round(avg(abs(guess - actual)), 4) AS mae,
           round(1 - sum((guess - actual) * (guess - actual)) / (var_pop(actual) * count(*)), 8) AS r2
    FROM p GROUP BY yr
    """,
)
def regression_metrics(t):
    figures = evaluate(_guesses(t).withColumn("yr", F.year("l_shipdate")), "actual", "guess", ["yr"])
    return figures.withColumns({"rmse": F.round("rmse", 4), "mae": F.round("mae", 4), "r2": F.round("r2", 8)})


@query(
    "error_table",
    """
    SELECT l_orderkey, l_linenumber, round(l_extendedprice) AS risk_score_real, l_quantity * 1500 AS risk_score_pred,
           l_quantity * 1500 - round(l_extendedprice) AS error, abs(l_quantity * 1500 - round(l_extendedprice)) AS abs_error
    FROM lineitem
    """,
)
def error_table_query(t):
    return error_table(_guesses(t), ["l_orderkey", "l_linenumber"], "actual", "guess")


@query(
    "temporal_split",
    """
    WITH r AS (SELECT o_orderdate, row_number() OVER (ORDER BY o_orderdate) - 1 AS i, count(*) OVER () AS n FROM orders),
    cut AS (SELECT min(o_orderdate) AS cut_ts FROM r WHERE i = CAST(floor(n * 0.8::DOUBLE) AS BIGINT))
    SELECT CASE WHEN o_orderdate < (SELECT cut_ts FROM cut) THEN 'train' ELSE 'test' END AS side, count(*) AS n,
           min(o_orderdate) AS first_ts, max(o_orderdate) AS last_ts
    FROM orders GROUP BY 1
    """,
)
def temporal_split_query(t):
    earlier, later = temporal_split(t.orders, "o_orderdate", 0.8)

    def figures(side, rows):
        return rows.agg(
            F.lit(side).alias("side"), F.count(F.lit(1)).alias("n"),
            F.min("o_orderdate").alias("first_ts"), F.max("o_orderdate").alias("last_ts"),
        )

    return figures("train", earlier).unionByName(figures("test", later))


@query(
    "serving_current",
    f"""
    WITH {GOLD},
    p AS (
      SELECT *, wind_speed_ms * 1.94384::DOUBLE AS wind_speed_kts,
             sqrt(corriente_u_ms * corriente_u_ms + corriente_v_ms * corriente_v_ms) AS corriente_speed_ms
      FROM gold WHERE timestamp_forecast >= TIMESTAMP '{NOW}' AND timestamp_forecast < TIMESTAMP '{NOW}' + INTERVAL 3 HOUR
      QUALIFY row_number() OVER (PARTITION BY zona_id ORDER BY timestamp_forecast) = 1),
    s AS (SELECT *, {RISK} AS risk_score FROM p)
    SELECT zona_id, timestamp_forecast AS timestamp_forecast_actual, risk_score, {LEVEL} AS safety_level,
           CASE WHEN wave_height_m >= 2.5 THEN 'Oleaje alto' WHEN wind_speed_kts >= 25 THEN 'Viento fuerte'
                WHEN risk_score >= 40 THEN 'Condiciones riesgosas' WHEN risk_score >= 20 THEN 'Precaucion recomendada'
           END AS alerta_texto,
           wave_height_m, wind_speed_kts, visibility_km, altura_marea_m, 630 AS minutes_since_update
    FROM s
    """,
)
def serving_current(t):
    return current_view(gold_current(_gold(t), NOW))
