"""The given tables in the roles of the feeds, in Spark and as SQL text.

``events`` plays readings (zone = event type, point = user), ``conversations`` plays replies with
arrays (a turn is a point, its words are moments), ``lineitem`` plays grid cells. Measures are multiples of powers of two, so sums
are exact and do not depend on the order in which rows are added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.catalog.registry import Tables
from tidewright.functions.scalars import json_field, truncate

AS_OF = "2024-01-29 00:00:00"
NOW = "2024-01-29 10:30:00"
MONTH_START = "2024-01-01 00:00:00"
MONTH_HOURS = 24 * 31


def readings(t: Tables) -> DataFrame:
    """Events with their JSON number ``k`` and whole measures."""
    return t.events.select(
        "event_id", "ts", "user_id", "event_type", "value",
        json_field("props", "k int", "k").alias("k"),
        F.floor("value").cast("double").alias("whole"),
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
    )


READINGS = """readings AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         floor(value) AS whole,
         CAST(round(value * 100) AS BIGINT) AS cents
  FROM events)"""


def weather(t: Tables, run: str) -> DataFrame:
    """Weather fact: one row per event; runs start at each ``run`` unit (week or month)."""
    r = readings(t)
    return r.select(
        F.col("event_type").alias("zona_id"),
        F.col("user_id").cast("string").alias("punto_id"),
        truncate(r, "ts", "hour").alias("timestamp_forecast"),
        truncate(r, "ts", run).alias("run_ts"),
        (F.col("whole") / 64).alias("wave_height_m"),
        (F.col("k") / 4).alias("wind_speed_ms"),
        (F.minute("ts") / 2).alias("air_temperature_c"),
        F.second("ts").cast("double").alias("precipitation_mm"),
        F.when(F.col("value") >= 20, F.col("k").cast("double")).alias("cloud_cover_pct"),
        (F.minute("ts") / 8).alias("visibility_km"),
    )


def weather_sql(run: str) -> str:
    return f"""weather AS (
  SELECT event_type AS zona_id, CAST(user_id AS VARCHAR) AS punto_id,
         date_trunc('hour', ts) AS timestamp_forecast, CAST(date_trunc('{run}', ts) AS TIMESTAMP) AS run_ts,
         whole / 64.0 AS wave_height_m, k / 4.0 AS wind_speed_ms,
         minute(ts) / 2.0 AS air_temperature_c, CAST(second(ts) AS DOUBLE) AS precipitation_mm,
         CASE WHEN value >= 20 THEN CAST(k AS DOUBLE) END AS cloud_cover_pct,
         minute(ts) / 8.0 AS visibility_km
  FROM readings)"""


def tide(t: Tables, run: str) -> DataFrame:
    """Tide fact at raw times, some rows without a next extreme."""
    r = readings(t)
    return r.select(
        F.col("event_type").alias("zona_id"),
        F.col("user_id").cast("string").alias("punto_id"),
        F.col("ts").alias("timestamp_forecast"),
        truncate(r, "ts", run).alias("run_ts"),
        (F.col("whole") / 64).alias("altura_marea_m"),
        F.when(F.col("k") >= 66, "HIGH").when(F.col("k") < 33, "LOW").alias("tipo_proximo_cambio"),
    )


def tide_sql(run: str) -> str:
    return f"""tide AS (
  SELECT event_type AS zona_id, CAST(user_id AS VARCHAR) AS punto_id, ts AS timestamp_forecast,
         CAST(date_trunc('{run}', ts) AS TIMESTAMP) AS run_ts, whole / 64.0 AS altura_marea_m,
         CASE WHEN k >= 66 THEN 'HIGH' WHEN k < 33 THEN 'LOW' END AS tipo_proximo_cambio
  FROM readings)"""


def grid(t: Tables) -> DataFrame:
    """Grid fact: daily values with hourly runs, one current component missing now and then."""
    r = readings(t)
    return r.select(
        F.col("event_type").alias("zona_id"),
        truncate(r, "ts", "day").alias("timestamp_forecast"),
        truncate(r, "ts", "hour").alias("run_ts"),
        (F.col("whole") / 16).alias("temperatura_mar_c"),
        (F.col("k") / 2).alias("salinidad_psu"),
        (F.minute("ts") / 64).alias("corriente_u_ms"),
        F.when(F.col("value") >= 20, F.second("ts") / 64).alias("corriente_v_ms"),
    )


GRID = """grid AS (
  SELECT event_type AS zona_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS timestamp_forecast,
         date_trunc('hour', ts) AS run_ts, whole / 16.0 AS temperatura_mar_c, k / 2.0 AS salinidad_psu,
         minute(ts) / 64.0 AS corriente_u_ms,
         CASE WHEN value >= 20 THEN second(ts) / 64.0 END AS corriente_v_ms
  FROM readings)"""


def zone_hours(t: Tables) -> DataFrame:
    """A series per zone at the hour grain: event count, total and largest measure."""
    r = readings(t)
    return r.groupBy("event_type", truncate(r, "ts", "hour").alias("hour")).agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.sum("cents").cast("double").alias("total"),
        F.max("cents").cast("double").alias("peak"),
    )


ZONE_HOURS = f"""{READINGS}, zone_hours AS (
  SELECT event_type, date_trunc('hour', ts) AS hour, CAST(count(*) AS DOUBLE) AS n,
         CAST(sum(cents) AS DOUBLE) AS total, CAST(max(cents) AS DOUBLE) AS peak
  FROM readings GROUP BY ALL)"""


def scored(t: Tables) -> DataFrame:
    """Events as single readings with wave, wind, current and visibility, some of them missing."""
    return readings(t).select(
        "event_id", "event_type", "ts",
        F.when(F.col("value") >= 5, F.col("whole") / 64).alias("wave"),
        F.when(F.col("k") >= 3, F.col("k") / 4).alias("wind_ms"),
        (F.minute("ts") / 16).alias("u"),
        F.when(F.col("k") < 90, F.second("ts") / 16).alias("v"),
        F.when(F.col("k") < 95, F.minute("ts") / 8).alias("vis"),
    )


SCORED = f"""{READINGS}, scored AS (
  SELECT event_id, event_type, ts,
         CASE WHEN value >= 5 THEN whole / 64.0 END AS wave,
         CASE WHEN k >= 3 THEN k / 4.0 END AS wind_ms,
         minute(ts) / 16.0 AS u,
         CASE WHEN k < 90 THEN second(ts) / 16.0 END AS v,
         CASE WHEN k < 95 THEN minute(ts) / 8.0 END AS vis
  FROM readings),
risked AS (
  SELECT *, wind_ms * 1.94384::DOUBLE AS wind, sqrt(u * u + v * v) AS cur,
         coalesce(wave, 0) * 10.0 + coalesce(wind_ms * 1.94384::DOUBLE, 0) + coalesce(sqrt(u * u + v * v), 0) * 5.0
         + CASE WHEN coalesce(vis, 100) < 2 THEN 20.0 ELSE 0.0 END AS score
  FROM scored)"""


def tide_replies(t: Tables) -> DataFrame:
    """Conversation turns as tide replies: each word is a moment, its length the height; long and short words are extremes."""
    words = F.split("text", " ")

    def state(height):
        return F.when(height >= 9, "HIGH TIDE").when(height <= 2, "LOW_TIDE").otherwise("SLACK")

    def moment(word, i):
        at = F.lit(1704067200) + i.cast("bigint") * 600
        height = F.length(word).cast("double")
        return F.struct(
            at.alias("timestamp"),
            F.date_format(F.timestamp_seconds(at), "yyyy-MM-dd'T'HH:mm:ss").alias("datetime"),
            height.alias("height"),
            state(height).alias("state"),
        )

    moments = F.transform(words, moment)
    return t.conversations.select(
        F.concat_ws("-", "conv_id", "turn").alias("punto_id"),
        F.col("role").alias("zona_id"),
        F.lit("2024-01-01T00:00:00").alias("timestamp_ingesta"),
        F.struct(
            moments.alias("heights"),
            F.filter(moments, lambda m: (m["height"] >= 9) | (m["height"] <= 2)).alias("extremes"),
        ).alias("raw_data"),
    )


WORDS = """words AS (
  SELECT doc_id, lang, i - 1 AS i, w, CAST(length(w) AS DOUBLE) AS h
  FROM (SELECT doc_id, lang, unnest(string_split(text, ' ')) AS w,
               generate_subscripts(string_split(text, ' '), 1) AS i FROM documents))"""

TURN_WORDS = """words AS (
  SELECT punto_id, role AS zona_id, i - 1 AS i, CAST(length(w) AS DOUBLE) AS h
  FROM (SELECT conv_id || '-' || turn AS punto_id, role, unnest(string_split(text, ' ')) AS w,
               generate_subscripts(string_split(text, ' '), 1) AS i FROM conversations))"""


def rounded(value: str, digits: int) -> str:
    """SQL that rounds the shortest decimal form of a double half up, which is what Spark's ``round`` does."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


def weather_replies(t: Tables) -> DataFrame:
    """Conversation turns as weather replies: each word is an hour whose values come from its length and place."""
    names = {"waveHeight": 1, "windSpeed": 2, "airTemperature": 3, "precipitation": 4, "cloudCover": 5, "visibility": 6}

    def hour(word, i):
        at = F.timestamp_seconds(F.lit(1704067200) + i.cast("bigint") * 3600)
        size = F.length(word).cast("double")
        values = [
            F.struct((size * weight).alias("sg")).alias(name)
            for name, weight in names.items()
        ]
        return F.struct(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss").alias("time"), *values)

    return t.conversations.select(
        F.concat_ws("-", "conv_id", "turn").alias("punto_id"),
        F.col("role").alias("zona_id"),
        F.lit("2024-01-01T00:00:00").alias("timestamp_ingesta"),
        F.struct(F.transform(F.split("text", " "), hour).alias("hours")).alias("raw_data"),
    )


def landed(t: Tables) -> DataFrame:
    """Events as landed files: the path carries source, date and variant folder."""
    folder = F.when(F.col("value") < 20, "historico").when(F.col("value") < 50, "History").when(
        F.col("value") < 300, "forecast"
    ).otherwise("tmp")
    return t.events.select(
        F.col("event_type").alias("source"),
        F.concat(
            F.lit("/bronze/"), F.col("event_type"),
            F.date_format("ts", "'/year='yyyy'/month='MM'/'"), folder, F.date_format("ts", "'/day='dd'/'"),
            F.col("event_id").cast("string"), F.lit(".parquet"),
        ).alias("path"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("modTimeMs"),
        "value",
    )


LANDED = """landed AS (
  SELECT event_type AS source, value,
         '/bronze/' || event_type || strftime(ts, '/year=%Y/month=%m/')
           || CASE WHEN value < 20 THEN 'historico' WHEN value < 50 THEN 'History'
                   WHEN value < 300 THEN 'forecast' ELSE 'tmp' END
           || strftime(ts, '/day=%d/') || CAST(event_id AS VARCHAR) || '.parquet' AS path,
         CASE WHEN value < 50 THEN 'historico' WHEN value < 300 THEN 'forecast' ELSE 'desconocido' END AS variante,
         date_trunc('millisecond', ts) AS written_utc,
         date_trunc('millisecond', ts) - INTERVAL 5 HOUR AS written_pty
  FROM events)"""
