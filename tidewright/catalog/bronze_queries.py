"""Bronze tables from the given tables."""

from pyspark.sql import functions as F

from tidewright.catalog.registry import query
from tidewright.catalog.standins import AS_OF, LANDED, TURN_WORDS, landed, weather_replies
from tidewright.plans.bronze import bronze_grid, bronze_grid_history, landed_audit
from tidewright.sources import classify_variant, with_bbox
from tidewright.sources.bronze import current_snapshot

# One download per kind: each has part of the values, and land cells have none.
DOWNLOADS = {
    "temperatura": {"thetao": "CASE WHEN l_quantity >= 5 THEN l_quantity / 2 END"},
    "salinidad": {"so": "CASE WHEN l_quantity >= 10 THEN l_quantity / 4 END"},
    "corrientes": {
        "uo": "CASE WHEN l_quantity >= 20 THEN l_quantity / 8 END",
        "vo": "CASE WHEN l_quantity >= 15 THEN l_quantity / 16 END",
    },
}


def _cells(t, kind: str):
    own = [f"CAST({text} AS DOUBLE) AS {name}" for name, text in DOWNLOADS[kind].items()]
    return t.lineitem.selectExpr(
        "CAST(l_shipdate AS TIMESTAMP) AS time", "CAST(l_linenumber AS DOUBLE) AS depth",
        "CAST(l_partkey % 75 AS DOUBLE) AS latitude", "CAST(l_suppkey % 25 AS DOUBLE) AS longitude", *own,
    )


def _zones(t):
    centres = t.nation.selectExpr(
        "CAST(n_nationkey AS STRING) AS zona_id", "n_name AS nombre_zona",
        "CAST(n_nationkey * 3 AS DOUBLE) AS lat", "CAST(n_regionkey * 5 AS DOUBLE) AS lon",
    )
    return with_bbox(centres, 1.75, None, "zona_id", "lat", "lon")


def _grid_sql(last: str) -> str:
    def part(kind: str) -> str:
        own = DOWNLOADS[kind]
        values = ", ".join(f"CAST({own.get(c, 'NULL')} AS DOUBLE) AS {c}" for c in ("thetao", "so", "uo", "vo"))
        wet = " OR ".join(f"({text}) IS NOT NULL" for text in own.values())
        return f"""SELECT time, depth, latitude, longitude, {values}, zona_id, nombre_zona, '{kind}' AS tipo_dato, {last}
        FROM placed WHERE depth = surface AND ({wet})"""

    return f"""
    WITH placed AS (
      SELECT CAST(l_shipdate AS TIMESTAMP) AS time, CAST(l_linenumber AS DOUBLE) AS depth,
             CAST(l_partkey % 75 AS DOUBLE) AS latitude, CAST(l_suppkey % 25 AS DOUBLE) AS longitude, l_quantity,
             CAST(n_nationkey AS VARCHAR) AS zona_id, n_name AS nombre_zona,
             min(CAST(l_linenumber AS DOUBLE)) OVER (PARTITION BY n_nationkey) AS surface
      FROM lineitem JOIN nation
        ON l_partkey % 75 BETWEEN n_nationkey * 3 - 1.75 AND n_nationkey * 3 + 1.75
       AND l_suppkey % 25 BETWEEN n_regionkey * 5 - 1.75 AND n_regionkey * 5 + 1.75)
    {" UNION ALL ".join(part(kind) for kind in DOWNLOADS)}
    """


@query("bronze_grid", _grid_sql(f"TIMESTAMP '{AS_OF}' AS timestamp_ingesta"))
def bronze_grid_query(t):
    return bronze_grid({kind: _cells(t, kind) for kind in DOWNLOADS}, _zones(t), AS_OF, 2.0)


@query("bronze_grid_history", _grid_sql("strftime(time, '%Y-%m') AS year_month"))
def bronze_grid_history_query(t):
    return bronze_grid_history({kind: _cells(t, kind) for kind in DOWNLOADS}, _zones(t), 2.0)


@query(
    "landed_audit",
    f"""
    WITH {LANDED}
    SELECT source, variante, path, epoch_ms(written_utc) AS "modTimeMs", written_utc, written_pty,
           CAST(written_pty AS DATE) AS dia_pty, strftime(written_pty, '%H') AS hora_pty,
           strftime(written_pty, '%Y-%m-%d %H:%M:%S') AS written_pty_str,
           strftime(written_utc, '%Y-%m-%d %H:%M:%S') AS written_utc_str, TIMESTAMP '{AS_OF}' AS captured_at
    FROM landed WHERE CAST(written_pty AS DATE) >= CAST(TIMESTAMP '{AS_OF}' - INTERVAL 5 HOUR AS DATE) - 2
    """,
)
def landed_audit_query(t):
    return landed_audit(classify_variant(landed(t)), AS_OF)


SNAPSHOT = {"waveHeight": 1, "windSpeed": 2, "airTemperature": 3, "precipitation": 4, "cloudCover": 5, "visibility": 6}


@query(
    "current_snapshot",
    f"""
    WITH {TURN_WORDS}
    SELECT punto_id, zona_id, '2024-01-01T00:00:00' AS moment, NULL::DOUBLE AS "windDirection", """
    + ", ".join(f'h * {n} AS "{name}"' for name, n in SNAPSHOT.items())
    + " FROM words WHERE i = 0",
)
def current_snapshot_query(t):
    """The first hour of every reply; a field that the feed lacks is NULL."""
    now = current_snapshot(weather_replies(t))
    fields = [F.col(f"datos_actuales.{name}").alias(name) for name in ("windDirection", *SNAPSHOT)]
    return now.select("punto_id", "zona_id", F.col("datos_actuales.timestamp").alias("moment"), *fields)
