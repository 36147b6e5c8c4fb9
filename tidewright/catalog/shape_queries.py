"""Sources, row shaping, filters, scalar functions and risk formulae."""

from pyspark.sql import functions as F

from tidewright.catalog.registry import query
from tidewright.catalog.standins import (
    LANDED,
    READINGS,
    SCORED,
    TURN_WORDS,
    WORDS,
    ZONE_HOURS,
    landed,
    readings,
    rounded,
    scored,
    tide_replies,
    zone_hours,
)
from tidewright.functions import (
    alert_text,
    clip_round,
    json_field,
    knots,
    local_time,
    minutes_since,
    risk_score,
    run_context,
    safety_level,
    speed,
    star_rating,
    tide_kind,
    truncate,
)
from tidewright.operators.shape import (
    calendar,
    explode_rows,
    in_horizon,
    interactions,
    key_universe,
    latest_run,
    set_difference,
    since,
    split_valid,
    top_k,
)
from tidewright.schemas import flat
from tidewright.sources import clean_grid, conform_union, landing_times, latest_partition, tide_stats, with_bbox
from tidewright.sources.feeds import classify_variant


@query(
    "bbox_build",
    """
    WITH own AS (SELECT c_custkey, -1.5 AS lat_min, 2.5 AS lat_max FROM customer WHERE c_mktsegment = 'BUILDING')
    SELECT c.c_custkey,
           coalesce(own.lat_min, c_acctbal - 0.25) AS lat_min, coalesce(own.lat_max, c_acctbal + 0.25) AS lat_max,
           c_nationkey - 0.25 AS lon_min, c_nationkey + 0.25 AS lon_max
    FROM customer c LEFT JOIN own USING (c_custkey)
    """,
)
def bbox_build(t):
    zones = t.customer.select("c_custkey", "c_acctbal", F.col("c_nationkey").cast("double").alias("lon"))
    own = t.customer.where("c_mktsegment = 'BUILDING'").select(
        "c_custkey", F.lit(-1.5).alias("lat_min"), F.lit(2.5).alias("lat_max")
    )
    boxed = with_bbox(zones, 0.25, own, "c_custkey", "c_acctbal", "lon")
    return boxed.select("c_custkey", "lat_min", "lat_max", "lon_min", "lon_max")


@query(
    "array_stats",
    f"""
    WITH {TURN_WORDS}
    SELECT punto_id, min(h) AS altura_min_m, max(h) AS altura_max_m, {rounded("avg(h)", 2)} AS altura_prom_m,
           max(h) - min(h) AS rango_marea_m,
           count(*) FILTER (WHERE h >= 9) AS total_pleamares,
           count(*) FILTER (WHERE h <= 2) AS total_bajamares,
           max(h) FILTER (WHERE h >= 9) AS altura_maxima_pleamar_m,
           min(h) FILTER (WHERE h <= 2) AS altura_minima_bajamar_m
    FROM words GROUP BY punto_id
    """,
)
def array_stats(t):
    return tide_stats(tide_replies(t)).select("punto_id", "estadisticas.*")


@query(
    "run_context",
    """
    SELECT event_id, CASE hour(ts) WHEN 9 THEN 'MADRUGADA_CRITICA' WHEN 17 THEN 'MEDIODIA_SEGUIMIENTO'
                     WHEN 23 THEN 'NOCTURNA_PLANIFICACION' ELSE 'MANUAL_TESTING' END AS contexto
    FROM events
    """,
)
def run_context_query(t):
    return t.events.select("event_id", run_context("ts").alias("contexto"))


@query(
    "drop_all_null",
    f"""
    WITH {READINGS},
    cells AS (
      SELECT event_id, event_type, k // 10 AS depth,
             CASE WHEN value < 30 THEN whole END AS thetao, CASE WHEN minute(ts) < 20 THEN whole END AS so
      FROM readings),
    surface AS (SELECT event_type, min(depth) AS top FROM cells GROUP BY 1)
    SELECT event_id, event_type, depth, thetao, so FROM cells
    WHERE depth = (SELECT top FROM surface s WHERE s.event_type = cells.event_type)
      AND (thetao IS NOT NULL OR so IS NOT NULL)
    """,
)
def drop_all_null(t):
    cells = readings(t).select(
        "event_id", "event_type", F.floor(F.col("k") / 10).alias("depth"),
        F.when(F.col("value") < 30, F.col("whole")).alias("thetao"),
        F.when(F.minute("ts") < 20, F.col("whole")).alias("so"),
    )
    return clean_grid(cells, ["thetao", "so"], ["event_type"])


@query(
    "conform_union",
    """
    SELECT c_custkey AS id, c_name AS name, c_acctbal AS acctbal, c_mktsegment AS mktsegment,
           CAST(NULL AS DOUBLE) AS rating FROM customer
    UNION ALL
    SELECT s_suppkey, s_name, s_acctbal, NULL, NULL FROM supplier
    """,
)
def conform_union_query(t):
    schema = flat("id bigint, name string, acctbal double, mktsegment string, rating double")
    customers = t.customer.withColumnsRenamed(
        {"c_custkey": "id", "c_name": "name", "c_acctbal": "acctbal", "c_mktsegment": "mktsegment"}
    )
    suppliers = t.supplier.withColumnsRenamed({"s_suppkey": "id", "s_name": "name", "s_acctbal": "acctbal"})
    return conform_union([customers, suppliers], schema)


@query(
    "classify_variant",
    f"WITH {LANDED} SELECT path, variante FROM landed",
)
def classify_variant_query(t):
    return classify_variant(landed(t)).select("path", "variante")


@query(
    "latest_partition",
    f"""
    WITH {LANDED},
    dated AS (SELECT source, path, CAST(date_trunc('day', written_utc) AS DATE) AS path_date FROM landed)
    SELECT source, path, path_date FROM dated d
    WHERE path_date = (SELECT max(path_date) FROM dated m WHERE m.source = d.source)
    """,
)
def latest_partition_query(t):
    return latest_partition(landed(t)).select("source", "path", "path_date")


@query(
    "explode_rows",
    f"WITH {WORDS} SELECT doc_id, w AS word FROM words",
)
def explode_rows_query(t):
    split = t.documents.select("doc_id", F.split("text", " ").alias("words"))
    return explode_rows(split, "words", "word", ["doc_id"])


@query(
    "explode_outer_rows",
    f"""
    WITH {WORDS}
    SELECT d.doc_id, l.w AS word
    FROM documents d LEFT JOIN (SELECT doc_id, w FROM words WHERE h > 12) l ON l.doc_id = d.doc_id
    """,
)
def explode_outer_rows(t):
    long_words = F.filter(F.split("text", " "), lambda w: F.length(w) > 12)
    split = t.documents.select("doc_id", long_words.alias("words"))
    return explode_rows(split, "words", "word", ["doc_id"], outer=True)


@query(
    "map_kind",
    """
    SELECT event_id, CASE event_type WHEN 'purchase' THEN 'HIGH' WHEN 'signup' THEN 'HIGH'
                     WHEN 'view' THEN 'LOW' ELSE event_type END AS kind
    FROM events
    """,
)
def map_kind(t):
    state = (
        F.when(F.col("event_type") == "purchase", "HIGH TIDE")
        .when(F.col("event_type") == "signup", "HIGH_TIDE")
        .when(F.col("event_type") == "view", "low tide")
        .otherwise(F.col("event_type"))
    )
    return t.events.select("event_id", tide_kind(state).alias("kind"))


@query(
    "in_horizon",
    """
    SELECT event_id, ts FROM events
    WHERE ts >= TIMESTAMP '2024-01-15 06:00:00' AND ts < TIMESTAMP '2024-01-15 06:00:00' + INTERVAL 72 HOUR
    """,
)
def in_horizon_query(t):
    return in_horizon(t.events, "ts", "2024-01-15 06:00:00", 72).select("event_id", "ts")


@query(
    "since",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1999-12-22 00:00:00'",
)
def since_query(t):
    return since(t.orders, "o_orderdate", "2000-01-01 00:00:00", days=10).select("o_orderkey", "o_orderdate")


@query(
    "latest_run",
    """
    SELECT event_id, event_type, value FROM events
    WHERE date_trunc('day', ts) = (SELECT max(date_trunc('day', ts)) FROM events)
    """,
)
def latest_run_query(t):
    runs = t.events.withColumn("run_ts", truncate(t.events, "ts", "day"))
    return latest_run(runs).select("event_id", "event_type", "value")


RANGES = {"l_quantity": (5.0, 45.0), "l_extendedprice": (2000.0, 90000.0), "discount": (0.01, 0.09)}


def _with_gaps(t):
    return t.lineitem.withColumn("discount", F.when(F.col("l_tax") > 0.01, F.col("l_discount")))


@query(
    "range_filter",
    """
    WITH l AS (SELECT *, CASE WHEN l_tax > 0.01 THEN l_discount END AS discount FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, discount FROM l
    WHERE l_quantity BETWEEN 5 AND 45 AND l_extendedprice BETWEEN 2000 AND 90000
      AND (discount IS NULL OR discount BETWEEN 0.01::DOUBLE AND 0.09::DOUBLE)
    """,
)
def range_filter(t):
    valid, _ = split_valid(_with_gaps(t), RANGES)
    return valid.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "discount")


@query(
    "range_rejects",
    """
    WITH l AS (SELECT *, CASE WHEN l_tax > 0.01 THEN l_discount END AS discount FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, discount FROM l
    WHERE l_quantity < 5 OR l_quantity > 45 OR l_extendedprice < 2000 OR l_extendedprice > 90000
       OR discount < 0.01::DOUBLE OR discount > 0.09::DOUBLE
    """,
)
def range_rejects(t):
    _, bad = split_valid(_with_gaps(t), RANGES)
    return bad.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "discount")


@query(
    "top_k",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50",
)
def top_k_query(t):
    return top_k(
        t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), [F.col("o_totalprice").desc(), F.col("o_orderkey")], 50
    )


@query(
    "key_universe",
    """
    SELECT DISTINCT user_id, CAST(date_trunc('day', ts) AS DATE) AS day FROM events
    UNION SELECT o_custkey, CAST(o_orderdate AS DATE) FROM orders
    """,
)
def key_universe_query(t):
    events = t.events.select("user_id", F.to_date("ts").alias("day"))
    orders = t.orders.select(F.col("o_custkey").alias("user_id"), F.to_date("o_orderdate").alias("day"))
    return key_universe([events, orders], ["user_id", "day"])


@query(
    "set_difference",
    """
    SELECT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'error'
    EXCEPT
    SELECT user_id, CAST(ts AS DATE) FROM events WHERE event_type = 'click'
    """,
)
def set_difference_query(t):
    daily = t.events.select("event_type", "user_id", F.to_date("ts").alias("day"))

    def of(kind):
        return daily.where(F.col("event_type") == kind).select("user_id", "day")

    return set_difference(of("error"), of("click"))


@query(
    "interactions",
    """
    SELECT l_orderkey, l_linenumber, l_quantity * l_extendedprice AS qty_price, l_quantity * l_discount AS qty_discount
    FROM lineitem
    """,
)
def interactions_query(t):
    pairs = {"qty_price": ("l_quantity", "l_extendedprice"), "qty_discount": ("l_quantity", "l_discount")}
    return interactions(t.lineitem, pairs).select("l_orderkey", "l_linenumber", *pairs)


@query(
    "calendar_parts",
    """
    SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour_of_day, CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week,
           dayofweek(ts) IN (0, 6) AS is_weekend
    FROM events
    """,
)
def calendar_parts(t):
    return calendar(t.events, "ts").select("event_id", "hour_of_day", "day_of_week", "is_weekend")


@query(
    "current_speed_kn",
    f"""
    WITH {SCORED}
    SELECT event_id, sqrt(u * u + v * v) AS speed_ms, sqrt(u * u + v * v) * 1.94384::DOUBLE AS speed_kn,
           sqrt(u * u + coalesce(v, 0) * coalesce(v, 0)) AS speed_filled
    FROM scored
    """,
)
def current_speed_kn(t):
    return scored(t).select(
        "event_id",
        speed("u", "v").alias("speed_ms"),
        knots(speed("u", "v")).alias("speed_kn"),
        speed("u", "v", 0.0).alias("speed_filled"),
    )


def _risked(t):
    base = scored(t).withColumns({"wind": knots("wind_ms"), "cur": speed("u", "v")})
    return base.withColumn("score", risk_score("wave", "wind", "cur", "vis"))


@query(
    "risk_score",
    f"WITH {SCORED} SELECT event_id, score AS risk_score FROM risked",
)
def risk_score_query(t):
    return _risked(t).select("event_id", F.col("score").alias("risk_score"))


@query(
    "safety_level",
    f"""
    WITH {SCORED}
    SELECT event_id,
      CASE WHEN coalesce(wave, 0) >= 2.5 OR coalesce(wind, 0) >= 25 OR coalesce(vis, 100) < 1 THEN 'PELIGRO'
           WHEN score >= 40 THEN 'PELIGRO' WHEN score >= 20 THEN 'PRECAUCION' ELSE 'SEGURO' END AS level_current,
      CASE WHEN coalesce(vis, 100) < 1 THEN 'PELIGRO' WHEN score < 20 THEN 'SEGURO'
           WHEN score < 40 THEN 'PRECAUCION' ELSE 'PELIGRO' END AS level_features,
      CASE WHEN score < 20 THEN 'SEGURO' WHEN score < 40 THEN 'PRECAUCION' ELSE 'PELIGRO' END AS level_prediction
    FROM risked
    """,
)
def safety_level_query(t):
    return _risked(t).select(
        "event_id",
        safety_level("score", "wave", "wind", "vis").alias("level_current"),
        safety_level("score", visibility_km="vis", variant="features").alias("level_features"),
        safety_level("score", variant="prediction").alias("level_prediction"),
    )


@query(
    "alert_text",
    f"""
    WITH {SCORED}
    SELECT event_id,
      CASE WHEN wave >= 2.5 THEN 'Oleaje alto' WHEN wind >= 25 THEN 'Viento fuerte'
           WHEN score >= 40 THEN 'Condiciones riesgosas' WHEN score >= 20 THEN 'Precaucion recomendada' END AS alert
    FROM risked
    """,
)
def alert_text_query(t):
    return _risked(t).select("event_id", alert_text("score", "wave", "wind").alias("alert"))


@query(
    "minutes_since",
    """
    SELECT event_id, CAST(round((epoch(TIMESTAMP '2024-01-31 12:00:00') - floor(epoch(ts))) / 60.0, 0) AS INTEGER) AS minutes
    FROM events
    """,
)
def minutes_since_query(t):
    return t.events.select("event_id", minutes_since("ts", "2024-01-31 12:00:00").alias("minutes"))


@query(
    "star_rating",
    f"""
    WITH {READINGS}, m AS (SELECT event_id, CASE WHEN k < 90 THEN k / 32.0 END AS amplitude FROM readings)
    SELECT event_id, CASE WHEN amplitude >= 2 THEN 3 WHEN amplitude >= 0.5 THEN 2 ELSE 1 END AS stars FROM m
    """,
)
def star_rating_query(t):
    amplitude = F.when(F.col("k") < 90, F.col("k") / 32)
    return readings(t).select("event_id", star_rating(amplitude).alias("stars"))


@query(
    "local_time",
    f"WITH {LANDED} SELECT path, written_utc, written_pty, CAST(written_pty AS DATE) AS dia_pty, "
    "strftime(written_pty, '%H') AS hora_pty, strftime(written_pty, '%Y-%m-%d %H:%M:%S') AS written_pty_str FROM landed",
)
def local_time_query(t):
    return landing_times(landed(t)).select(
        "path", "written_utc", "written_pty", "dia_pty", "hora_pty", "written_pty_str"
    )


@query(
    "json_field",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
)
def json_field_query(t):
    return t.events.select("event_id", json_field("props", "k int", "k").alias("k"))


@query(
    "clip_round",
    f"WITH {READINGS} SELECT event_id, least(greatest(whole / 4.0 - 10, 0), 100) AS clipped FROM readings",
)
def clip_round_query(t):
    return readings(t).select("event_id", clip_round(F.col("whole") / 4 - 10, 0.0, 100.0, 2).alias("clipped"))


@query(
    "risk_levels_by_hour",
    f"""
    WITH {ZONE_HOURS}, s AS (
      SELECT *, peak / 4096.0 * 10.0 + n + 0 * 5.0 + 0 AS score FROM zone_hours)
    SELECT event_type, hour, score AS risk_score,
           CASE WHEN score >= 40 THEN 'PELIGRO' WHEN score >= 20 THEN 'PRECAUCION' ELSE 'SEGURO' END AS level
    FROM s
    """,
)
def risk_levels_by_hour(t):
    waves = zone_hours(t).withColumn("wave", F.col("peak") / 4096)
    score = risk_score("wave", "n", F.lit(None).cast("double"), F.lit(None).cast("double"))
    return waves.select("event_type", "hour", score.alias("risk_score")).withColumn(
        "level", safety_level("risk_score", variant="prediction")
    )


@query(
    "local_clock",
    "SELECT o_orderkey, o_orderdate - INTERVAL 5 HOUR AS local_ts FROM orders",
)
def local_clock(t):
    return t.orders.select("o_orderkey", local_time("o_orderdate").alias("local_ts"))
