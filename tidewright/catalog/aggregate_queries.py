"""Grouped figures."""

from pyspark.sql import functions as F

from tidewright.catalog.registry import query
from tidewright.catalog.standins import LANDED, READINGS, SCORED, TURN_WORDS, landed, readings, scored, tide_replies
from tidewright.functions import clip_round, knots, risk_score, safety_level, speed, truncate
from tidewright.operators.aggregates import (
    agg_grid,
    agg_tide_hour,
    agg_zone_hour,
    completeness,
    consolidate,
    count_if_by,
    coverage,
    coverage_pct,
    describe_cols,
    distribution,
    landing_daily,
    landing_latest,
    landing_matrix,
    mae_vs_baseline,
    quartiles,
    risk_by_zone,
    summary,
)
from tidewright.sources import landing_times
from tidewright.sources.feeds import classify_variant


@query(
    "zone_hour_weather",
    f"""
    WITH {READINGS}
    SELECT event_type, date_trunc('hour', ts) AS hour, avg(cents) AS cents, avg(whole) AS whole, avg(k) AS k,
           avg(minute(ts)) AS minute, avg(second(ts)) AS second, avg(event_id) AS event_id,
           count(DISTINCT user_id) AS n_points, max(ts) AS run_ts
    FROM readings GROUP BY ALL
    """,
)
def zone_hour_weather(t):
    rows = readings(t)
    rows = rows.withColumns({"hour": truncate(rows, "ts"), "minute": F.minute("ts"), "second": F.second("ts")})
    metrics = ["cents", "whole", "k", "minute", "second", "event_id"]
    return agg_zone_hour(rows, metrics, ["event_type", "hour"], "user_id", "ts", "n_points", "run_ts")


@query(
    "zone_hour_tide",
    f"""
    WITH {READINGS}, m AS (SELECT *, CASE WHEN k >= 66 THEN 'HIGH' WHEN k < 33 THEN 'LOW' END AS kind FROM readings)
    SELECT event_type, date_trunc('hour', ts) AS ts, avg(cents) AS cents,
           arg_min(kind, ts) FILTER (WHERE kind IS NOT NULL) AS kind, count(*) AS n_rows, max(user_id) AS run_ts
    FROM m GROUP BY event_type, date_trunc('hour', ts)
    """,
)
def zone_hour_tide(t):
    rows = readings(t).withColumn("kind", F.when(F.col("k") >= 66, "HIGH").when(F.col("k") < 33, "LOW"))
    return agg_tide_hour(rows, "event_type", "ts", "cents", "kind", "user_id", "n_rows", "run_ts")


@query(
    "grid_daily",
    """
    SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day, avg(l_quantity) AS l_quantity,
           avg(round(l_extendedprice * 100)) AS price, avg(round(l_discount * 100)) AS discount,
           avg(round(l_tax * 100)) AS tax, count(*) AS n_cells, max(l_orderkey) AS run_ts
    FROM lineitem GROUP BY ALL
    """,
)
def grid_daily(t):
    cells = t.lineitem.select(
        "l_suppkey", F.to_date("l_shipdate").alias("day"), "l_quantity", "l_orderkey",
        F.round(F.col("l_extendedprice") * 100).alias("price"),
        F.round(F.col("l_discount") * 100).alias("discount"),
        F.round(F.col("l_tax") * 100).alias("tax"),
    )
    values = ["l_quantity", "price", "discount", "tax"]
    return agg_grid(cells, ["l_suppkey", "day"], values, "l_orderkey", "n_cells", "run_ts")


@query(
    "consolidate_sparse",
    f"""
    WITH {READINGS}
    SELECT user_id, CAST(ts AS DATE) AS day,
           max(value) FILTER (WHERE event_type IN ('view', 'click')) AS thetao,
           max(value) FILTER (WHERE event_type = 'error') AS so,
           max(value) FILTER (WHERE event_type = 'purchase') AS uo
    FROM readings GROUP BY ALL
    """,
)
def consolidate_sparse(t):
    cells = t.events.select(
        "user_id", F.to_date("ts").alias("day"),
        F.when(F.col("event_type").isin("view", "click"), F.col("value")).alias("a"),
        F.when(F.col("event_type") == "error", F.col("value")).alias("b"),
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("c"),
    )
    return consolidate(cells, ["user_id", "day"], {"a": "thetao", "b": "so", "c": "uo"})


@query(
    "coverage",
    """
    SELECT user_id, min(ts) AS min_ts, max(ts) AS max_ts, count(*) AS n_points,
           (floor(epoch(max(ts))) - floor(epoch(min(ts)))) / 3600.0 AS range_hours
    FROM events GROUP BY user_id
    """,
)
def coverage_query(t):
    return coverage(t.events, ["user_id"], "ts")


@query(
    "table_summary",
    """
    SELECT 'events' AS table_name, count(*) AS n_rows, count(DISTINCT event_type) AS n_zones,
           count(DISTINCT user_id) AS n_points, min(ts) AS min_ts, max(ts) AS max_ts,
           min(ts) AS min_run, max(ts) AS max_run FROM events
    UNION ALL
    SELECT 'orders', count(*), count(DISTINCT o_orderpriority), count(DISTINCT o_custkey),
           min(o_orderdate), max(o_orderdate), min(o_orderdate), max(o_orderdate) FROM orders
    """,
)
def table_summary(t):
    return summary(
        {
            "events": (t.events, {"zone": "event_type", "point": "user_id", "ts": "ts", "run": "ts"}),
            "orders": (
                t.orders,
                {"zone": "o_orderpriority", "point": "o_custkey", "ts": "o_orderdate", "run": "o_orderdate"},
            ),
        }
    )


@query(
    "completeness",
    """
    SELECT event_type, count(*) AS total, count(*) FILTER (WHERE value >= 20) AS with_a,
           count(*) FILTER (WHERE value < 60) AS with_b
    FROM events GROUP BY event_type
    """,
)
def completeness_query(t):
    gaps = t.events.withColumns(
        {"a": F.when(F.col("value") >= 20, F.col("value")), "b": F.when(F.col("value") < 60, F.col("value"))}
    )
    return completeness(gaps, ["a", "b"], ["event_type"])


@query(
    "coverage_pct",
    """
    SELECT CAST(ts AS DATE) AS fecha, CAST(hour(ts) AS INTEGER) AS hora_utc, count(*) AS total_rows,
           count(*) FILTER (WHERE value >= 20) AS rows_with_value,
           round(count(*) FILTER (WHERE value >= 20) * 100.0::DOUBLE / count(*), 1) AS pct_with_value
    FROM events GROUP BY ALL
    """,
)
def coverage_pct_query(t):
    gaps = t.events.withColumn("a", F.when(F.col("value") >= 20, F.col("value")))
    return coverage_pct(gaps, "a", "ts")


@query(
    "risk_by_zone",
    f"""
    WITH {READINGS}, p AS (
      SELECT event_type AS zona_id, CAST(ts AS DATE) AS prediction_ts,
             least(greatest(whole / 4.0, 0), 100) AS s FROM readings)
    SELECT zona_id, count(*) AS hours_predicted, round(avg(s), 2) AS avg_risk_pred, min(s) AS min_risk_pred,
           max(s) AS max_risk_pred, count(*) FILTER (WHERE s >= 40) AS hours_danger,
           count(*) FILTER (WHERE s >= 20 AND s < 40) AS hours_caution, count(*) FILTER (WHERE s < 20) AS hours_safe
    FROM p WHERE prediction_ts = (SELECT max(prediction_ts) FROM p) GROUP BY zona_id
    """,
)
def risk_by_zone_query(t):
    pred = readings(t).select(
        F.col("event_type").alias("zona_id"),
        F.to_date("ts").alias("prediction_ts"),
        clip_round(F.col("whole") / 4).alias("risk_score_pred"),
    )
    return risk_by_zone(pred.withColumn("safety_level_pred", safety_level("risk_score_pred", variant="prediction")))


@query(
    "level_distribution",
    f"""
    WITH {SCORED}
    SELECT CASE WHEN score < 20 THEN 'SEGURO' WHEN score < 40 THEN 'PRECAUCION' ELSE 'PELIGRO' END AS level,
           count(*) AS n, round(avg(score), 2) AS avg_score, round(min(score), 2) AS min_score,
           round(max(score), 2) AS max_score
    FROM risked GROUP BY 1
    """,
)
def level_distribution(t):
    rows = scored(t).withColumn("score", risk_score("wave", knots("wind_ms"), speed("u", "v"), "vis"))
    return distribution(rows.withColumn("level", safety_level("score", variant="prediction")), ["level"], "score")


@query(
    "column_stats",
    f"""
    WITH {READINGS}
    SELECT count(*) AS n, avg(cents) AS cents_mean, round(stddev_samp(cents), 4) AS cents_std, min(cents) AS cents_min,
           max(cents) AS cents_max, avg(k) AS k_mean, round(stddev_samp(k), 4) AS k_std, min(k) AS k_min, max(k) AS k_max,
           CAST(date_diff('day', min(ts), max(ts)) AS INTEGER) AS days_covered,
           (floor(epoch(max(ts))) - floor(epoch(min(ts)))) / 3600.0 AS horizon_hours
    FROM readings
    """,
)
def column_stats(t):
    stats = describe_cols(readings(t), ["cents", "k"], "ts", "ts")
    return stats.withColumns({c: F.round(c, 4) for c in ("cents_std", "k_std")})


MEASURED = {
    "price": "CAST(round(l_extendedprice * 100) AS BIGINT)",
    "part": "l_partkey",
    "supplier": "l_suppkey",
    "day": "CAST(date_diff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE)) AS BIGINT)",
}


@query(
    "column_quartiles",
    " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, {share}::DOUBLE AS share, CAST(quantile_cont({value}, {share}) AS DOUBLE) AS value FROM lineitem"
        for name, value in MEASURED.items()
        for share in (0.25, 0.5, 0.75)
    ),
)
def column_quartiles(t):
    measured = t.lineitem.select(
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("price"), F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supplier"), F.datediff("l_shipdate", F.lit("1990-01-01").cast("date")).cast("bigint").alias("day"),
    )
    return quartiles(measured, list(MEASURED))


@query(
    "count_if",
    """
    SELECT c_nationkey, count(*) AS n, sum(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END)::BIGINT AS n_match
    FROM customer WHERE c_acctbal > 0 GROUP BY c_nationkey
    """,
)
def count_if(t):
    return count_if_by(t.customer.where("c_acctbal > 0"), ["c_nationkey"], F.col("c_mktsegment") == "BUILDING")


HOURS = [f"{h:02d}" for h in range(24)]


@query(
    "pivot_hours",
    "SELECT event_type, CAST(ts AS DATE) AS day, "
    + ", ".join(f"count(*) FILTER (WHERE hour(ts) = {int(h)}) AS h{h}" for h in HOURS)
    + " FROM events GROUP BY ALL",
)
def pivot_hours(t):
    rows = t.events.select("event_type", F.to_date("ts").alias("day"), F.date_format("ts", "HH").alias("hour"))
    return landing_matrix(rows, ["event_type", "day"], "hour", prefix="h")


@query(
    "pivot_hours_used",
    f"WITH {LANDED} SELECT source, CAST(written_pty AS DATE) AS dia_pty, "
    + ", ".join(f"count(*) FILTER (WHERE hour(written_pty) IN ({h}, {h + 1})) AS h{h:02d}" for h in range(0, 24, 2))
    + " FROM landed GROUP BY ALL",
)
def pivot_hours_used(t):
    # Hours are taken in pairs, so every odd hour's column is empty and dropped.
    hour = F.col("hora_pty").cast("int")
    paired = landing_times(landed(t)).withColumn("hora_pty", F.format_string("%02d", hour - hour % 2))
    return landing_matrix(paired, ["source", "dia_pty"], prefix="h", drop_empty=True)


@query(
    "landing_daily",
    f"WITH {LANDED} SELECT source, variante, CAST(written_pty AS DATE) AS dia_pty, count(*) AS n_files FROM landed GROUP BY ALL",
)
def landing_daily_query(t):
    return landing_daily(landing_times(classify_variant(landed(t))))


@query(
    "landing_latest",
    f"WITH {LANDED} SELECT source, variante, max(written_pty) AS last_written_pty FROM landed GROUP BY ALL",
)
def landing_latest_query(t):
    return landing_latest(landing_times(classify_variant(landed(t))))


@query(
    "mae_baseline",
    """
    WITH p AS (SELECT round(l_extendedprice) AS actual, l_quantity * 1500 AS predicted FROM lineitem)
    SELECT round(avg(abs(predicted - actual)), 2) AS mae_model,
           round(avg(abs(actual - (SELECT avg(actual) FROM p))), 2) AS mae_baseline
    FROM p
    """,
)
def mae_baseline(t):
    pred = t.lineitem.select(F.round("l_extendedprice").alias("actual"), (F.col("l_quantity") * 1500).alias("predicted"))
    return mae_vs_baseline(pred, "actual", "predicted")


@query(
    "tide_kind_counts",
    f"""
    WITH {TURN_WORDS}
    SELECT CASE WHEN h >= 9 THEN 'HIGH TIDE' ELSE 'LOW_TIDE' END AS state, count(*) AS n
    FROM words WHERE h >= 9 OR h <= 2 GROUP BY 1
    """,
)
def tide_kind_counts(t):
    moments = tide_replies(t).select(F.explode("raw_data.extremes").alias("m")).select("m.state")
    return distribution(moments, ["state"])
