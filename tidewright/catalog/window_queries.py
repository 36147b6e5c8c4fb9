"""Time-series operators."""

from pyspark.sql import functions as F

from tidewright.catalog.registry import query
from tidewright.catalog.standins import READINGS, ZONE_HOURS, readings, zone_hours
from tidewright.functions import truncate
from tidewright.operators.windows import (
    HOUR,
    best_run,
    daily_amplitude,
    deltas,
    forward_sum,
    lags,
    latest_per_key,
    pick_current,
    top_n,
    trailing_stats,
    verify_forward_sum,
)

#: Rows of a slice of a timeline.
SLICE_ROWS = 1 << 20


@query(
    "dedup_latest",
    """
    SELECT * FROM lineitem
    QUALIFY row_number() OVER (
      PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
               l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1
    """,
)
def dedup_latest(t):
    return latest_per_key(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query(
    "top_n",
    """
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
    WHERE lower(o_orderpriority) IN ('1-urgent', '2-high')
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) <= 3
    """,
)
def top_n_query(t):
    urgent = t.orders.where(F.lower("o_orderpriority").isin("1-urgent", "2-high"))
    rows = urgent.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return top_n(rows, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey")], 3)


@query(
    "pick_current",
    """
    SELECT event_id, event_type, ts FROM events
    WHERE ts >= TIMESTAMP '2024-01-20 12:00:00' AND ts < TIMESTAMP '2024-01-20 15:00:00'
    QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) = 1
    """,
)
def pick_current_query(t):
    rows = t.events.select("event_id", "event_type", "ts")
    return pick_current(rows, ["event_type"], "ts", "2024-01-20 12:00:00", 3, ["event_id"])


def _runs(t):
    e = t.events
    return e.select("event_id", "event_type", F.to_date("ts").alias("day"), F.hour("ts").alias("run"), "value")


@query(
    "best_run",
    """
    WITH r AS (SELECT event_id, event_type, CAST(ts AS DATE) AS day, CAST(hour(ts) AS INTEGER) AS run, value FROM events)
    SELECT r.* FROM r JOIN (SELECT event_type, day, max(run) AS run FROM r GROUP BY ALL) m
      ON r.event_type = m.event_type AND r.day = m.day AND r.run = m.run
    """,
)
def best_run_query(t):
    return best_run(_runs(t), ["event_type", "day"], "run")


@query(
    "best_run_one",
    """
    WITH r AS (SELECT event_id, event_type, CAST(ts AS DATE) AS day, CAST(hour(ts) AS INTEGER) AS run, value FROM events)
    SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY event_type, day ORDER BY run DESC, event_id DESC) = 1
    """,
)
def best_run_one(t):
    return best_run(_runs(t), ["event_type", "day"], "run", ties="one", tiebreak=["event_id"])


@query(
    "daily_amplitude",
    f"""
    WITH {READINGS},
    x AS (SELECT event_id, user_id, ts, whole, CASE event_type WHEN 'view' THEN 'HIGH' WHEN 'click' THEN 'LOW_TIDE'
                 ELSE event_type END AS kind FROM readings),
    d AS (SELECT user_id, CAST(ts AS DATE) AS day,
                 max(whole) FILTER (WHERE contains(kind, 'HIGH')) AS hi, min(whole) FILTER (WHERE contains(kind, 'LOW')) AS lo
          FROM x GROUP BY ALL)
    SELECT event_id, x.user_id, ts, kind, abs(hi - lo) AS amplitud_dia_m
    FROM x JOIN d ON x.user_id = d.user_id AND CAST(x.ts AS DATE) = d.day
    """,
)
def daily_amplitude_query(t):
    kind = (
        F.when(F.col("event_type") == "view", "HIGH")
        .when(F.col("event_type") == "click", "LOW_TIDE")
        .otherwise(F.col("event_type"))
    )
    rows = readings(t).withColumn("kind", kind)
    rated = daily_amplitude(rows, ["user_id"], "ts", "whole", "kind")
    return rated.select("event_id", "user_id", "ts", "kind", "amplitud_dia_m")


@query(
    "forward_sum",
    f"""
    WITH {ZONE_HOURS}
    SELECT event_type, hour, n + coalesce(lead(n, 1) OVER w, 0) + coalesce(lead(n, 2) OVER w, 0) AS total_3h
    FROM zone_hours WINDOW w AS (PARTITION BY event_type ORDER BY hour)
    """,
)
def forward_sum_query(t):
    return forward_sum(zone_hours(t), ["event_type"], "hour", "n", 2, 1, "total_3h").select(
        "event_type", "hour", "total_3h"
    )


@query(
    "forward_sum_time",
    f"""
    WITH {ZONE_HOURS}
    SELECT event_type, hour, sum(n) OVER (PARTITION BY event_type ORDER BY hour
             RANGE BETWEEN CURRENT ROW AND INTERVAL 2 HOUR FOLLOWING) AS total_3h
    FROM zone_hours
    """,
)
def forward_sum_time(t):
    return forward_sum(zone_hours(t), ["event_type"], "hour", "n", 2, 1, "total_3h", by_time=True).select(
        "event_type", "hour", "total_3h"
    )


@query(
    "forward_sum_sliced",
    f"""
    WITH {READINGS}
    SELECT event_id, event_type, ts,
           CAST(cents + coalesce(lead(cents, 1) OVER w, 0) + coalesce(lead(cents, 2) OVER w, 0) AS DOUBLE) AS total
    FROM readings WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)
    """,
)
def forward_sum_sliced(t):
    rows = readings(t).select("event_id", "event_type", "ts", "cents")
    summed = forward_sum(
        rows, ["event_type"], "ts", "cents", 2, None, "total", tiebreak=["event_id"], slice_rows=SLICE_ROWS
    )
    return summed.select("event_id", "event_type", "ts", "total")


@query(
    "trailing_24h",
    f"""
    WITH {ZONE_HOURS}
    SELECT event_type, hour, avg(peak) OVER d AS peak_mean_24h, max(peak) OVER d AS peak_max_24h,
           round(stddev_samp(peak) OVER d, 4) AS peak_std_24h, sum(n) OVER d AS n_sum_24h,
           max(peak) OVER q AS peak_max_6h, min(n) OVER q AS n_min_6h
    FROM zone_hours
    WINDOW d AS (PARTITION BY event_type ORDER BY hour RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW),
           q AS (PARTITION BY event_type ORDER BY hour RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW)
    """,
)
def trailing_24h(t):
    specs = {
        "peak_mean_24h": ("peak", "mean", 24 * HOUR),
        "peak_max_24h": ("peak", "max", 24 * HOUR),
        "peak_std_24h": ("peak", "std", 24 * HOUR),
        "n_sum_24h": ("n", "sum", 24 * HOUR),
        "peak_max_6h": ("peak", "max", 6 * HOUR),
        "n_min_6h": ("n", "min", 6 * HOUR),
    }
    stats = trailing_stats(zone_hours(t), ["event_type"], "hour", specs)
    return stats.withColumn("peak_std_24h", F.round("peak_std_24h", 4)).select("event_type", "hour", *specs)


@query(
    "trailing_readings",
    f"""
    WITH {READINGS}, s AS (SELECT *, date_trunc('second', ts) AS sec FROM readings)
    SELECT event_id, event_type, ts, CAST(sum(cents) OVER d AS BIGINT) AS cents_sum, max(cents) OVER d AS cents_max
    FROM s WINDOW d AS (PARTITION BY event_type ORDER BY sec RANGE BETWEEN INTERVAL 2 HOUR PRECEDING AND CURRENT ROW)
    """,
)
def trailing_readings(t):
    rows = readings(t).select("event_id", "event_type", "ts", "cents")
    specs = {"cents_sum": ("cents", "sum", 2 * HOUR), "cents_max": ("cents", "max", 2 * HOUR)}
    stats = trailing_stats(rows, ["event_type"], "ts", specs, collapse=True).drop("cents")
    return stats.withColumn("cents_sum", F.col("cents_sum").cast("bigint"))


@query(
    "lags",
    f"""
    WITH {ZONE_HOURS}
    SELECT event_type, hour, lag(peak, 1) OVER w AS peak_lag_1, lag(peak, 3) OVER w AS peak_lag_3,
           lag(peak, 6) OVER w AS peak_lag_6, lag(peak, 12) OVER w AS peak_lag_12, lead(n, 1) OVER w AS n_lead_1
    FROM zone_hours WINDOW w AS (PARTITION BY event_type ORDER BY hour)
    """,
)
def lags_query(t):
    specs = {f"peak_lag_{n}": ("peak", n) for n in (1, 3, 6, 12)} | {"n_lead_1": ("n", -1)}
    return lags(zone_hours(t), ["event_type"], "hour", specs).select("event_type", "hour", *specs)


@query(
    "lags_sliced",
    f"""
    WITH {READINGS}
    SELECT event_id, event_type, ts, lag(cents, 1) OVER w AS lag_1, lag(cents, 12) OVER w AS lag_12, lead(k, 2) OVER w AS lead_2
    FROM readings WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)
    """,
)
def lags_sliced(t):
    rows = readings(t).select("event_id", "event_type", "ts", "cents", "k")
    specs = {"lag_1": ("cents", 1), "lag_12": ("cents", 12), "lead_2": ("k", -2)}
    found = lags(
        rows, ["event_type"], "ts", specs, tiebreak=["event_id"], slice_rows=SLICE_ROWS
    )
    return found.select("event_id", "event_type", "ts", *specs)


@query(
    "deltas",
    f"""
    WITH {ZONE_HOURS}
    SELECT event_type, hour, peak - lag(peak, 3) OVER w AS peak_delta, n - lag(n, 3) OVER w AS n_delta
    FROM zone_hours WINDOW w AS (PARTITION BY event_type ORDER BY hour)
    """,
)
def deltas_query(t):
    changed = deltas(zone_hours(t), ["event_type"], "hour", {"peak_delta": "peak", "n_delta": "n"})
    return changed.select("event_type", "hour", "peak_delta", "n_delta")


@query(
    "verify_forward",
    f"""
    WITH {ZONE_HOURS},
    stored AS (
      SELECT event_type, hour, CASE WHEN n > 2 THEN n END AS rate,
             sum(CASE WHEN n > 2 THEN n ELSE 0 END) OVER (PARTITION BY event_type ORDER BY hour
               RANGE BETWEEN CURRENT ROW AND INTERVAL 2 HOUR FOLLOWING) AS total
      FROM zone_hours),
    checked AS (
      SELECT *, coalesce(rate, 0) + coalesce(lead(rate, 1) OVER w, 0) + coalesce(lead(rate, 2) OVER w, 0) AS expected_sum
      FROM stored WINDOW w AS (PARTITION BY event_type ORDER BY hour))
    SELECT event_type, hour, rate, total, expected_sum,
           CASE WHEN abs(total - expected_sum) < 0.1 THEN 'MATCH' ELSE 'DIFF' END AS sum_check,
           CASE WHEN total >= rate THEN 'OK' WHEN total IS NULL AND rate IS NULL THEN 'NULL' ELSE 'ERROR' END AS value_check
    FROM checked
    """,
)
def verify_forward(t):
    series = zone_hours(t).select("event_type", "hour", F.when(F.col("n") > 2, F.col("n")).alias("rate"))
    stored = forward_sum(series, ["event_type"], "hour", "rate", 2, 1, "total", by_time=True)
    return verify_forward_sum(stored, ["event_type"], "hour", "rate", "total")


@query(
    "run_of_day",
    """
    SELECT event_type, date_trunc('day', ts) AS day, max(hour(ts))::INTEGER AS last_hour FROM events GROUP BY ALL
    """.replace("date_trunc('day', ts) AS day", "CAST(date_trunc('day', ts) AS TIMESTAMP) AS day"),
)
def run_of_day(t):
    hourly = t.events.select("event_type", truncate(t.events, "ts", "day").alias("day"), F.hour("ts").alias("last_hour"))
    return latest_per_key(hourly, ["event_type", "day"], ["last_hour"])
