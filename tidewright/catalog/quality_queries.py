"""Data-quality rules: events per type play the files of a feed."""

from pyspark.sql import functions as F

from tidewright.catalog.registry import query
from tidewright.catalog.standins import LANDED, READINGS, TURN_WORDS, landed, readings, tide_replies
from tidewright.operators.aggregates import coverage
from tidewright.operators.quality import (
    TIDE_SUITE,
    GridSuite,
    PointSuite,
    judge_points,
    pending,
    point_metrics,
    rule_count,
    rule_coverage,
    rule_not_null,
    rule_presence,
    rule_ranges,
    rule_unique,
    validate_grid,
    validate_points,
)
from tidewright.sources import landing_times


@query(
    "dup_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def dup_keys(t):
    return rule_unique(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "dq_counts",
    """
    SELECT event_type, count(*) AS n_rows, count(DISTINCT user_id) AS found, 150 AS expected,
           count(DISTINCT user_id) = 150 AS count_ok, count(*) > 0 AS not_empty
    FROM events GROUP BY event_type
    """,
)
def dq_counts(t):
    return rule_count(t.events, "user_id", 150, ["event_type"])


@query(
    "dq_coverage",
    """
    WITH c AS (
      SELECT event_type, user_id, min(ts) AS min_ts, max(ts) AS max_ts, count(*) AS n_points,
             (floor(epoch(max(ts))) - floor(epoch(min(ts)))) / 3600.0 AS range_hours
      FROM events GROUP BY ALL)
    SELECT * FROM c WHERE n_points < 10 OR range_hours < 600.0
    """,
)
def dq_coverage(t):
    return rule_coverage(coverage(t.events, ["event_type", "user_id"], "ts"), 10, 600.0)


@query(
    "dq_nulls",
    """
    SELECT event_type, count(*) FILTER (WHERE value < 20) AS null_a, count(*) FILTER (WHERE hour(ts) >= 20) AS null_b,
           count(*) FILTER (WHERE user_id IS NULL) AS null_user_id
    FROM events GROUP BY event_type
    """,
)
def dq_nulls(t):
    gaps = t.events.withColumns(
        {"a": F.when(F.col("value") >= 20, F.col("value")), "b": F.when(F.hour("ts") < 20, F.col("value"))}
    )
    return rule_not_null(gaps, ["a", "b", "user_id"], ["event_type"])


@query(
    "dq_presence",
    """
    WITH day_types AS (SELECT DISTINCT user_id, event_type FROM events),
    expected AS (SELECT unnest(['click', 'error', 'purchase', 'refund', 'signup', 'view']) AS event_type),
    missing AS (
      SELECT u.user_id, string_agg(e.event_type, ',' ORDER BY e.event_type) AS missing
      FROM (SELECT DISTINCT user_id FROM events) u, expected e
      WHERE NOT EXISTS (SELECT 1 FROM day_types d WHERE d.user_id = u.user_id AND d.event_type = e.event_type)
      GROUP BY u.user_id)
    SELECT d.user_id, count(*) AS n_present, coalesce(any_value(m.missing), '') AS missing, count(*) >= 5 AS enough
    FROM day_types d LEFT JOIN missing m USING (user_id) GROUP BY d.user_id
    """,
)
def dq_presence(t):
    expected = ["click", "error", "purchase", "refund", "signup", "view"]
    return rule_presence(t.events, "event_type", expected, 5, ["user_id"])


@query(
    "dq_ranges",
    """
    SELECT l_returnflag, count(*) FILTER (WHERE l_quantity < 5 OR l_quantity > 45) AS out_l_quantity,
           count(*) FILTER (WHERE l_extendedprice < 2000 OR l_extendedprice > 90000) AS out_l_extendedprice
    FROM lineitem GROUP BY l_returnflag
    """,
)
def dq_ranges(t):
    rules = {"l_quantity": (5.0, 45.0), "l_extendedprice": (2000.0, 90000.0)}
    return rule_ranges(t.lineitem, rules, ["l_returnflag"])


EVENT_SUITE = PointSuite("", "ts", expected_points=150, min_readings=10, min_hours=600.0)


@query(
    "dq_report",
    f"""
    WITH {READINGS}, m AS (SELECT event_type AS path, user_id AS point, floor(epoch(ts) / 600) AS slot,
                                  floor(epoch(ts)) AS sec FROM readings),
    slots AS (SELECT path, point, slot, count(*) AS c FROM m GROUP BY ALL),
    points AS (
      SELECT path, point, sum(c) AS n, (max(slot) - min(slot)) * 600 / 3600.0 AS hours, count(*) FILTER (WHERE c > 1) AS dups
      FROM slots GROUP BY ALL),
    f AS (
      SELECT path, count(*) AS puntos_cnt, count(*) FILTER (WHERE n < 10 OR hours < 600) AS bad_puntos,
             CAST(sum(dups) AS BIGINT) AS dup_keys FROM points GROUP BY path)
    SELECT path, puntos_cnt, bad_puntos, dup_keys,
           CASE WHEN puntos_cnt = 150 AND bad_puntos = 0 AND dup_keys = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
           nullif(concat_ws('; ',
             CASE WHEN puntos_cnt <> 150 THEN 'PUNTOS_COUNT found=' || puntos_cnt || ' expected=150' END,
             CASE WHEN bad_puntos > 0 THEN 'RANGE_OR_POINTS bad_puntos=' || bad_puntos
                  || ' expected_points=10 min_range_h=600.0' END,
             CASE WHEN dup_keys > 0 THEN 'DUPLICATES dup_keys=' || dup_keys END), '') AS violations
    FROM f
    """,
)
def dq_report(t):
    slot = F.floor(F.unix_timestamp("ts") / 600) * 600.0
    rows = t.events.select(F.col("event_type").alias("path"), F.col("user_id").alias("point"), slot.alias("ts"))
    metrics = point_metrics(rows, ["path"], EVENT_SUITE.min_readings, EVENT_SUITE.min_hours)
    return judge_points(metrics, EVENT_SUITE)


@query(
    "dq_replies",
    f"""
    WITH {TURN_WORDS},
    points AS (SELECT zona_id, punto_id, count(*) AS n, (count(*) - 1) * 600 / 3600.0 AS hours FROM words GROUP BY ALL),
    f AS (
      SELECT zona_id, count(*) AS puntos_cnt, count(*) FILTER (WHERE n < 48 OR hours < 47) AS bad_puntos
      FROM points GROUP BY zona_id)
    SELECT zona_id, puntos_cnt, bad_puntos, CAST(0 AS BIGINT) AS dup_keys,
           CASE WHEN puntos_cnt = 30 AND bad_puntos = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
           nullif(concat_ws('; ',
             CASE WHEN puntos_cnt <> 30 THEN 'PUNTOS_COUNT found=' || puntos_cnt || ' expected=30' END,
             CASE WHEN bad_puntos > 0 THEN 'RANGE_OR_POINTS bad_puntos=' || bad_puntos
                  || ' expected_points=48 min_range_h=47.0' END), '') AS violations
    FROM f
    """,
)
def dq_replies(t):
    return validate_points(tide_replies(t), TIDE_SUITE, ["zona_id"])


@query(
    "dq_grid_report",
    f"""
    WITH {READINGS},
    cells AS (SELECT event_type AS path, user_id, CASE WHEN value >= 3 THEN CAST(k // 25 AS VARCHAR) END AS zona_id,
                     CAST(ts AS DATE) AS day FROM readings),
    keys AS (SELECT path, zona_id, user_id, day, count(*) AS c FROM cells GROUP BY ALL),
    f AS (
      SELECT path, count(DISTINCT zona_id) AS puntos_cnt, count(*) FILTER (WHERE c > 1) AS dup_keys,
             sum(c) FILTER (WHERE zona_id IS NULL) AS nulls,
             list_sort(list_filter(['0', '1', '2', '3', '4', '5'],
               lambda z: NOT list_contains(list(DISTINCT zona_id) FILTER (WHERE zona_id IS NOT NULL), z))) AS missing
      FROM keys GROUP BY path)
    SELECT path, puntos_cnt, len(missing) AS bad_puntos, dup_keys,
           CASE WHEN coalesce(nulls, 0) = 0 AND puntos_cnt >= 3 AND dup_keys = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
           CASE WHEN coalesce(nulls, 0) = 0 AND puntos_cnt >= 3 AND dup_keys = 0
                THEN 'SOFT:MISSING_ZONAS missing=' || array_to_string(missing, ',')
                ELSE concat_ws('; ',
                  CASE WHEN nulls > 0 THEN 'NULLS_IN_REQUIRED zona_id=' || nulls END,
                  CASE WHEN puntos_cnt < 3 THEN 'ZONAS_PRESENTES present=' || puntos_cnt || ' missing='
                       || array_to_string(missing, ',') END,
                  CASE WHEN dup_keys > 0 THEN 'DUPLICATES dup_keys=' || dup_keys END) END AS violations
    FROM f
    """,
)
def dq_grid_report(t):
    zone = F.when(F.col("value") >= 3, F.floor(F.col("k") / 25).cast("string"))
    cells = readings(t).select(
        F.col("event_type").alias("path"), "user_id", zone.alias("zona_id"), F.to_date("ts").alias("day")
    )
    suite = GridSuite(tuple("012345"), 3, ("zona_id", "user_id", "day"), ("zona_id", "user_id", "day"))
    return validate_grid(cells, suite, ["path"])


@query(
    "pending_files",
    f"""
    WITH {LANDED}
    SELECT source, path, written_utc AS event_time FROM landed
    WHERE written_utc >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 24 HOUR
      AND source IN ('view', 'click', 'purchase') AND value >= 40
    QUALIFY row_number() OVER (PARTITION BY source ORDER BY written_utc DESC, path) <= 15
    """,
)
def pending_files(t):
    files = landing_times(landed(t))
    log = landed(t).where("value < 40").select("path", F.lit("PASS").alias("status"))
    return pending(files, log, "2024-01-30 12:00:00", ["View", "click", "purchase"], hours=24, per_source=15)


@query(
    "pending_all",
    f"""
    WITH {LANDED}
    SELECT source, path, written_utc AS event_time FROM landed WHERE source IN ('view', 'click', 'purchase') AND value >= 40
    """,
)
def pending_all(t):
    files = landing_times(landed(t))
    log = landed(t).where("value < 40").select("path", F.lit("PASS").alias("status"))
    return pending(files, log, "2024-01-30 12:00:00", ["View", "click", "purchase"])


@query(
    "pending_retry",
    f"""
    WITH {LANDED}
    SELECT source, path, written_utc AS event_time FROM landed
    WHERE written_utc >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 48 HOUR
      AND source IN ('view', 'error') AND value >= 20
    QUALIFY row_number() OVER (PARTITION BY source ORDER BY written_utc DESC, path) <= 15
    """,
)
def pending_retry(t):
    files = landing_times(landed(t))
    status = F.when(F.col("value") < 20, "PASS").otherwise("FAIL")
    log = landed(t).where("value < 40").select("path", status.alias("status"))
    return pending(files, log, "2024-01-30 12:00:00", ["view", "error"], hours=48, per_source=15, retry_failed=True)
