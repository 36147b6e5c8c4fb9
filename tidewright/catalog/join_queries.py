"""Joins and upserts."""

from pyspark.sql import functions as F

from tidewright.catalog.registry import query
from tidewright.catalog.standins import READINGS, readings
from tidewright.functions import truncate
from tidewright.operators.joins import (
    assign_band,
    assign_zone,
    integrate,
    integrate_all,
    integrate_stack,
    join_daily,
    missing_keys,
    next_event,
    orphans,
)
from tidewright.operators.shape import with_run_date
from tidewright.sinks.tables import replaced_rows
from tidewright.sinks.upsert import upsert
from tidewright.sources import with_bbox


KINDS = ["view", "click", "purchase", "signup", "error"]


@query(
    "integrate_feeds",
    f"""
    WITH {READINGS},
    daily AS (SELECT user_id, CAST(ts AS DATE) AS day, event_type, sum(cents) AS total, count(*) AS n FROM readings GROUP BY ALL)
    SELECT user_id, day, """
    + ", ".join(
        f"CAST(max(total) FILTER (WHERE event_type = '{kind}') AS BIGINT) AS {kind}_total, "
        f"coalesce(max(n) FILTER (WHERE event_type = '{kind}'), 0) AS {kind}_n"
        for kind in KINDS
    )
    + " FROM daily GROUP BY ALL",
)
def integrate_feeds(t):
    rows = readings(t).select("user_id", F.to_date("ts").alias("day"), "event_type", "cents")
    figures = {kind: {f"{kind}_total": (F.sum, "cents"), f"{kind}_n": (F.count, "event_type")} for kind in KINDS}
    return integrate_stack(rows, ["user_id", "day"], figures, "event_type")


@query(
    "integrate_all",
    f"""
    WITH {READINGS},
    d AS (SELECT user_id, CAST(ts AS DATE) AS day, event_type, CAST(sum(cents) AS BIGINT) AS total FROM readings GROUP BY ALL),
    u AS (SELECT DISTINCT user_id, day FROM d)
    SELECT u.user_id, u.day, """
    + ", ".join(f"{kind}.total AS {kind}_total" for kind in KINDS)
    + " FROM u "
    + " ".join(
        f"LEFT JOIN d AS {kind} ON {kind}.user_id = u.user_id AND {kind}.day = u.day AND {kind}.event_type = '{kind}'" for kind in KINDS
    ),
)
def integrate_all_query(t):
    rows = readings(t).select("user_id", F.to_date("ts").alias("day"), "event_type", "cents")

    def feed(kind):
        return rows.where(F.col("event_type") == kind).groupBy("user_id", "day").agg(F.sum("cents").alias(f"{kind}_total"))

    return integrate_all([feed(kind) for kind in KINDS], ["user_id", "day"])


@query(
    "integrate_known",
    f"""
    WITH {READINGS},
    d AS (SELECT user_id, event_type, CAST(sum(cents) AS BIGINT) AS total FROM readings GROUP BY ALL)
    SELECT c_custkey, """
    + ", ".join(f"(SELECT total FROM d WHERE user_id = c_custkey AND event_type = '{kind}') AS {kind}_total" for kind in KINDS)
    + " FROM customer",
)
def integrate_known(t):
    rows = readings(t).withColumnRenamed("user_id", "c_custkey")

    def feed(kind):
        return rows.where(F.col("event_type") == kind).groupBy("c_custkey").agg(F.sum("cents").alias(f"{kind}_total"))

    return integrate(t.customer, [feed(kind) for kind in KINDS], ["c_custkey"])


@query(
    "daily_broadcast",
    f"""
    WITH {READINGS}
    SELECT event_id, event_type, ts,
           avg(cents) OVER (PARTITION BY event_type, CAST(ts AS DATE)) AS day_mean
    FROM readings
    """,
)
def daily_broadcast(t):
    rows = readings(t)
    daily = rows.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.avg("cents").alias("day_mean"))
    return join_daily(rows.select("event_id", "event_type", "ts"), daily, "event_type", "ts", "day")


@query(
    "missing_keys",
    """
    SELECT e.event_type, CAST(h.hour AS TIMESTAMP) AS hour
    FROM (SELECT DISTINCT event_type FROM events) e,
         (SELECT unnest(generate_series(min(date_trunc('hour', ts)), max(date_trunc('hour', ts)), INTERVAL 1 HOUR)) AS hour
          FROM events) h
    WHERE NOT EXISTS (SELECT 1 FROM events x WHERE x.event_type = e.event_type AND date_trunc('hour', x.ts) = h.hour)
    """,
)
def missing_keys_query(t):
    hourly = t.events.select("event_type", truncate(t.events, "ts", "hour").alias("hour")).distinct()
    first = hourly.select(F.min("hour")).scalar()
    last = hourly.select(F.max("hour")).scalar()
    every_hour = F.sequence(first, last, F.expr("INTERVAL 1 HOUR"))
    expected = hourly.select("event_type").distinct().select("event_type", F.explode(every_hour).alias("hour"))
    return missing_keys(expected, hourly, ["event_type", "hour"])


@query(
    "next_event",
    f"""
    WITH {READINGS},
    r AS (SELECT event_id, user_id, ts FROM readings WHERE event_type <> 'purchase'),
    e AS (SELECT user_id, ts AS next_ts, k AS next_k FROM readings WHERE event_type = 'purchase')
    SELECT r.event_id, r.user_id, r.ts, e.next_ts, e.next_k,
           (floor(epoch(e.next_ts)) - floor(epoch(r.ts))) / 3600.0 AS hours_to_event
    FROM r ASOF LEFT JOIN e ON r.user_id = e.user_id AND r.ts < e.next_ts
    """,
)
def next_event_query(t):
    rows = readings(t)
    left = rows.where(F.col("event_type") != "purchase").select("event_id", "user_id", "ts")
    right = rows.where(F.col("event_type") == "purchase").select(
        "user_id", F.col("ts").alias("next_ts"), F.col("k").alias("next_k")
    )
    return next_event(left, right, ["user_id"], "ts", "next_ts", ["next_k"])


@query(
    "range_assign",
    """
    SELECT p.p_partkey, p.p_size, n.n_nationkey AS band
    FROM part p JOIN nation n ON p.p_size BETWEEN n.n_nationkey * 2 AND n.n_nationkey * 2 + 3
    """,
)
def range_assign(t):
    bands = t.nation.select(
        F.col("n_nationkey").alias("band"),
        (F.col("n_nationkey") * 2).alias("low"),
        (F.col("n_nationkey") * 2 + 3).alias("high"),
    )
    return assign_band(t.part.select("p_partkey", "p_size"), bands, "p_size", "low", "high", 4, ["band"])


@query(
    "zone_assign",
    """
    SELECT c.c_custkey, n.n_nationkey
    FROM customer c JOIN nation n
      ON c.c_acctbal / 128 BETWEEN n.n_nationkey * 3 - 1.75 AND n.n_nationkey * 3 + 1.75
     AND c.c_nationkey BETWEEN n.n_regionkey * 5 - 1.75 AND n.n_regionkey * 5 + 1.75
    """,
)
def zone_assign(t):
    # Zones are a bounded table, so the result grows with the points alone.
    zones = with_bbox(
        t.nation.select(
            "n_nationkey", (F.col("n_nationkey") * 3).cast("double").alias("lat"), (F.col("n_regionkey") * 5).cast("double").alias("lon")
        ),
        1.75, None, "n_nationkey", "lat", "lon",
    )
    points = t.customer.select(
        "c_custkey", (F.col("c_acctbal") / 128).alias("lat"), F.col("c_nationkey").cast("double").alias("lon")
    )
    return assign_zone(points, zones, "lat", "lon", 2.0, ["n_nationkey"]).select("c_custkey", "n_nationkey")


@query(
    "orphan_counts",
    """
    SELECT o_custkey, count(*) AS n FROM orders o
    WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_acctbal > 0)
    GROUP BY o_custkey
    """,
)
def orphan_counts(t):
    return orphans(t.orders, t.customer.where("c_acctbal > 0"), "o_custkey", "c_custkey")


def _halves(t):
    """Orders before 1999 as the stored table, orders from 1998 on, repriced, as the incoming rows."""
    run = t.orders.withColumnRenamed("o_orderdate", "run_ts").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "run_ts"
    )
    dated = with_run_date(run)
    stored = dated.where("run_ts < TIMESTAMP_NTZ '1999-01-01 00:00:00'")
    incoming = dated.where("run_ts >= TIMESTAMP_NTZ '1998-01-01 00:00:00'").withColumns(
        {
            "o_totalprice": F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") + 1),
            "o_orderstatus": F.lit("N"),
        }
    )
    return stored, incoming


HALVES = """dated AS (
      SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate AS run_ts, CAST(o_orderdate AS DATE) AS run_date
      FROM orders),
    stored AS (SELECT * FROM dated WHERE run_ts < TIMESTAMP '1999-01-01'),
    incoming AS (
      SELECT o_orderkey, o_custkey, 'N' AS o_orderstatus,
             CASE WHEN o_orderstatus <> 'P' THEN o_totalprice + 1 END AS o_totalprice, run_ts, run_date
      FROM dated WHERE run_ts >= TIMESTAMP '1998-01-01')"""


@query(
    "upsert_full",
    f"""
    WITH {HALVES}
    SELECT * FROM incoming
    UNION ALL
    SELECT * FROM stored s WHERE NOT EXISTS (SELECT 1 FROM incoming i WHERE i.o_orderkey = s.o_orderkey)
    """,
)
def upsert_full(t):
    stored, incoming = _halves(t)
    return upsert(stored, incoming, ["o_orderkey"])


@query(
    "upsert_partial",
    f"""
    WITH {HALVES}
    SELECT coalesce(s.o_orderkey, i.o_orderkey) AS o_orderkey, coalesce(s.o_custkey, i.o_custkey) AS o_custkey,
           CASE WHEN s.o_orderkey IS NULL THEN i.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
           CASE WHEN i.o_orderkey IS NULL THEN s.o_totalprice ELSE i.o_totalprice END AS o_totalprice,
           coalesce(s.run_ts, i.run_ts) AS run_ts, coalesce(s.run_date, i.run_date) AS run_date
    FROM stored s FULL JOIN incoming i ON s.o_orderkey = i.o_orderkey
    """,
)
def upsert_partial(t):
    stored, incoming = _halves(t)
    return upsert(stored, incoming, ["o_orderkey"], ["o_totalprice"])


@query(
    "replace_range",
    """
    SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS day FROM orders
    WHERE o_orderdate < TIMESTAMP '1998-07-01'
    UNION ALL
    SELECT o_orderkey, o_custkey, o_totalprice * 2, CAST(o_orderdate AS DATE) FROM orders
    WHERE o_orderdate >= TIMESTAMP '1998-07-01' AND o_orderstatus <> 'P'
    """,
)
def replace_range_query(t):
    import datetime

    old = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("day"))
    new = t.orders.where("o_orderstatus <> 'P'").select(
        "o_orderkey", "o_custkey", (F.col("o_totalprice") * 2).alias("o_totalprice"), F.to_date("o_orderdate").alias("day")
    )
    return replaced_rows(old, new, "day", datetime.date(1998, 7, 1))


@query(
    "label_orphans",
    """
    SELECT lang, count(*) AS n FROM documents d
    WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) GROUP BY lang
    """,
)
def label_orphans(t):
    unlabelled = missing_keys(t.documents.select("doc_id", "lang"), t.labels, ["doc_id"])
    return unlabelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
