"""What the library does on disk: landed files, their stream and contracts, partitioned tables.

Each query first lays its table out in a new folder below the shared checkpoint folder, works there and reads back.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.catalog.registry import Tables, query
from tidewright.catalog.standins import READINGS, readings
from tidewright.operators.contracts import refresh_contracts
from tidewright.operators.quality import Contract, PointSuite, validate_files
from tidewright.session import checkpoint_dir, settle
from tidewright.sinks.tables import replace_range
from tidewright.sinks.upsert import upsert_table
from tidewright.sources.feeds import landed_files, scan_feed
from tidewright.streaming.landing import notice_stream, stream_validate, validation_log


def _folder(t: Tables, name: str) -> str:
    return f"{checkpoint_dir(t.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _replies(t: Tables) -> DataFrame:
    """Events as replies: one row per event type, day and user, with the readings as an array."""
    moment = F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("time"), "cents")
    rows = readings(t).groupBy("event_type", F.to_date("ts").alias("day"), F.col("user_id").cast("string").alias("punto_id"))
    return rows.agg(F.sort_array(F.collect_list(moment)).alias("hours")).select(
        "event_type", "day", "punto_id", F.struct("hours").alias("raw_data")
    )


#: Landed by a provider that has changed its schema without notice.
CHANGED = "error"


def _landed(t: Tables) -> tuple[str, Contract]:
    """A landed tree with one file per event type and day, and the contract of the feed."""
    root, rows = _folder(t, "landed"), _replies(t)
    agreed, changed = rows.where(F.col("event_type") != CHANGED), rows.where(F.col("event_type") == CHANGED)
    for part in (agreed, changed.withColumnRenamed("punto_id", "point")):
        part.repartition("event_type", "day").write.mode("append").partitionBy("event_type", "day").parquet(root)
    suite = PointSuite("raw_data.hours", "time", expected_points=20, min_readings=2, min_hours=0.25)
    return root, Contract(rows.drop("event_type", "day").schema, suite)


def _verdicts(log: DataFrame) -> DataFrame:
    """Verdicts by event type and day, told from the path; of a schema mismatch only the word."""
    told = F.when(F.col("violations").startswith("SCHEMA_MISMATCH"), "SCHEMA_MISMATCH").otherwise(F.col("violations"))
    return log.select(
        F.regexp_extract("path", r"event_type=([^/]+)/", 1).alias("event_type"),
        F.regexp_extract("path", r"day=([^/]+)/", 1).cast("date").alias("day"),
        "status", "puntos_cnt", "bad_puntos", "dup_keys", told.alias("violations"),
    )


VERDICTS_SQL = f"""
WITH {READINGS}, moments AS (
  SELECT event_type, CAST(ts AS DATE) AS day, user_id, floor(epoch(ts)) AS sec, count(*) AS c FROM readings GROUP BY ALL),
points AS (
  SELECT event_type, day, user_id, sum(c) AS n, (max(sec) - min(sec)) / 3600.0 AS hours, count(*) FILTER (WHERE c > 1) AS dups
  FROM moments GROUP BY ALL),
files AS (
  SELECT event_type, day, count(*) AS puntos_cnt, count(*) FILTER (WHERE n < 2 OR hours < 0.25) AS bad_puntos, sum(dups) AS dup_keys
  FROM points GROUP BY ALL),
judged AS (
  SELECT *, concat_ws('; ',
    CASE WHEN puntos_cnt <> 20 THEN 'PUNTOS_COUNT found=' || puntos_cnt || ' expected=20' END,
    CASE WHEN bad_puntos > 0 THEN 'RANGE_OR_POINTS bad_puntos=' || bad_puntos || ' expected_points=2 min_range_h=0.25' END,
    CASE WHEN dup_keys > 0 THEN 'DUPLICATES dup_keys=' || dup_keys END) AS found
  FROM files)
SELECT event_type, day, CASE WHEN refused IS NULL AND found = '' THEN 'PASS' ELSE 'FAIL' END AS status,
       CASE WHEN refused IS NULL THEN puntos_cnt::INTEGER END AS puntos_cnt,
       CASE WHEN refused IS NULL THEN bad_puntos::INTEGER END AS bad_puntos,
       CASE WHEN refused IS NULL THEN dup_keys::INTEGER END AS dup_keys,
       coalesce(refused, nullif(found, '')) AS violations
FROM (SELECT *, REFUSED AS refused FROM judged)
"""
MISMATCH = f"CASE WHEN event_type = '{CHANGED}' THEN 'SCHEMA_MISMATCH' END"


@query("dq_landed", VERDICTS_SQL.replace("REFUSED", MISMATCH, 1))
def dq_landed(t):
    root, contract = _landed(t)
    queue = landed_files(t.spark, {"readings": root})
    return _verdicts(validate_files(t.spark, queue, "readings", contract, "2024-01-31 00:00:00"))


#: Announced under a source that nobody has a contract for.
STRANGE = "signup"


@query(
    "stream_landed",
    VERDICTS_SQL.replace(
        "REFUSED", f"CASE WHEN event_type = '{STRANGE}' THEN 'UNSUPPORTED_SOURCE' WHEN event_type = '{CHANGED}' THEN 'SCHEMA_MISMATCH' END", 1
    ),
)
def stream_landed(t):
    """Notices of all files in three batches, some files announced twice and some notices without a path; a second run
    and a replay from the start change nothing."""
    root, contract = _landed(t)
    inbox, out = _folder(t, "notices"), _folder(t, "verdicts")
    files = landed_files(t.spark, {"readings": root}).select("path")
    source = F.when(F.col("path").contains(f"event_type={STRANGE}/"), "nobody").otherwise(" Readings ")
    notices = files.select(source.alias("source"), "path", F.lit("2024-01-31").alias("run_ts"))
    again = notices.where(F.col("path").contains("event_type=view/"))
    blank = notices.where(F.col("path").contains("event_type=click/")).withColumn("path", F.lit("  "))
    for part in (notices, again, blank):
        part.coalesce(1).write.mode("append").json(inbox)
    for checkpoint in (_folder(t, "seen"),) * 2 + (_folder(t, "seen"),):
        stream = notice_stream(t.spark, inbox, max_files=1)
        stream_validate(stream, {"readings": contract}, out, checkpoint, "2024-01-31 00:00:00").awaitTermination()
    return _verdicts(validation_log(t.spark, out))


def _by_month(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.col("o_totalprice").alias("price"), F.date_format("o_orderdate", "yyyy-MM").alias("month"))


def _files(t: Tables, path: str) -> DataFrame:
    """The files of each month of a table."""
    return t.spark.read.parquet(path).select("month", F.col("_metadata.file_name").alias("file")).distinct()


@query(
    "upsert_disk",
    """
    WITH o AS (SELECT o_orderkey, o_totalprice AS price, strftime(o_orderdate, '%Y-%m') AS month FROM orders),
    s AS (SELECT o_orderkey, price * 2 AS price, month FROM o WHERE month IN ('1996-03', '1998-07') AND o_orderkey % 2 = 0
          UNION ALL SELECT -o_orderkey, price, month FROM o WHERE month = '1998-07')
    SELECT o_orderkey, price, month, month NOT IN ('1996-03', '1998-07') AS files_kept FROM s
    UNION ALL SELECT *, month NOT IN ('1996-03', '1998-07') FROM o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)
    """,
)
def upsert_disk(t):
    """The whole table written by month, then two months changed and added to; the others keep their files."""
    path, keys = _folder(t, "orders"), ["o_orderkey"]
    upsert_table(t.spark, path, _by_month(t), keys, "month")
    before = settle(_files(t, path), "files")
    changed = _by_month(t).where(F.col("month").isin("1996-03", "1998-07") & (F.col("o_orderkey") % 2 == 0))
    added = _by_month(t).where(F.col("month") == "1998-07").withColumn("o_orderkey", -F.col("o_orderkey"))
    upsert_table(t.spark, path, changed.withColumn("price", F.col("price") * 2).unionByName(added), keys, "month")
    met = _files(t, path).withColumn("now", F.lit(True)).join(before.withColumn("was", F.lit(True)), ["month", "file"], "full_outer")
    kept = met.groupBy("month").agg(F.every(F.coalesce(F.col("now") & F.col("was"), F.lit(False))).alias("files_kept"))
    return t.spark.read.parquet(path).select(*keys, "price", "month").join(kept, "month").select(*keys, "price", "month", "files_kept")


@query(
    "replace_range_disk",
    f"""
    WITH {READINGS}, r AS (SELECT event_id, cents, CAST(ts AS DATE) AS day FROM readings)
    SELECT * FROM r WHERE day < DATE '2024-01-20'
    UNION ALL SELECT event_id, -cents, day FROM r WHERE day >= DATE '2024-01-20' AND day NOT IN (DATE '2024-01-22', DATE '2024-01-30')
    """,
)
def replace_range_disk(t):
    """All days written, then everything from the 20th on replaced by other figures, two of these days by nothing."""
    path = _folder(t, "days")
    rows = readings(t).select("event_id", "cents", F.to_date("ts").alias("day"))
    replace_range(t.spark, path, rows, "day", date(1970, 1, 1))
    fresh = rows.where(~F.col("day").isin(date(2024, 1, 22), date(2024, 1, 30))).withColumn("cents", -F.col("cents"))
    for _ in range(2):  # once more changes nothing
        replace_range(t.spark, path, fresh, "day", date(2024, 1, 20))
    return t.spark.read.parquet(path).select("event_id", "cents", "day")


def _dated(t: Tables, root: str, rows: DataFrame) -> None:
    """Rows below year/month/forecast/day folders; a calendar has few months."""
    stamped = rows.withColumns({"_month": F.date_format("ts", "'year='yyyy'/month='MM"), "day": F.date_format("ts", "dd")})
    for month in sorted(r["_month"] for r in stamped.select("_month").distinct().collect()):
        own = stamped.where(F.col("_month") == month).drop("_month")
        own.write.mode("append").partitionBy("day").parquet(f"{root}/{month}/forecast")


@query(
    "scan_dated",
    f"""
    WITH {READINGS}
    SELECT event_id, cents, CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-26' THEN k END AS k, CAST(ts AS DATE) AS path_date
    FROM readings WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-22' AND DATE '2024-01-29'
    """,
)
def scan_dated(t):
    """The last week of a feed in dated folders, whose files have a column more from the 26th on."""
    root, rows = _folder(t, "feed"), readings(t).select("event_id", "cents", "k", "ts")
    _dated(t, root, rows.where(F.col("ts") < "2024-01-26").drop("k"))
    _dated(t, root, rows.where(F.col("ts") >= "2024-01-26"))
    return scan_feed(t.spark, root, None, "2024-01-29 12:00:00", 7).select("event_id", "cents", "k", "path_date")


@query(
    "contracts_disk",
    """
    WITH last AS (SELECT event_type AS source, max(CAST(ts AS DATE)) AS path_date FROM events GROUP BY ALL)
    SELECT source, CASE source WHEN 'purchase' THEN 'FAILED' ELSE 'SUCCESS' END AS status, path_date,
           CASE source WHEN 'click' THEN true WHEN 'view' THEN false END AS schema_changed,
           CASE source WHEN 'purchase' THEN NULL WHEN 'click' THEN false ELSE true END AS field_present
    FROM last WHERE source <> 'error'
    UNION ALL SELECT DISTINCT event_type, 'NOT_FOUND', NULL::DATE, NULL::BOOLEAN, NULL::BOOLEAN FROM events WHERE event_type = 'error'
    """,
)
def contracts_disk(t):
    """Contracts of five sources, refreshed twice: one keeps its schema, one loses a field, one comes for the first time,
    one has no parquet and one no files."""
    stored, table = _folder(t, "contracts"), _folder(t, "sources")
    rows = readings(t).select("event_type", "event_id", "cents", "k", "ts", F.to_date("ts").alias("day"))

    def land(kind: str, name: str, drop: str | None = None, text: bool = False) -> DataFrame:
        own = rows.where(F.col("event_type") == kind).drop("event_type")
        path = f"{table}/{name}/{kind}"
        days = own.withColumns({"year": F.date_format("ts", "yyyy"), "month": F.date_format("ts", "MM"), "day": F.date_format("ts", "dd")})
        if text:
            days = days.select(F.to_json(F.struct("event_id", "cents")).alias("value"), "year", "month", "day")
        writer = (days.drop(drop) if drop else days).write.partitionBy("year", "month", "day")
        writer.text(path) if text else writer.parquet(path)
        listing = t.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(path)
        return listing.select(F.lit(kind).alias("source"), "path")

    sources, wanted = ["view", "click", "purchase", "signup", "error"], dict.fromkeys(["view", "click", "purchase", "signup", "error"], "k")
    first = land("view", "first").unionByName(land("click", "first"))
    refresh_contracts(t.spark, first, sources, stored, "2024-01-31 00:00:00", wanted)
    second = land("view", "second").unionByName(land("click", "second", drop="k")).unionByName(land("signup", "second"))
    second = second.unionByName(land("purchase", "second", text=True))
    report = refresh_contracts(t.spark, second, sources, stored, "2024-02-01 00:00:00", wanted)
    return report.select("source", "status", "path_date", "schema_changed", "field_present")
