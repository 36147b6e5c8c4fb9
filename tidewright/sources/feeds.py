"""Scans over a landed tree ``{source}/year=/month=/{forecast|historico}/[day=]/file``.

The literal folder in the middle of the path rules out partition discovery, so dates come from the
path: pruned while listing where a lookback is given, and parsed into a column otherwise.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.scalars import LOCAL_ZONE, as_literal, local_time

# Folder names of the two variants (history has two spellings) and the fallback label.
VARIANT_FOLDERS = {
    "forecast": ["/forecast/"],
    "historico": ["/historico/", "/history/"],
}
UNKNOWN_VARIANT = "desconocido"


def _as_date(as_of: date | datetime | str) -> date:
    if isinstance(as_of, str):
        as_of = datetime.fromisoformat(as_of)
    return as_of.date() if isinstance(as_of, datetime) else as_of


def lookback_dates(as_of: date | datetime | str, days: int) -> list[date]:
    """The calendar dates from ``as_of`` back to ``days`` earlier, both included."""
    today = _as_date(as_of)
    return [today - timedelta(days=n) for n in range(days + 1)]


def path_date(path) -> Column:
    """Date of a landed file: from its year/month/day folders, else from the first YYYYMMDD of its name."""
    text = path if isinstance(path, Column) else F.col(path)
    folders = r"year=(\d{4})/month=(\d{1,2})/(?:.*/)?day=(\d{1,2})/"
    parts = [F.regexp_extract(text, folders, n) for n in (1, 2, 3)]
    padded = F.concat(parts[0], F.lpad(parts[1], 2, "0"), F.lpad(parts[2], 2, "0"))
    stamp = F.regexp_extract(F.element_at(F.split(text, "/"), -1), r"(?:^|\D)(\d{8})(?:\D|$)", 1)
    digits = F.when(parts[0] != "", padded).otherwise(stamp)
    return F.try_to_timestamp(digits, F.lit("yyyyMMdd")).cast("date")


def scan_feed(
    spark: SparkSession,
    root: str,
    schema: T.StructType | None = None,
    as_of: date | datetime | str | None = None,
    lookback_days: int | None = None,
    layout: str = "folder",
    fallback_all: bool = False,
) -> DataFrame:
    """Rows of a feed landed in the last days, with their ``source_path`` and ``path_date``.

    ``layout="folder"`` prunes on the forecast day folders, ``layout="name"`` on a YYYYMMDD stamp in
    the file name. With ``fallback_all`` an empty match reads the whole feed instead. Without a
    schema, differing file schemas are merged.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", True)
    path = root.rstrip("/")
    if lookback_days is not None:
        if as_of is None:
            raise ValueError("a lookback needs the as_of clock")
        dates = lookback_dates(as_of, lookback_days)
        if layout == "folder":
            days = ",".join(f"year={d:%Y}/month={d:%m}/forecast/day={d:%d}" for d in dates)
            pruned = reader, f"{path}/{{{days}}}", "*.parquet"
        else:
            stamps = ",".join(f"{d:%Y%m%d}" for d in dates)
            names = f"*{{{stamps}}}*.parquet"
            pruned = reader.option("pathGlobFilter", names), path, names
        found = _load(spark, *pruned)
        if found is not None:
            return _with_path(found)
        if not fallback_all:
            raise FileNotFoundError(f"no files under {path} for {dates[-1]} to {dates[0]}")
        reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
        reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", True)
    return _with_path(reader.parquet(path))


def _load(spark: SparkSession, reader, path: str, names: str) -> DataFrame | None:
    """The frame, or None when the pattern matches no file; a file without rows is a match."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", names)
    try:
        if not listing.load(path).select("path").limit(1).count():
            return None
        return reader.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _with_path(df: DataFrame) -> DataFrame:
    located = df.withColumn("source_path", F.col("_metadata.file_path"))
    return located.withColumn("path_date", path_date("source_path"))


def landed_files(
    spark: SparkSession,
    roots: dict[str, str],
    as_of: datetime | str | None = None,
    backdays: int | None = None,
) -> DataFrame:
    """Every landed parquet file: source, path, modTimeMs, size. File contents are never read.

    With ``backdays`` only files modified since ``as_of`` minus that many days are kept.
    """

    def listing(source: str, root: str) -> DataFrame:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.parquet")
            .load(root)
        )
        return files.select(
            F.lit(source).alias("source"),
            "path",
            F.unix_millis("modificationTime").alias("modTimeMs"),
            F.col("length").alias("size"),
        )

    files = reduce(DataFrame.unionByName, [listing(s, r) for s, r in roots.items()])
    if backdays is not None:
        if as_of is None:
            raise ValueError("backdays needs the as_of clock")
        start = F.unix_millis(as_literal(as_of)) - F.lit(backdays * 86_400_000)
        files = files.where(F.col("modTimeMs") >= start)
    return classify_variant(files)


def classify_variant(df: DataFrame, path: str = "path", out: str = "variante") -> DataFrame:
    """Forecast or history from the folder in the path, whatever its case."""
    lowered = F.lower(F.col(path))
    label = F.lit(UNKNOWN_VARIANT)
    for name, folders in reversed(VARIANT_FOLDERS.items()):
        hit = reduce(Column.__or__, [lowered.contains(folder) for folder in folders])
        label = F.when(hit, F.lit(name)).otherwise(label)
    return df.withColumn(out, label)


def landing_times(df: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """UTC and local write times of landed files, with the local day and hour used by the reports."""
    written = df.withColumn("written_utc", F.timestamp_millis("modTimeMs"))
    written = written.withColumn("written_pty", local_time("written_utc", zone))
    return written.withColumns(
        {
            "dia_pty": F.to_date("written_pty"),
            "hora_pty": F.date_format("written_pty", "HH"),
            "written_pty_str": F.date_format("written_pty", "yyyy-MM-dd HH:mm:ss"),
            "written_utc_str": F.date_format("written_utc", "yyyy-MM-dd HH:mm:ss"),
        }
    )


def latest_partition(files: DataFrame, by: str = "source", path: str = "path") -> DataFrame:
    """Files of the newest date folder of each source."""
    dated = files.withColumn("path_date", path_date(path)).where(F.col("path_date").isNotNull())
    newest = dated.groupBy(by).agg(F.max("path_date").alias("path_date"))
    return dated.join(newest, [by, "path_date"], "left_semi")
