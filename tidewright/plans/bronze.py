"""Bronze tables: the tagged ocean grid of several downloads and the audit of landed files."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.scalars import LOCAL_ZONE, as_literal, local_time
from tidewright.operators.joins import assign_zone
from tidewright.schemas import GRID_BRONZE, GRID_HISTORY, GRID_VALUES
from tidewright.sinks.tables import replace_range
from tidewright.sources.bronze import clean_grid
from tidewright.sources.conform import conform_union
from tidewright.sources.feeds import landing_times

#: Columns of the audit table, in order (fixed contract).
LANDED_COLUMNS = [
    "source", "variante", "path", "modTimeMs", "written_utc", "written_pty", "dia_pty", "hora_pty",
    "written_pty_str", "written_utc_str", "captured_at",
]


def _tagged(cells: DataFrame, zones: DataFrame, kind: str, cell: float) -> DataFrame:
    """Surface cells over water of one download, with every zone they lie in."""
    placed = assign_zone(cells, zones, "latitude", "longitude", cell, ["zona_id", "nombre_zona"])
    values = [c for c in GRID_VALUES if c in cells.columns]
    return clean_grid(placed, values, ["zona_id"]).withColumn("tipo_dato", F.lit(kind))


def bronze_grid(downloads: dict[str, DataFrame], zones: DataFrame, ingested, cell: float = 0.5) -> DataFrame:
    """All downloads (kind -> cells with part of the values) in one table.

    ``zones`` has zona_id, nombre_zona and the four edges. The surface is the smallest depth of a zone in a download.
    """
    frames = [_tagged(cells, zones, kind, cell) for kind, cells in downloads.items()]
    stamped = [df.withColumn("timestamp_ingesta", as_literal(ingested)) for df in frames]
    return conform_union(stamped, GRID_BRONZE)


def bronze_grid_history(downloads: dict[str, DataFrame], zones: DataFrame, cell: float = 0.5) -> DataFrame:
    """The same for past months, with the month of each row to partition by."""
    return conform_union([_tagged(cells, zones, kind, cell) for kind, cells in downloads.items()], GRID_HISTORY, "time")


def _first_day(as_of, backdays: int, zone: str) -> Column:
    return F.date_sub(F.to_date(local_time(as_literal(as_of), zone)), backdays)


def landed_audit(files: DataFrame, as_of, backdays: int = 2, zone: str = LOCAL_ZONE) -> DataFrame:
    """Landed files since the start of the local day ``backdays`` days ago, with their times and the time of capture."""
    timed = landing_times(files, zone).where(F.col("dia_pty") >= _first_day(as_of, backdays, zone))
    return timed.withColumn("captured_at", as_literal(as_of)).select(LANDED_COLUMNS)


def reload_landed(spark: SparkSession, path: str, files: DataFrame, as_of, backdays: int = 2, zone: str = LOCAL_ZONE) -> None:
    """Replace the whole local days of the audit table that ``landed_audit`` covers."""
    first: date = spark.range(1).select(_first_day(as_of, backdays, zone)).first()[0]
    replace_range(spark, path, landed_audit(files, as_of, backdays, zone), "dia_pty", first)
