"""Zones and sampling points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.schemas import POINTS_DOCUMENT, ZONES


def read_points(spark: SparkSession, json_path: str, active_only: bool = False) -> DataFrame:
    """Sampling points from the configuration document; a point without a flag counts as active."""
    document = spark.read.schema(POINTS_DOCUMENT).json(json_path, multiLine=True)
    point = document.select(F.explode("puntos_muestreo").alias("p"))
    points = point.select(
        F.col("p.id").alias("punto_id"),
        "p.zona_id",
        "p.zona_nombre",
        "p.tipo_punto",
        "p.lat",
        F.col("p.lng").alias("lon"),
        "p.region",
        "p.provincias",
        F.coalesce(F.col("p.activo").try_cast("boolean"), F.lit(True)).alias("activo"),
    )
    return points.where("activo") if active_only else points


def zones_from_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Zones from literal rows (id, name, provinces, centre latitude, centre longitude)."""
    return spark.createDataFrame(rows, ZONES)


def with_bbox(
    zones: DataFrame,
    offset: float,
    overrides: DataFrame | None = None,
    key: str = "zona_id",
    lat: str = "lat_centro",
    lon: str = "lon_centro",
) -> DataFrame:
    """A rectangle around each zone centre; ``overrides`` (key and any of the four edges) replaces computed edges."""
    edges = {
        "lat_min": F.col(lat) - F.lit(offset),
        "lat_max": F.col(lat) + F.lit(offset),
        "lon_min": F.col(lon) - F.lit(offset),
        "lon_max": F.col(lon) + F.lit(offset),
    }
    if overrides is None:
        return zones.withColumns(edges)
    given = [edge for edge in edges if edge in overrides.columns]
    own = overrides.select(key, *[F.col(edge).alias(f"own_{edge}") for edge in given])
    joined = zones.join(own, key, "left")
    boxed = {
        edge: F.coalesce(F.col(f"own_{edge}"), value) if edge in given else value for edge, value in edges.items()
    }
    return joined.withColumns(boxed).drop(*[f"own_{edge}" for edge in given])


def invalid_boxes(zones: DataFrame) -> DataFrame:
    """Zones whose rectangle is empty or inverted."""
    return zones.where((F.col("lat_min") >= F.col("lat_max")) | (F.col("lon_min") >= F.col("lon_max")))
