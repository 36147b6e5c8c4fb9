"""Zone and point dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions.scalars import as_literal
from tidewright.operators.joins import orphans
from tidewright.operators.quality import require_none
from tidewright.sources.reference import invalid_boxes, with_bbox

# Fixed value: half the side of a standard zone rectangle, in degrees.
ZONE_OFFSET = 0.25


def dim_zones(
    zones: DataFrame,
    as_of,
    offset: float = ZONE_OFFSET,
    overrides: DataFrame | None = None,
    geometry: str = "copernicus_bbox",
    check: bool = True,
) -> DataFrame:
    """Zones with their rectangles; an empty or inverted rectangle is an error."""
    boxed = with_bbox(zones, offset, overrides)
    if check:
        require_none(invalid_boxes(boxed), "invalid zone rectangles")
    return boxed.select(
        "zona_id", "zona_nombre", "provincias", "lat_centro", "lon_centro",
        "lat_min", "lat_max", "lon_min", "lon_max",
        F.lit(geometry).alias("fuente_geometria"),
        F.lit(True).alias("activo"),
        as_literal(as_of).alias("updated_at"),
    )


def dim_points(points: DataFrame, as_of, zones: DataFrame | None = None, check: bool = True) -> DataFrame:
    """Sampling points with complete keys; with ``zones`` given, every point must belong to a known zone."""
    if check:
        require_none(points.where(F.col("punto_id").isNull() | F.col("zona_id").isNull()), "points without keys")
        if zones is not None:
            require_none(orphans(points, zones, "zona_id"), "points of unknown zones")
    return points.withColumn("updated_at", as_literal(as_of))
