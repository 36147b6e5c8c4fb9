"""Joins of readings, events, zones and expected keys.

No join here is forced to broadcast: Spark compares sizes with ``spark.sql.autoBroadcastJoinThreshold``
(statically, and again at run time with adaptive execution) and falls back to a shuffled join that
adaptive execution can split when a key is hot.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from tidewright.functions.scalars import hours_between
from tidewright.operators.timeline import SLICE, slice_of

HOUR = 3_600


FEED = "_feed"


def stack_feeds(feeds: dict[str, DataFrame]) -> DataFrame:
    """The rows of all feeds under one another, with the name of their feed."""
    tagged = [rows.withColumn(FEED, F.lit(name)) for name, rows in feeds.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def integrate_stack(
    stacked: DataFrame, keys: list[str], figures: dict[str, dict[str, tuple[Callable, str]]], feed: str = FEED
) -> DataFrame:
    """Every key that occurs in any feed, with the figures of each: ``{feed: {output: (aggregate, column)}}``.

    The rows of all feeds are stacked, so one aggregate by key makes universe and integration in one shuffle, whatever
    the number of feeds; rows are combined in the tasks first. An aggregate sees the rows of its own feed alone.
    """
    own = lambda name, c: F.when(F.col(feed) == name, F.col(c))
    aggregates = [f(own(name, c)).alias(out) for name, wanted in figures.items() for out, (f, c) in wanted.items()]
    return stacked.where(F.col(feed).isin(*figures)).groupBy(*keys).agg(*aggregates)


def integrate(universe: DataFrame, feeds: list[DataFrame], keys: list[str]) -> DataFrame:
    """Every key of the universe with the columns of each feed; a feed holds at most one row per key.

    Universe and feeds are stacked and met by one aggregate, without joins. Keys with a NULL meet no feed.
    """
    known = universe.select(*keys).distinct().withColumn("_known", F.lit(True))
    met = _stacked([known, *[f.where(_whole(keys)) for f in feeds]], keys, apart=False)
    return met.where("_known").select(*keys, *[c for f in feeds for c in f.columns if c not in keys])


def integrate_all(feeds: list[DataFrame], keys: list[str]) -> DataFrame:
    """Every key that occurs in any feed, with the columns of each; a feed holds at most one row per key.

    One aggregate over the stacked feeds, which reads each once. A row with a NULL in its key stays alone.
    """
    return _stacked(feeds, keys, apart=True).select(*keys, *[c for f in feeds for c in f.columns if c not in keys])


def _whole(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _stacked(frames: list[DataFrame], keys: list[str], apart: bool) -> DataFrame:
    tagged = [f.withColumn(FEED, F.when(_whole(keys), F.lit(-1)).otherwise(F.lit(i if apart else -1))) for i, f in enumerate(frames)]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    rest = [c for c in stacked.columns if c not in keys and c != FEED]
    return stacked.groupBy(*keys, FEED).agg(*[F.first(c, ignorenulls=True).alias(c) for c in rest])


def join_daily(hourly: DataFrame, daily: DataFrame, key: str, ts: str, day: str) -> DataFrame:
    """Spread one value per key and day over all hours of that day."""
    at_day = hourly.withColumn(day, F.to_date(ts))
    return at_day.join(daily, [key, day], "left").drop(day)


def missing_keys(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """Expected rows whose key never occurs in ``actual``."""
    present = actual.select(*keys).distinct()
    return expected.join(present, keys, "left_anti")


def orphans(fact: DataFrame, dim: DataFrame, fk: str, pk: str | None = None) -> DataFrame:
    """Foreign keys without a dimension row, with the number of fact rows that use each."""
    used = fact.groupBy(fk).agg(F.count(F.lit(1)).alias("n"))
    known = dim.select(F.col(pk or fk).alias(fk)).distinct()
    return used.join(known, fk, "left_anti")


def next_event(
    left: DataFrame,
    right: DataFrame,
    by: list[str],
    left_ts: str,
    right_ts: str,
    cols: list[str],
    slice_seconds: int | None = HOUR,
    hours: str = "hours_to_event",
) -> DataFrame:
    """Each reading with the nearest strictly later event of the same key; readings without one keep NULLs.

    The answer depends on key and time only, so it is settled once per distinct instant and joined
    back: copies of a reading or an event, however many, are combined before the shuffle, and a hot join
    key is split by adaptive execution. Instants and events are laid on one timeline, sorted backwards, and
    the last event seen so far is taken, without any row blow-up. At equal times the instant sorts
    first, so it never meets that event. The timeline is cut into slices; an event that lies beyond
    a slice comes from a summary of one row per slice. Events that tie on time are resolved by the smallest ``cols``.

    ``slice_seconds=None`` is for keys whose groups are small by construction, such as one forecast
    run of one point without duplicates: readings and events are then read once and sorted once.
    """
    key_known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in by])
    event_row = F.struct(F.col(right_ts).alias("at"), *[F.col(c).alias(c) for c in cols])
    known_events = right.where(key_known & F.col(right_ts).isNotNull()).select(*by, right_ts, *cols).distinct()

    def with_answer(rows: DataFrame) -> DataFrame:
        return rows.select(
            *left.columns,
            F.col("_next.at").alias(right_ts if right_ts not in left.columns else f"next_{right_ts}"),
            *[F.col("_next")[c].alias(c if c not in left.columns else f"next_{c}") for c in cols],
            hours_between(F.col(left_ts), F.col("_next.at")).alias(hours),
        )

    if slice_seconds is None:
        readings = left.withColumns({"_at": F.col(left_ts), "_is_event": F.lit(0)})
        events = known_events.select(
            *by, F.col(right_ts).alias("_at"), F.lit(1).alias("_is_event"), event_row.alias("_event")
        )
        timeline = readings.unionByName(events, allowMissingColumns=True)
        last_seen = F.last("_event", ignorenulls=True).over(_backwards(by))
        seen = timeline.withColumn("_next", F.when(F.col("_at").isNotNull(), last_seen))
        return with_answer(seen.where(F.col("_is_event") == 0))

    # Distinct instants and events on one tagged line. It is dealt by key and slice once; the heads of slices and the
    # answers inside them both come from there.
    instants = left.where(key_known & F.col(left_ts).isNotNull()).select(*by, F.col(left_ts).alias("_at")).distinct()
    marks = known_events.select(*by, F.col(right_ts).alias("_at"), F.lit(1).alias("_is_event"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(cols)])
    line = instants.withColumn("_is_event", F.lit(0)).unionByName(marks, allowMissingColumns=True)
    dealt = line.withColumn(SLICE, slice_of("_at", slice_seconds)).repartition(*by, SLICE)
    mark = F.when(F.col("_is_event") == 1, F.struct(F.col("_at").alias("at"), *[F.col(f"_{i}").alias(c) for i, c in enumerate(cols)]))

    # Heads: one row per key and slice with its first event; what comes later is carried backwards over them.
    heads = dealt.groupBy(*by, SLICE).agg(F.min(mark).alias("_head"))
    later = Window.partitionBy(*by).orderBy(F.col(SLICE).desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = heads.withColumn("_carry", F.last("_head", ignorenulls=True).over(later)).drop("_head")

    inside = dealt.withColumn("_event", mark)
    inside = inside.withColumn("_next", F.last("_event", ignorenulls=True).over(_backwards([*by, SLICE])))
    settled = inside.where("_is_event = 0").join(carried, [*by, SLICE], "left").select(
        *by, F.col("_at").alias(left_ts), F.coalesce("_next", "_carry").alias("_next")
    )
    return with_answer(left.join(settled, [*by, left_ts], "left"))


def _backwards(group: list[str]) -> WindowSpec:
    """From the latest row to the earliest, up to the row before; at equal times readings come before events."""
    order = [F.col("_at").desc(), F.col("_is_event"), F.col("_event").desc()]
    return Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def assign_zone(
    points: DataFrame,
    zones: DataFrame,
    lat: str,
    lon: str,
    cell: float = 0.5,
    keep: list[str] | None = None,
) -> DataFrame:
    """Points with every zone rectangle they fall into (edges included); overlapping zones give several rows.

    Rectangles are laid out on a grid of ``cell`` degrees and met by an equi-join on the cell, so the
    work per point depends on the zones near it and not on the number of zones.
    """

    def cells(low: str, high: str):
        return F.explode(F.sequence(F.floor(F.col(low) / cell), F.floor(F.col(high) / cell)))

    kept = keep if keep is not None else ["zona_id"]
    laid_out = (
        zones.select(*kept, "lat_min", "lat_max", "lon_min", "lon_max")
        .withColumn("_cell_lat", cells("lat_min", "lat_max"))
        .withColumn("_cell_lon", cells("lon_min", "lon_max"))
    )
    placed = points.withColumns(
        {"_cell_lat": F.floor(F.col(lat) / cell), "_cell_lon": F.floor(F.col(lon) / cell)}
    )
    inside = F.col(lat).between(F.col("lat_min"), F.col("lat_max")) & F.col(lon).between(
        F.col("lon_min"), F.col("lon_max")
    )
    met = placed.join(laid_out, ["_cell_lat", "_cell_lon"]).where(inside)
    return met.select(*points.columns, *kept)


def assign_band(
    df: DataFrame,
    bands: DataFrame,
    value: str,
    low: str,
    high: str,
    cell: float,
    keep: list[str],
) -> DataFrame:
    """The same in one dimension: rows with every band [low, high] that contains their value."""
    edges = F.sequence(F.floor(F.col(low) / cell), F.floor(F.col(high) / cell))
    laid_out = bands.select(*keep, low, high).withColumn("_cell", F.explode(edges))
    placed = df.withColumn("_cell", F.floor(F.col(value) / cell))
    met = placed.join(laid_out, "_cell").where(F.col(value).between(F.col(low), F.col(high)))
    return met.select(*df.columns, *keep)
