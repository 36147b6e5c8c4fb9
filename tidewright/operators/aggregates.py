"""Grouped figures. All of them combine inside each task before the shuffle, so hot groups arrive as partial sums."""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewright.functions.risk import LEVELS
from tidewright.functions.scalars import epoch_seconds, truncate

HOURS_OF_DAY = [f"{h:02d}" for h in range(24)]


def agg_zone_hour(
    df: DataFrame,
    metrics: list[str],
    keys: list[str],
    point: str,
    run: str,
    points_out: str = "stormglass_n_puntos",
    run_out: str = "stormglass_run_ts",
) -> DataFrame:
    """Mean of each metric over the points of a zone and hour, with the number of points and the newest run."""
    means = [F.avg(m).alias(m) for m in metrics]
    return df.groupBy(*keys).agg(
        *means, F.countDistinct(point).alias(points_out), F.max(run).alias(run_out)
    )


def agg_tide_hour(
    df: DataFrame,
    zone: str,
    ts: str,
    height: str,
    kind: str,
    run: str,
    rows_out: str = "marea_n_puntos",
    run_out: str = "marea_run_ts",
) -> DataFrame:
    """Tide series brought to the hour: mean height, the kind of next extreme at the earliest reading that
    knows one (ties: the smallest), row count and newest run."""
    hourly = df.withColumn("_hour", truncate(df, ts))
    first_kind = F.min(F.when(F.col(kind).isNotNull(), F.struct(F.col(ts).alias("at"), F.col(kind).alias("kind"))))
    grouped = hourly.groupBy(zone, "_hour").agg(
        F.avg(height).alias(height),
        first_kind["kind"].alias(kind),
        F.count(F.lit(1)).alias(rows_out),
        F.max(run).alias(run_out),
    )
    return grouped.withColumnRenamed("_hour", ts)


def agg_grid(
    df: DataFrame,
    keys: list[str],
    values: list[str],
    run: str,
    cells_out: str = "copernicus_n_grillas",
    run_out: str = "copernicus_run_ts",
) -> DataFrame:
    """Mean of each ocean value over the cells of a zone and hour or day, with cell count and newest run."""
    means = [F.avg(v).alias(v) for v in values]
    return df.groupBy(*keys).agg(*means, F.count(F.lit(1)).alias(cells_out), F.max(run).alias(run_out))


def consolidate(df: DataFrame, keys: list[str], values: dict[str, str]) -> DataFrame:
    """One row per grid key from rows that each carry one variable: ``{input: output}``."""
    return df.groupBy(*keys).agg(*[F.max(v).alias(out) for v, out in values.items()])


def coverage(df: DataFrame, by: list[str], ts: str) -> DataFrame:
    """First and last reading, number of readings and hours spanned per key."""
    figures = df.where(F.col(ts).isNotNull()).groupBy(*by).agg(
        F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"), F.count(F.lit(1)).alias("n_points")
    )
    span = (epoch_seconds("max_ts") - epoch_seconds("min_ts")) / F.lit(3600.0)
    return figures.withColumn("range_hours", span)


def summary(frames: dict[str, tuple[DataFrame, dict[str, str]]]) -> DataFrame:
    """One row per table: rows, distinct zones and points, first and last time and run.

    Each table is given with the columns that play ``zone``, ``point``, ``ts`` and ``run``. Rows are
    combined per zone and point first, so the distinct counts run over a small intermediate.
    """

    def one(name: str, df: DataFrame, roles: dict[str, str]) -> DataFrame:
        parts = df.groupBy(F.col(roles["zone"]).alias("zone"), F.col(roles["point"]).alias("point")).agg(
            F.count(F.lit(1)).alias("n"),
            F.min(roles["ts"]).alias("min_ts"),
            F.max(roles["ts"]).alias("max_ts"),
            F.min(roles["run"]).alias("min_run"),
            F.max(roles["run"]).alias("max_run"),
        )
        return parts.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.countDistinct("zone").alias("n_zones"),
            F.countDistinct("point").alias("n_points"),
            F.min("min_ts").alias("min_ts"),
            F.max("max_ts").alias("max_ts"),
            F.min("min_run").alias("min_run"),
            F.max("max_run").alias("max_run"),
        ).select(F.lit(name).alias("table_name"), "*")

    return reduce(DataFrame.unionByName, [one(name, df, roles) for name, (df, roles) in frames.items()])


def completeness(df: DataFrame, cols: list[str], by: list[str] | None = None) -> DataFrame:
    """Rows in total and rows with a value, per column; for the whole table or per group."""
    counts = [F.count(F.lit(1)).alias("total"), *[F.count(c).alias(f"with_{c}") for c in cols]]
    return df.groupBy(*(by or [])).agg(*counts)


def coverage_pct(df: DataFrame, col: str, ts: str) -> DataFrame:
    """Share of rows with a value per date and hour, as a percentage with one decimal."""
    grouped = df.groupBy(F.to_date(ts).alias("fecha"), F.hour(ts).alias("hora_utc")).agg(
        F.count(F.lit(1)).alias("total_rows"), F.count(col).alias("rows_with_value")
    )
    share = F.round(F.col("rows_with_value") * F.lit(100.0) / F.col("total_rows"), 1)
    return grouped.withColumn("pct_with_value", share)


def risk_by_zone(
    pred: DataFrame,
    zone: str = "zona_id",
    score: str = "risk_score_pred",
    level: str = "safety_level_pred",
    run: str = "prediction_ts",
) -> DataFrame:
    """Hours per safety level and rounded score figures per zone, for the newest scoring run, riskiest first."""
    newest = pred.select(F.max(run).alias("newest")).scalar()
    hours = [F.count_if(F.col(level) == label).alias(f"hours_{name}") for name, label in LEVELS.items()]
    return (
        pred.where(F.col(run) == newest)
        .groupBy(zone)
        .agg(
            F.count(F.lit(1)).alias("hours_predicted"),
            F.round(F.avg(score), 2).alias("avg_risk_pred"),
            F.round(F.min(score), 2).alias("min_risk_pred"),
            F.round(F.max(score), 2).alias("max_risk_pred"),
            *hours,
        )
        .orderBy(F.col("avg_risk_pred").desc(), zone)
    )


def distribution(df: DataFrame, by: list[str], metric: str | None = None, digits: int = 2) -> DataFrame:
    """Rows per label, with the rounded mean, minimum and maximum of a metric when one is given."""
    figures = [F.count(F.lit(1)).alias("n")]
    if metric is not None:
        figures += [
            F.round(f(metric), digits).alias(f"{name}_{metric}")
            for name, f in (("avg", F.avg), ("min", F.min), ("max", F.max))
        ]
    return df.groupBy(*by).agg(*figures)


def describe_cols(df: DataFrame, cols: list[str], ts: str | None = None, run: str | None = None) -> DataFrame:
    """One row of mean, sample deviation, minimum and maximum per column, the days covered and the forecast horizon."""
    figures: list[Column] = [F.count(F.lit(1)).alias("n")]
    for c in cols:
        figures += [
            F.avg(c).alias(f"{c}_mean"),
            F.stddev_samp(c).alias(f"{c}_std"),
            F.min(c).alias(f"{c}_min"),
            F.max(c).alias(f"{c}_max"),
        ]
    if ts is not None:
        figures.append(F.datediff(F.max(ts), F.min(ts)).alias("days_covered"))
        if run is not None:
            figures.append(horizon_hours(ts, run).alias("horizon_hours"))
    return df.agg(*figures)


def horizon_hours(ts: str, run: str) -> Column:
    """Hours from the earliest run to the last forecast moment, as an aggregate."""
    return (epoch_seconds(F.max(ts)) - epoch_seconds(F.min(run))) / F.lit(3600.0)


#: Accuracy of the sketches that bracket a rank, and the share by which a bracket is widened on both sides.
ACCURACY = 10_000
MARGIN = 3.0 / ACCURACY

#: Rows that a bracket may hold before its values are settled; wider ones are narrowed by further sketches.
MOST_INSIDE = 1 << 21


@dataclass
class _Bracket:
    """Two neighbouring ranks of a column, and values between which both lie."""

    column: str
    low_rank: int
    high_rank: int
    low: object
    high: object


def _sketch(df: DataFrame, wanted: list[tuple[Column, list[float]]]) -> Row:
    """One aggregate for any number of values: count, least, greatest and the values near the shares, by position."""
    figures = []
    for i, (value, shares) in enumerate(wanted):
        figures += [
            F.count(value).alias(f"n{i}"), F.min(value).alias(f"least{i}"), F.max(value).alias(f"most{i}"),
            F.percentile_approx(value, [min(1.0, max(0.0, s)) for s in shares], ACCURACY).alias(f"q{i}"),
        ]
    return df.agg(*figures).first()


def _narrowed(df: DataFrame, brackets: list[_Bracket], inside: int) -> list[_Bracket]:
    """Brackets whose sketches see only what lies inside the former ones."""
    while inside > MOST_INSIDE:
        values = [F.when(F.col(b.column).between(F.lit(b.low), F.lit(b.high)), F.col(b.column)) for b in brackets]
        counted = df.agg(
            *[F.count_if(F.col(b.column) < F.lit(b.low)).alias(f"b{i}") for i, b in enumerate(brackets)],
            *[F.count(v).alias(f"n{i}") for i, v in enumerate(values)],
        ).first()
        if max(counted[f"n{i}"] for i in range(len(brackets))) <= MOST_INSIDE:
            break
        place = lambda i, k: (k - counted[f"b{i}"]) / counted[f"n{i}"]
        found = _sketch(df, [(v, [place(i, b.low_rank) - 2 * MARGIN, place(i, b.high_rank) + 2 * MARGIN]) for i, (b, v) in enumerate(zip(brackets, values))])
        closer = [replace(b, low=found[f"q{i}"][0], high=found[f"q{i}"][1]) for i, b in enumerate(brackets)]
        if closer == brackets:
            break  # the bracket is a single value or a few
        brackets, inside = closer, int(max(counted[f"n{i}"] for i in range(len(brackets))) * 5 * MARGIN)
    return brackets


def _settled(df: DataFrame, brackets: list[_Bracket]) -> DataFrame:
    """(i, low, high): the exact values at both ranks of each bracket, by one pass over the table.

    Rows below a bracket are only counted; inside it equal values are counted together in the tasks, so a bracket's
    window has one row per distinct value of a sliver of the table.
    """
    members = []
    for i, b in enumerate(brackets):
        v = F.col(b.column)
        kept = F.struct(F.lit(i).alias("i"), v.alias("v"))
        below = F.struct(F.lit(i).alias("i"), F.when(F.lit(False), v).alias("v"))
        members.append(F.when(v < F.lit(b.low), below).when(v <= F.lit(b.high), kept))
    rows = df.select(F.explode(F.array_compact(F.array(*members))).alias("m"))
    counted = rows.groupBy(F.col("m.i").alias("i"), F.col("m.v").alias("v")).agg(F.count(F.lit(1)).alias("c"))
    upto = F.sum("c").over(Window.partitionBy("i").orderBy(F.asc_nulls_first("v")).rowsBetween(Window.unboundedPreceding, 0))
    ranked = counted.withColumn("last", upto - 1).withColumn("first", F.col("last") - F.col("c") + 1)

    def at(ranks: list[int]) -> Column:
        k = F.element_at(F.lit(ranks), F.col("i") + 1)
        return F.max(F.when(k.between(F.col("first"), F.col("last")), F.col("v")))

    return ranked.groupBy("i").agg(at([b.low_rank for b in brackets]).alias("low"), at([b.high_rank for b in brackets]).alias("high"))


def _numbers(df: DataFrame, cols: list[str]) -> DataFrame:
    """The columns as numbers of one type; timestamps as microseconds."""
    times = {c for c in cols if df.schema[c].dataType.typeName().startswith("timestamp")}
    kinds = {df.schema[c].dataType.simpleString() for c in cols if c not in times} | ({"bigint"} if times else set())
    value = lambda c: F.unix_micros(F.col(c).cast("timestamp")) if c in times else F.col(c)
    return df.select(*[(value(c) if len(kinds) == 1 else value(c).cast("double")).alias(c) for c in cols])


def values_at_ranks(df: DataFrame, col: str, ranks: list[int]) -> DataFrame:
    """Exact order statistics: one row (rank, value) per 0-based rank, missing values left out.

    An approximate sketch brackets each wanted rank to a sliver of the data, and the rank is settled on the distinct
    values inside it. No task sorts or holds the whole column. Timestamps are returned as microseconds.
    """
    data = _numbers(df, [col])
    n = data.agg(F.count(col)).first()[0]
    if not n or max(ranks) >= n or min(ranks) < 0:
        raise ValueError(f"ranks {ranks} asked of {n} values of {col}")
    edges = [(r / n - MARGIN, (r + 1) / n + MARGIN) for r in ranks]
    found = _sketch(data, [(F.col(col), [share for pair in edges for share in pair])])
    brackets = [_opened(found, 0, j, col, r, r, *edges[j]) for j, r in enumerate(ranks)]
    settled = _settled(data, _narrowed(data, brackets, int(5 * MARGIN * n)))
    rank = F.element_at(F.lit(ranks), F.col("i") + 1).cast("bigint")
    return settled.select(rank.alias("rank"), F.coalesce("low", _missed(col, settled)).alias("value"))


def _opened(found: Row, i: int, j: int, col: str, low_rank: int, high_rank: int, start: float, end: float) -> _Bracket:
    """The j-th bracket of a sketched value; a share beyond either end reaches to the least or greatest value."""
    low = found[f"least{i}"] if start <= 0 else found[f"q{i}"][2 * j]
    high = found[f"most{i}"] if end >= 1 else found[f"q{i}"][2 * j + 1]
    return _Bracket(col, low_rank, high_rank, low, high)


def _missed(what: str, settled: DataFrame) -> Column:
    return F.raise_error(F.lit(f"a rank of {what} lies outside its bracket")).cast(settled.schema["low"].dataType)


def quartiles(df: DataFrame, cols: list[str], shares: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Exact quartiles of each column, interpolated linearly; one row per column and share.

    Two passes for all columns together: one sketch aggregate when this is called, and one over the brackets' values. A
    column without values has no rows.
    """
    data = _numbers(df, cols)
    found = _sketch(data, [(F.col(c), [x for s in shares for x in (s - 2 * MARGIN, s + 2 * MARGIN)]) for c in cols])
    brackets, places, most = [], [], 0
    for i, c, j, s in [(i, c, j, s) for i, c in enumerate(cols) for j, s in enumerate(shares)]:
        n = found[f"n{i}"]
        if not n:
            continue
        # Of few values the place of a share is not as near to it as the margin; they are all inside.
        few = n * MARGIN < 1
        place = s * (n - 1)
        start, end = (0.0, 1.0) if few else (s - 2 * MARGIN, s + 2 * MARGIN)
        brackets.append(_opened(found, i, j, c, math.floor(place), math.ceil(place), start, end))
        places.append((len(places), c, s, place % 1))
        most = max(most, int(5 * MARGIN * n))
    schema = "i int, column_name string, share double, part double"
    wanted = df.sparkSession.createDataFrame(places, schema)
    if not brackets:
        return wanted.select("column_name", "share", F.lit(None).cast("double").alias("value"))
    settled = _settled(data, _narrowed(data, brackets, most))
    low, high = (F.coalesce(x, _missed(", ".join(cols), settled)) for x in ("low", "high"))
    value = low + (high - low) * F.col("part")
    return settled.join(wanted, "i").select("column_name", "share", value.cast("double").alias("value"))


def count_if_by(df: DataFrame, by: list[str], condition: Column, out: str = "n_match") -> DataFrame:
    """Rows per group and how many of them satisfy a condition."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_if(condition).alias(out))


def landing_matrix(
    landed: DataFrame,
    keys: list[str],
    hour: str = "hora_pty",
    hours: list[str] | None = None,
    prefix: str = "",
    drop_empty: bool = False,
) -> DataFrame:
    """Files per key with one column per hour of day, zero where none arrived.

    ``drop_empty`` leaves out hours without any file; one aggregate over all hours decides that.
    """
    hours = hours if hours is not None else HOURS_OF_DAY
    pivoted = landed.groupBy(*keys).agg(
        *[F.count_if(F.col(hour) == h).alias(f"{prefix}{h}") for h in hours]
    )
    if not drop_empty:
        return pivoted
    names = [f"{prefix}{h}" for h in hours]
    busiest = pivoted.agg(*[F.max(F.col(f"`{name}`")).alias(name) for name in names]).first().asDict()
    return pivoted.select(*keys, *[F.col(f"`{name}`") for name in names if busiest[name]])


def landing_daily(landed: DataFrame, day: str = "dia_pty") -> DataFrame:
    """Files per source, variant and local day."""
    return landed.groupBy("source", "variante", day).agg(F.count(F.lit(1)).alias("n_files"))


def landing_latest(landed: DataFrame, written: str = "written_pty") -> DataFrame:
    """Latest arrival per source and variant."""
    return landed.groupBy("source", "variante").agg(F.max(written).alias("last_written_pty"))


def mae_vs_baseline(pred: DataFrame, actual: str, predicted: str, digits: int = 2) -> DataFrame:
    """Mean absolute error of the model and of always predicting the mean."""
    mean = pred.select(F.avg(actual).alias("m")).scalar()
    return pred.agg(
        F.round(F.avg(F.abs(F.col(predicted) - F.col(actual))), digits).alias("mae_model"),
        F.round(F.avg(F.abs(F.col(actual) - mean)), digits).alias("mae_baseline"),
    )
