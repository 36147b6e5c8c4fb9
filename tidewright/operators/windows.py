"""Time-series operators per key.

Ranking operators end in a bounded filter, which Spark applies in every task before the shuffle.
Row and time frames can be cut into slices (see ``timeline``); series at the zone-hour grain need no
cut, since a zone has at most one row per hour whatever the number of readings behind it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from tidewright.functions.scalars import epoch_seconds
from tidewright.operators.shape import in_horizon, join_null_safe
from tidewright.operators.timeline import CARRIED, SLICE, with_neighbours

HOUR = 3600


def _order(columns: list) -> list[Column]:
    return [c if isinstance(c, Column) else F.col(c) for c in columns]


def top_n(df: DataFrame, by: list[str], order: list, n: int) -> DataFrame:
    """The first n rows of each group in a total order."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*_order(order)))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def latest_per_key(df: DataFrame, keys: list[str], order: list[str], tiebreak: list[str] | None = None) -> DataFrame:
    """One row per key: the largest in ``order``; ties fall to the remaining columns, so the choice is repeatable."""
    if tiebreak is None:
        tiebreak = [c for c in df.columns if c not in keys and c not in order]
    return top_n(df, keys, [F.col(c).desc_nulls_last() for c in [*order, *tiebreak]], 1)


def pick_current(df: DataFrame, by: list[str], ts: str, as_of, hours: float, tiebreak: list[str] = ()) -> DataFrame:
    """First row of each group inside [as_of, as_of + hours)."""
    return top_n(in_horizon(df, ts, as_of, hours), by, [ts, *tiebreak], 1)


def best_run(
    df: DataFrame, by: list[str], run: str, ties: str = "all", tiebreak: list[str] | None = None
) -> DataFrame:
    """Rows of the newest run that has data for each group.

    ``ties="all"`` keeps every row of that run: the newest run per group is aggregated first and met
    by a join, so a group with a large share of the rows is never gathered in one task.
    ``ties="one"`` keeps a single row, chosen by the tie-break.
    """
    if ties == "one":
        return latest_per_key(df, by, [run], tiebreak)
    if ties != "all":
        raise ValueError(f"ties must be 'all' or 'one', not {ties!r}")
    newest = df.groupBy(*by).agg(F.max(run).alias(run))
    return df.join(newest, [*by, run], "left_semi")


def daily_amplitude(
    ext: DataFrame,
    by: list[str],
    ts: str,
    height: str,
    kind: str,
    out: str = "amplitud_dia_m",
) -> DataFrame:
    """Highest HIGH minus lowest LOW of each key and day, on every row of that day; NULL if either is absent."""
    dated = ext.withColumn("_day", F.to_date(ts))
    daily = dated.groupBy(*by, "_day").agg(
        F.max(F.when(F.col(kind).contains("HIGH"), F.col(height))).alias("_high"),
        F.min(F.when(F.col(kind).contains("LOW"), F.col(height))).alias("_low"),
    )
    span = daily.select(*by, "_day", F.abs(F.col("_high") - F.col("_low")).alias(out))
    return join_null_safe(dated, span, [*by, "_day"]).select(*ext.columns, out)


def _rows_window(
    df: DataFrame,
    by: list[str],
    order: list[str],
    values: list[str],
    slice_rows: int | None,
    before: int = 0,
    after: int = 0,
) -> tuple[DataFrame, WindowSpec]:
    """The frame and the ordered window to use: per key, or per slice with its neighbours."""
    if slice_rows is None:
        return df, Window.partitionBy(*by).orderBy(*order)
    cut = with_neighbours(df, by, order, values, slice_rows, before, after)
    return cut, Window.partitionBy(*by, SLICE).orderBy(*order)


def _own_rows(df: DataFrame) -> DataFrame:
    return df.where(~F.col(CARRIED)).drop(CARRIED, SLICE) if CARRIED in df.columns else df


def forward_sum(
    df: DataFrame,
    by: list[str],
    ts: str,
    col: str,
    n: int = 2,
    digits: int | None = 1,
    out: str = "forward_sum",
    tiebreak: list[str] = (),
    slice_rows: int | None = None,
    by_time: bool = False,
) -> DataFrame:
    """The row's value plus the next ``n`` rows, missing values counting as zero.

    With ``slice_rows`` the timelines are cut into slices of about that many rows, for keys that may hold more rows than
    a task should; ``ts`` and ``tiebreak`` must then be a total order within a key.
    ``by_time`` sums the next ``n`` hours instead, so that gaps in the series do not widen the frame.
    """
    value = F.coalesce(F.col(col).cast("double"), F.lit(0.0))
    if by_time:
        ahead = trailing_stats(df.withColumn("_value", value), by, ts, {out: ("_value", "sum", n * HOUR)}, forward=True)
        total = F.col(out)
        return ahead.withColumn(out, F.round(total, digits) if digits is not None else total).drop("_value")
    cut, order = _rows_window(df, by, [ts, *tiebreak], [col], slice_rows, after=n)
    total = F.sum(value).over(order.rowsBetween(0, n))
    return _own_rows(cut.withColumn(out, F.round(total, digits) if digits is not None else total))


def lags(
    df: DataFrame,
    by: list[str],
    ts: str,
    specs: dict[str, tuple[str, int]],
    tiebreak: list[str] = (),
    slice_rows: int | None = None,
) -> DataFrame:
    """Earlier values by row offset: ``{output: (column, rows back)}``; negative offsets look ahead.

    ``slice_rows`` as in ``forward_sum``.
    """
    back = max([0, *[n for _, n in specs.values()]])
    ahead = max([0, *[-n for _, n in specs.values()]])
    values = [c for c, _ in specs.values()]
    cut, order = _rows_window(df, by, [ts, *tiebreak], values, slice_rows, back, ahead)
    return _own_rows(cut.withColumns({out: F.lag(c, n).over(order) for out, (c, n) in specs.items()}))


def deltas(
    df: DataFrame,
    by: list[str],
    ts: str,
    cols: dict[str, str],
    n: int = 3,
    tiebreak: list[str] = (),
    slice_rows: int | None = None,
) -> DataFrame:
    """Change of each column against ``n`` rows earlier: ``{output: column}``."""
    specs = {f"_lag_{out}": (c, n) for out, c in cols.items()}
    lagged = lags(df, by, ts, specs, tiebreak, slice_rows)
    changed = lagged.withColumns({out: F.col(c) - F.col(f"_lag_{out}") for out, c in cols.items()})
    return changed.drop(*specs)


def verify_forward_sum(
    df: DataFrame,
    by: list[str],
    ts: str,
    col: str,
    total: str,
    n: int = 2,
    tolerance: float = 0.1,
    tiebreak: list[str] = (),
    slice_rows: int | None = None,
) -> DataFrame:
    """Recompute a stored forward sum from look-ahead values: MATCH or DIFF, and OK, NULL or ERROR against the row's own value."""
    specs = {f"_ahead_{k}": (col, -k) for k in range(1, n + 1)}
    seen = lags(df, by, ts, specs, tiebreak, slice_rows)
    expected = F.coalesce(F.col(col).cast("double"), F.lit(0.0))
    for name in specs:
        expected = expected + F.coalesce(F.col(name), F.lit(0.0))
    close = F.abs(F.col(total) - F.col("expected_sum")) < tolerance
    covers = F.col(total) >= F.col(col)
    checked = seen.withColumn("expected_sum", expected).withColumns(
        {
            "sum_check": F.when(close, "MATCH").otherwise("DIFF"),
            "value_check": F.when(covers, "OK")
            .when(F.col(total).isNull() & F.col(col).isNull(), "NULL")
            .otherwise("ERROR"),
        }
    )
    return checked.drop(*specs)


# Running pieces that a trailing statistic is assembled from.
_PIECES = {
    "mean": ("n", "sum"),
    "sum": ("n", "sum"),
    "max": ("max",),
    "min": ("min",),
    "std": ("n", "mean", "var"),
}


def _running(piece: str, value: Column, frame: WindowSpec) -> Column:
    if piece == "n":
        return F.count(value).over(frame)
    if piece == "sum":
        return F.sum(value).over(frame)
    if piece == "mean":
        return F.avg(value).over(frame)
    if piece == "var":
        return F.var_pop(value).over(frame)
    return (F.max if piece == "max" else F.min)(value).over(frame)


def _combine(stat: str, a: dict[str, Column], b: dict[str, Column]) -> Column:
    """One statistic over two disjoint row sets from the pieces of each."""
    if stat == "max":
        return F.greatest(a["max"], b["max"])
    if stat == "min":
        return F.least(a["min"], b["min"])
    zero = F.lit(0.0)
    n = a["n"] + b["n"]
    if stat in ("sum", "mean"):
        total = F.coalesce(a["sum"], zero) + F.coalesce(b["sum"], zero)
        return F.when(n > 0, total if stat == "sum" else total / n)
    gap = F.when((a["n"] > 0) & (b["n"] > 0), b["mean"] - a["mean"]).otherwise(zero)
    spread = (
        F.coalesce(a["var"], zero) * a["n"]
        + F.coalesce(b["var"], zero) * b["n"]
        + gap * gap * a["n"] * b["n"] / n
    )
    return F.when(n > 1, F.sqrt(spread / (n - 1)))


_FIGURES = {"mean": F.avg, "sum": F.sum, "max": F.max, "min": F.min, "std": F.stddev_samp}


def trailing_stats(
    df: DataFrame,
    by: list[str],
    ts: str,
    specs: dict[str, tuple[str, str, int]],
    forward: bool = False,
    collapse: bool = False,
) -> DataFrame:
    """Statistics over trailing time frames, both ends included: ``{output: (column, statistic, seconds)}``.

    Statistics are mean, sum, max, min and std (sample); ``forward`` looks ahead instead of back. All frame lengths share
    one shuffle and one sort per key. Rows without a time are one another's peers.

    ``collapse`` is for raw readings with many rows per key and second, whose keys no task should hold: they are
    combined per second before the shuffle, the frames run over at most one row per second in blocks of the frame's
    length, and the figures are joined back.
    """
    if collapse:
        return _trailing_collapsed(df, by, ts, specs, forward)
    order = Window.partitionBy(*by).orderBy(epoch_seconds(ts))

    def frame(seconds: int) -> WindowSpec:
        return order.rangeBetween(0, seconds) if forward else order.rangeBetween(-seconds, 0)

    return df.withColumns({out: _FIGURES[stat](c).over(frame(seconds)) for out, (c, stat, seconds) in specs.items()})


def _trailing_blocks(
    df: DataFrame, by: list[str], ts: str, specs: dict[str, tuple[str, str, int]], forward: bool
) -> DataFrame:
    """Trailing frames over many rows of a key, without holding the key in one task.

    Time is cut into blocks as long as the frame, so a frame always covers the end of one block and the start of the
    next. Each block receives its own rows and, moved by the frame length, the rows of the block before it: the part in
    the same block is then a running figure read forwards, the part in the earlier block a running figure read
    backwards. Both are single passes, and no task holds more than two frame lengths of a key.
    """
    widths = sorted({seconds for _, _, seconds in specs.values()}, reverse=True)
    widest = widths[0]
    columns = list(dict.fromkeys(c for c, _, _ in specs.values()))

    position = -epoch_seconds(ts) if forward else epoch_seconds(ts)
    # One pass over the input: the row itself and one moved copy per frame length. Copies only carry
    # the keys and the measured columns.
    carried = {*by, *columns}
    line = df.withColumn("_copy", F.explode(F.array(*[F.lit(w) for w in (0, *widths)])))
    line = line.select(
        *[F.col(c) if c in carried else F.when(F.col("_copy") == 0, F.col(c)).alias(c) for c in df.columns],
        "_copy",
        (position + F.col("_copy")).alias("_pos"),
    )
    # Rows without a time are one another's peers; they have no block before them to be moved to.
    line = line.where((F.col("_copy") == 0) | F.col("_pos").isNotNull())
    line = line.withColumn("_block", F.floor(F.col("_pos") / widest))

    pieces: dict[str, Column] = {}
    results: dict[str, Column] = {}
    for width in widths:
        group = [*by, "_block"]
        if width != widest:
            line = line.withColumn(f"_block_{width}", F.floor(F.col("_pos") / width))
            # Blocks that nest in the widest ones reuse its shuffle.
            group = [*(group if widest % width == 0 else by), f"_block_{width}"]
        window = Window.partitionBy(*group)
        sides = {
            "near": (0, window.orderBy("_pos").rangeBetween(Window.unboundedPreceding, 0)),
            "far": (width, window.orderBy(F.col("_pos").desc()).rangeBetween(Window.unboundedPreceding, 0)),
        }
        for out, (column, stat, seconds) in specs.items():
            if seconds != width:
                continue
            parts = {}
            for side, (copy, frame) in sides.items():
                value = F.when(F.col("_copy") == copy, F.col(column))
                names = {p: f"_{side}_{p}_{column}_{width}" for p in _PIECES[stat]}
                for piece, name in names.items():
                    if name not in pieces:
                        pieces[name] = _running(piece, value, frame)
                parts[side] = {p: F.col(name) for p, name in names.items()}
            results[out] = _combine(stat, parts["far"], parts["near"])

    ran = line.withColumns(pieces).where(F.col("_copy") == 0)
    return ran.withColumns(results).select(*df.columns, *results)


def _trailing_collapsed(
    df: DataFrame, by: list[str], ts: str, specs: dict[str, tuple[str, str, int]], forward: bool
) -> DataFrame:
    columns = list(dict.fromkeys(c for c, _, _ in specs.values()))
    # Deviations are taken from the overall mean, which keeps the squares small.
    centre = {c: df.select(F.avg(c)).scalar() for c, stat, _ in specs.values() if stat == "std"}
    partial = []
    for c in columns:
        partial += [F.count(c).alias(f"_n_{c}"), F.sum(c).alias(f"_s_{c}"), F.max(c).alias(f"_x_{c}"), F.min(c).alias(f"_i_{c}")]
        if c in centre:
            off = F.col(c) - centre[c]
            partial += [F.sum(off).alias(f"_d_{c}"), F.sum(off * off).alias(f"_q_{c}")]
    seconds = df.groupBy(*by, F.date_trunc("second", F.col(ts)).alias("_second")).agg(*partial)

    needed = {"mean": "ns", "sum": "s", "max": "x", "min": "i", "std": "ndq"}
    how = {"n": "sum", "s": "sum", "x": "max", "i": "min", "d": "sum", "q": "sum"}
    wanted = {
        f"_{piece}_{c}_{width}": (f"_{piece}_{c}", how[piece], width)
        for c, stat, width in specs.values()
        for piece in needed[stat]
    }
    ran = _trailing_blocks(seconds, by, "_second", wanted, forward)

    def figure(c: str, stat: str, width: int) -> Column:
        part = {piece: F.col(f"_{piece}_{c}_{width}") for piece in needed[stat]}
        if stat == "mean":
            return F.when(part["n"] > 0, part["s"] / part["n"])
        if stat == "std":
            square = F.greatest(part["q"] - part["d"] * part["d"] / part["n"], F.lit(0.0))
            return F.when(part["n"] > 1, F.sqrt(square / (part["n"] - 1)))
        return part[needed[stat]]

    settled = ran.select(*by, "_second", *[figure(*spec).alias(out) for out, spec in specs.items()])
    timed = df.withColumn("_second", F.date_trunc("second", F.col(ts)))
    return join_null_safe(timed, settled, [*by, "_second"]).select(*df.columns, *specs)
