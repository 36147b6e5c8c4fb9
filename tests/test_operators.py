"""Operators on small frames, against plain Python where the result is not obvious."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewright.operators.aggregates import (
    agg_tide_hour,
    agg_zone_hour,
    completeness,
    consolidate,
    coverage_pct,
    landing_matrix,
    mae_vs_baseline,
    quartiles,
    risk_by_zone,
    summary,
    values_at_ranks,
)
from tidewright.operators.joins import assign_band, assign_zone, integrate, join_daily, missing_keys, next_event, orphans
from tidewright.operators.shape import (
    calendar,
    explode_rows,
    in_horizon,
    latest_run,
    project_nested,
    set_difference,
    since,
    split_valid,
)
from tidewright.operators.windows import (
    best_run,
    daily_amplitude,
    forward_sum,
    lags,
    latest_per_key,
    pick_current,
    top_n,
    trailing_stats,
    verify_forward_sum,
)

T0 = dt.datetime(2026, 2, 1)


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def timeline(seed, n=400, keys=4, span_hours=24 * 9, hot=0.5):
    """Random rows, half of them in one key, with equal times and gaps."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if rng.random() < hot else f"k{rng.randrange(keys)}"
        out.append((i, key, T0 + dt.timedelta(minutes=20 * rng.randrange(3 * span_hours)), float(rng.randrange(100))))
    return out


@pytest.mark.parametrize("seconds", [None, 3600, 30 * 86_400])
@pytest.mark.parametrize("seed", [1, 2])
def test_next_event_equals_brute_force(spark, seed, seconds):
    readings = timeline(seed)
    events = [(k, t, f"kind{i % 3}") for i, (_, k, t, _) in enumerate(timeline(seed + 50, n=120))]
    readings += [(1000, None, at(1), 1.0), (1001, "hot", None, 1.0), (1002, "hot", readings[0][2], 1.0)]
    events += [(None, at(2), "x"), ("hot", None, "x"), ("hot", readings[3][2], "tie")]
    left = spark.createDataFrame(readings, "id int, k string, ts timestamp, v double")
    right = spark.createDataFrame(events, "k string, ev timestamp, kind string")
    found = {r["id"]: (r["ev"], r["kind"], r["hours_to_event"]) for r in
             next_event(left, right, ["k"], "ts", "ev", ["kind"], seconds).collect()}
    assert len(found) == len(readings)
    for i, key, ts, _ in readings:
        later = sorted((e, kind) for k, e, kind in events if k == key and key and e and ts and e > ts)
        want = (later[0][0], later[0][1], (later[0][0] - ts).total_seconds() / 3600) if later else (None, None, None)
        assert found[i] == want


def test_next_event_needs_a_strictly_later_event(spark):
    left = spark.createDataFrame([("a", at(0)), ("a", at(1)), ("a", at(1)), ("a", at(2))], "k string, ts timestamp")
    right = spark.createDataFrame([("a", at(1), "HIGH")], "k string, ev timestamp, kind string")
    found = rows(next_event(left, right, ["k"], "ts", "ev", ["kind"]).select("ts", "kind"))
    assert found == [(at(0), "HIGH"), (at(1), None), (at(1), None), (at(2), None)]


def by_key(data):
    out = {}
    for row in sorted(data, key=lambda r: (r[2], r[0])):
        out.setdefault(row[1], []).append(row)
    return out


@pytest.mark.parametrize("slice_rows", [None, 7, 25, 90, 10_000])
def test_lags_and_forward_sum_are_the_same_sliced_or_not(spark, slice_rows):
    data = timeline(7)
    df = spark.createDataFrame(data, "id int, k string, ts timestamp, v double")
    specs = {"l1": ("v", 1), "l12": ("v", 12), "a2": ("v", -2)}
    lagged = {r["id"]: r for r in lags(df, ["k"], "ts", specs, ["id"], slice_rows).collect()}
    summed = {
        r["id"]: r["s"]
        for r in forward_sum(df, ["k"], "ts", "v", 2, 1, "s", ["id"], slice_rows=slice_rows).collect()
    }
    assert len(lagged) == len(summed) == len(data)
    for series in by_key(data).values():
        values = [r[3] for r in series]
        for i, row in enumerate(series):
            got = lagged[row[0]]
            assert got["l1"] == (values[i - 1] if i >= 1 else None)
            assert got["l12"] == (values[i - 12] if i >= 12 else None)
            assert got["a2"] == (values[i + 2] if i + 2 < len(values) else None)
            assert summed[row[0]] == sum(values[i : i + 3])


@pytest.mark.parametrize("collapse", [False, True])
def test_trailing_stats_equal_brute_force(spark, collapse):
    data = [(i, k, t, v if i % 7 else None) for i, k, t, v in timeline(11, n=500)]
    df = spark.createDataFrame(data, "id int, k string, ts timestamp, v double")
    specs = {}
    for seconds in (24 * 3600, 6 * 3600, 5 * 3600):
        for stat in ("mean", "sum", "max", "min", "std"):
            specs[f"{stat}_{seconds}"] = ("v", stat, seconds)
    found = {r["id"]: r for r in trailing_stats(df, ["k"], "ts", specs, collapse=collapse).collect()}
    assert len(found) == len(data)
    for i, key, ts, _ in data:
        for name, (_, stat, seconds) in specs.items():
            frame = [
                v for _, k, t, v in data
                if k == key and v is not None and ts - dt.timedelta(seconds=seconds) <= t <= ts
            ]
            want = {
                "mean": lambda: statistics.fmean(frame), "sum": lambda: sum(frame), "max": lambda: max(frame),
                "min": lambda: min(frame), "std": lambda: statistics.stdev(frame) if len(frame) > 1 else None,
            }[stat]() if frame else None
            got = found[i][name]
            assert (got is None) == (want is None), (name, frame)
            if want is not None:
                assert got == pytest.approx(want, abs=1e-9), (name, frame)


def test_a_day_of_hourly_rows_has_25_in_the_frame(spark):
    df = spark.createDataFrame([("a", at(h), 1.0) for h in range(49)], "k string, ts timestamp, v double")
    sums = trailing_stats(df, ["k"], "ts", {"n": ("v", "sum", 86_400)})
    assert [r["n"] for r in sums.orderBy("ts").collect()] == [float(min(h, 24) + 1) for h in range(49)]


def test_forward_sum_by_time_ignores_gaps(spark):
    df = spark.createDataFrame([("a", at(0), 1.0), ("a", at(1), None), ("a", at(5), 4.0)], "k string, ts timestamp, v double")
    by_row = forward_sum(df, ["k"], "ts", "v", 2, 1, "s").orderBy("ts").collect()
    by_time = forward_sum(df, ["k"], "ts", "v", 2, 1, "s", by_time=True).orderBy("ts").collect()
    assert [r["s"] for r in by_row] == [5.0, 4.0, 4.0]
    assert [r["s"] for r in by_time] == [1.0, 0.0, 4.0]
    checked = verify_forward_sum(by_time_frame(df), ["k"], "ts", "v", "s").orderBy("ts").collect()
    assert [r["sum_check"] for r in checked] == ["DIFF", "DIFF", "MATCH"]


def by_time_frame(df):
    return forward_sum(df, ["k"], "ts", "v", 2, 1, "s", by_time=True)


def test_best_run_keeps_all_cells_of_the_newest_run_with_data(spark):
    data = [("z", "d1", 1, "old"), ("z", "d1", 1, "old2"), ("z", "d2", 1, "old"), ("z", "d2", 2, "n1"), ("z", "d2", 2, "n2")]
    df = spark.createDataFrame(data, "zone string, day string, run int, cell string")
    assert rows(best_run(df, ["zone", "day"], "run").select("day", "cell")) == [
        ("d1", "old"), ("d1", "old2"), ("d2", "n1"), ("d2", "n2"),
    ]
    assert rows(best_run(df, ["zone", "day"], "run", ties="one").select("day", "cell")) == [("d1", "old2"), ("d2", "n2")]
    with pytest.raises(ValueError):
        best_run(df, ["zone"], "run", ties="some")


def test_latest_top_and_pick(spark):
    df = spark.createDataFrame(
        [("a", at(0), 1), ("a", at(0), 2), ("a", at(0), 2), ("b", at(4), 3), ("b", at(3), 4)], "k string, ts timestamp, v int"
    )
    assert rows(latest_per_key(df, ["k"], ["ts"])) == [("a", at(0), 2), ("b", at(4), 3)]
    assert rows(top_n(df, ["k"], [F.col("v")], 1).select("v")) == [(1,), (3,)]
    assert rows(pick_current(df, ["k"], "ts", at(3), 1).select("k", "v")) == [("b", 4)]
    assert rows(pick_current(df, ["k"], "ts", at(0), 4).select("k", "v")) in ([("a", 1), ("b", 4)], [("a", 2), ("b", 4)])


def test_ranking_is_bounded_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1)], "k string, v int").repartition(4)
    plan = top_n(df, ["k"], ["v"], 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit")


def test_daily_amplitude(spark):
    data = [
        ("p", at(1), 2.0, "HIGH"), ("p", at(7), 0.5, "LOW"), ("p", at(13), 2.5, "HIGH_TIDE"),
        ("p", at(25), 1.0, "HIGH"), (None, at(1), 1.0, "HIGH"), (None, at(2), 0.0, "LOW"), ("p", None, 9.0, "LOW"),
    ]
    df = spark.createDataFrame(data, "k string, ts timestamp, h double, kind string")
    got = {(r["k"], r["ts"]): r["amplitud_dia_m"] for r in daily_amplitude(df, ["k"], "ts", "h", "kind").collect()}
    assert got[("p", at(1))] == got[("p", at(7))] == got[("p", at(13))] == 2.0
    assert got[("p", at(25))] is None and got[("p", None)] is None and got[(None, at(1))] == 1.0


def test_zone_rectangles_may_overlap(spark):
    zones = spark.createDataFrame(
        [("a", 0.0, 1.0, 0.0, 1.0), ("b", 0.5, 2.0, -1.0, 0.5), ("far", 50.0, 51.0, 50.0, 51.0)],
        "zona_id string, lat_min double, lat_max double, lon_min double, lon_max double",
    )
    points = [(i, i * 0.25 - 1, j * 0.25 - 2) for i in range(16) for j in range(16)] + [(99, None, 0.0)]
    df = spark.createDataFrame(points, "id int, lat double, lon double")
    want = sorted(
        (lat, lon, z) for _, lat, lon in points for z, a, b, c, d in
        [("a", 0.0, 1.0, 0.0, 1.0), ("b", 0.5, 2.0, -1.0, 0.5)] if lat is not None and a <= lat <= b and c <= lon <= d
    )
    for cell in (0.1, 0.5, 3.0):
        got = rows(assign_zone(df, zones, "lat", "lon", cell).select("lat", "lon", "zona_id"))
        assert sorted(got) == want


def test_bands(spark):
    bands = spark.createDataFrame([("low", 0, 5), ("mid", 4, 9)], "band string, lo int, hi int")
    df = spark.createDataFrame([(n,) for n in range(12)], "n int")
    got = rows(assign_band(df, bands, "n", "lo", "hi", 3, ["band"]))
    assert sorted(got) == sorted([(n, "low") for n in range(6)] + [(n, "mid") for n in range(4, 10)])


def test_feed_joins(spark):
    universe = spark.createDataFrame([("z", 1), ("z", 2)], "zone string, h int")
    feed = spark.createDataFrame([("z", 2, 5.0)], "zone string, h int, v double")
    assert rows(integrate(universe, [feed], ["zone", "h"])) == [("z", 1, None), ("z", 2, 5.0)]
    hourly = spark.createDataFrame([("z", at(1)), ("z", at(30))], "zone string, ts timestamp")
    daily = spark.createDataFrame([("z", T0.date(), 7)], "zone string, day date, temp int")
    assert rows(join_daily(hourly, daily, "zone", "ts", "day").select("ts", "temp")) == [(at(1), 7), (at(30), None)]
    expected = spark.createDataFrame([("a",), ("b",)], "zone string")
    assert rows(missing_keys(expected, spark.createDataFrame([("a",), ("a",)], "zone string"), ["zone"])) == [("b",)]
    fact = spark.createDataFrame([("a",), ("x",), ("x",)], "zone string")
    assert rows(orphans(fact, expected, "zone")) == [("x", 2)]


def test_zone_hour_aggregates(spark):
    df = spark.createDataFrame(
        [("z", at(0), "p1", at(-1), 1.0), ("z", at(0), "p2", at(-2), 3.0), ("z", at(0), "p2", at(-1), None)],
        "zone string, ts timestamp, point string, run timestamp, m double",
    )
    assert rows(agg_zone_hour(df, ["m"], ["zone", "ts"], "point", "run")) == [("z", at(0), 2.0, 2, at(-1))]
    tide = spark.createDataFrame(
        [("z", at(0.25), 1.0, None, at(0)), ("z", at(0.5), 2.0, "LOW", at(0)), ("z", at(0.75), 3.0, "HIGH", at(0))],
        "zone string, ts timestamp, h double, kind string, run timestamp",
    )
    got = agg_tide_hour(tide, "zone", "ts", "h", "kind", "run").first()
    assert (got["ts"], got["h"], got["kind"], got["marea_n_puntos"]) == (at(0), 2.0, "LOW", 3)


def test_reports(spark):
    df = spark.createDataFrame(
        [("z", "p", at(0), 1.0), ("z", "q", at(1), None), ("y", "p", at(1), None)], "zone string, p string, ts timestamp, v double"
    )
    roles = {"zone": "zone", "point": "p", "ts": "ts", "run": "ts"}
    assert rows(summary({"t": (df, roles)}).select("n_rows", "n_zones", "n_points", "min_ts")) == [(3, 2, 2, at(0))]
    assert rows(summary({"none": (df.limit(0), roles)}).select("n_rows", "n_zones", "min_ts")) == [(0, 0, None)]
    assert rows(completeness(df, ["v"], ["zone"])) == [("y", 1, 0), ("z", 2, 1)]
    assert sorted(r["pct_with_value"] for r in coverage_pct(df, "v", "ts").collect()) == [0.0, 100.0]
    assert rows(consolidate(df, ["zone"], {"v": "value"})) == [("y", None), ("z", 1.0)]
    pred = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0)], "real double, guess double")
    assert rows(mae_vs_baseline(pred, "real", "guess")) == [(0.5, 1.0)]


def test_risk_by_zone_uses_the_newest_run(spark):
    df = spark.createDataFrame(
        [("a", 50.0, "PELIGRO", at(1)), ("a", 10.0, "SEGURO", at(1)), ("a", 99.0, "PELIGRO", at(0)), ("b", 25.0, "PRECAUCION", at(1))],
        "zona_id string, risk_score_pred double, safety_level_pred string, prediction_ts timestamp",
    )
    got = [tuple(r) for r in risk_by_zone(df).collect()]
    assert got == [("a", 2, 30.0, 10.0, 50.0, 1, 0, 1), ("b", 1, 25.0, 25.0, 25.0, 0, 1, 0)]


def test_landing_matrix_drops_empty_hours(spark):
    df = spark.createDataFrame([("s", "03"), ("s", "03"), ("t", "17")], "source string, hora_pty string")
    full = landing_matrix(df, ["source"])
    assert len(full.columns) == 25
    small = landing_matrix(df, ["source"], drop_empty=True)
    assert small.columns == ["source", "03", "17"] and rows(small) == [("s", 2, 0), ("t", 0, 1)]


def test_rank_statistics_are_exact(spark):
    rng = random.Random(3)
    values = [float(rng.randrange(50)) for _ in range(3000)] + [7.0] * 2000 + [rng.random() * 1e6 for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    ordered = sorted(values)
    ranks = [0, 1, 1374, 2750, 4999, len(values) - 1]
    got = {r["rank"]: r["value"] for r in values_at_ranks(df, "v", ranks).collect()}
    assert got == {k: ordered[k] for k in ranks}
    found = {r["share"]: r["value"] for r in quartiles(df, ["v"]).collect()}
    want = statistics.quantiles(values, n=4, method="inclusive")
    assert [found[s] for s in (0.25, 0.5, 0.75)] == pytest.approx(want)
    with pytest.raises(ValueError):
        values_at_ranks(df, "v", [len(values)])


def test_time_filters_are_half_open(spark):
    df = spark.createDataFrame([(at(h),) for h in (-1, 0, 2.5, 3)], "ts timestamp")
    assert rows(in_horizon(df, "ts", T0, 3)) == [(at(0),), (at(2.5),)]
    assert rows(since(df, "ts", at(3), hours=1)) == [(at(2.5),), (at(3),)]
    plain = df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    assert in_horizon(plain, "ts", "2026-02-01 00:00:00", 3).count() == 2
    days = df.select(F.to_date("ts").alias("d"))
    assert rows(since(days, "d", T0, days=0).distinct()) == [(T0.date(),)]
    with pytest.raises(ValueError):
        since(df, "ts", T0)


def test_latest_run_keeps_everything_without_runs(spark):
    df = spark.createDataFrame([(1, at(0)), (2, at(1)), (3, None)], "id int, run_ts timestamp")
    assert rows(latest_run(df).select("id")) == [(2,)]
    nothing = df.withColumn("run_ts", F.lit(None).cast("timestamp"))
    assert latest_run(nothing).count() == 3


def test_range_split_keeps_duplicates_and_missing_values(spark):
    df = spark.createDataFrame([(1.0, 5.0), (1.0, 5.0), (None, 5.0), (9.0, None), (3.0, 99.0), (None, None)], "a double, b double")
    good, bad = split_valid(df, {"a": (0.0, 3.0), "b": (0.0, 10.0)})
    assert rows(good) == rows(spark.createDataFrame([(1.0, 5.0), (1.0, 5.0), (None, 5.0), (None, None)], df.schema))
    assert rows(bad) == rows(spark.createDataFrame([(9.0, None), (3.0, 99.0)], df.schema))
    assert good.count() + bad.count() == df.count()


def test_set_difference_is_distinct(spark):
    left = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    assert rows(set_difference(left, spark.createDataFrame([(2,)], "x int"))) == [(1,)]


def test_explode_and_projection(spark):
    df = spark.createDataFrame(
        [(1, [{"v": {"sg": "1.5", "noaa": "9"}}, {"v": {"sg": None, "noaa": "2"}}, {"v": None}]), (2, []), (3, None)],
        "id int, xs array<struct<v: struct<sg: string, noaa: string>>>",
    )
    assert explode_rows(df, "xs", "x", ["id"]).count() == 3
    assert explode_rows(df, "xs", "x", ["id"], outer=True).count() == 5
    split = explode_rows(df, "xs", "x", ["id"])
    flat = project_nested(split, "x", {"v": "value", "absent": "gone"}, ["sg"], [F.col("id")])
    assert rows(flat) == rows(spark.createDataFrame([(1, 1.5, None), (1, None, None), (1, None, None)], flat.schema))
    both = project_nested(split, "x", {"v": "value"}, ["sg", "noaa"], [F.col("id")])
    assert sorted(r["value"] for r in both.collect() if r["value"] is not None) == [1.5, 2.0]


def test_calendar_counts_sunday_as_one(spark):
    df = spark.createDataFrame([(at(5),), (at(24),)], "ts timestamp")  # 1 February 2026 is a Sunday
    assert rows(calendar(df, "ts").drop("ts")) == [(0, 2, False), (5, 1, True)]


def test_slices_split_a_burst_of_one_second(spark):
    from tidewright.operators.timeline import CARRIED, SLICE, with_neighbours

    for n in (4_000, 16_000):
        # Nine rows of ten have one key and one second; NULL keys and times are there, too.
        busy = spark.range(n * 9 // 10).select(F.lit("hot").alias("k"), F.lit(at(0)).alias("ts"), F.col("id").cast("int").alias("v"))
        calm = spark.range(n // 10).select(
            F.when(F.col("id") % 7 > 0, F.concat(F.lit("k"), F.col("id") % 5)).alias("k"),
            F.when(F.col("id") % 9 > 0, F.timestamp_seconds(F.col("id") * 60)).alias("ts"), F.col("id").cast("int").alias("v"),
        )
        df = busy.unionByName(calm)
        cut = with_neighbours(df, ["k"], ["ts", "v"], ["v"], 500, 2, 1)
        own = cut.where(~F.col(CARRIED))
        assert own.count() == n
        assert max(r["count"] for r in own.groupBy("k", SLICE).count().collect()) <= 1_000
        found = lags(df, ["k"], "ts", {"l": ("v", 2), "a": ("v", -1)}, ["v"], 500).where("k = 'hot'").orderBy("v").collect()
        values = [r["v"] for r in found]
        assert [r["l"] for r in found] == [None, None, *values[:-2]] and [r["a"] for r in found] == [*values[1:], None]


def test_sliced_plan_reads_the_settled_table_twice(spark):
    df = spark.range(1_000).select(F.lit("k").alias("k"), F.timestamp_seconds("id").alias("ts"), "id")
    plan = forward_sum(df, ["k"], "ts", "id", tiebreak=["id"], slice_rows=100)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") <= 2


def test_quartiles_of_all_columns_in_two_passes(spark, monkeypatch):
    import tidewright.operators.aggregates as aggregates
    from tidewright.operators.aggregates import quartiles

    rng = random.Random(4)
    data = [(i, rng.randrange(50), None if i % 5 else rng.gauss(0, 1), 1e15 if i == 7 else i % 3 / 8, None) for i in range(6_000)]
    df = spark.createDataFrame(data, "a bigint, b bigint, c double, d double, e double")
    for most in (1 << 21, 100):  # the second narrows the brackets further
        monkeypatch.setattr(aggregates, "MOST_INSIDE", most)
        found = {(r["column_name"], r["share"]): r["value"] for r in quartiles(df, ["a", "b", "c", "d", "e"], (0.0, 0.25, 0.5, 0.9, 1.0)).collect()}
        assert len(found) == 20
        for k, c in enumerate("abcd"):
            values = sorted(r[k] for r in data if r[k] is not None)
            for share in (0.0, 0.25, 0.5, 0.9, 1.0):
                place = share * (len(values) - 1)
                low, high = values[int(place)], values[min(int(place) + 1, len(values) - 1)]
                assert found[c, share] == pytest.approx(low + (high - low) * (place % 1), rel=1e-12)
    assert quartiles(df.limit(0), ["a", "c"]).collect() == []


def test_stacked_integration(spark):
    from tidewright.operators.joins import integrate_all, integrate_stack, stack_feeds

    a = spark.createDataFrame([("x", 1, 2.0, [1]), ("y", 1, 3.0, None), (None, 1, 9.0, [2])], "z string, h int, a double, l array<int>")
    b = spark.createDataFrame([("x", 1, "s"), ("w", 2, "t"), (None, 1, "n")], "z string, h int, b string")
    met = integrate_all([a, b], ["z", "h"])
    assert met.columns == ["z", "h", "a", "l", "b"]
    assert rows(met) == sorted([("x", 1, 2.0, [1], "s"), ("y", 1, 3.0, None, None), (None, 1, 9.0, [2], None), ("w", 2, None, None, "t"), (None, 1, None, None, "n")], key=repr)
    assert rows(integrate(spark.createDataFrame([("x", 1), (None, 1), ("q", 7)], "z string, h int"), [a, b], ["z", "h"])) == sorted(
        [("x", 1, 2.0, [1], "s"), (None, 1, None, None, None), ("q", 7, None, None, None)], key=repr
    )
    many = a.unionByName(a)
    stacked = stack_feeds({"a": many, "b": b, "c": b})
    found = integrate_stack(stacked, ["z", "h"], {"a": {"total": (F.sum, "a"), "n": (F.count, "z")}, "b": {"b": (F.max, "b")}})
    assert rows(found) == sorted([("x", 1, 4.0, 2, "s"), ("y", 1, 6.0, 2, None), (None, 1, 18.0, 0, "n"), ("w", 2, None, 0, "t")], key=repr)
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
