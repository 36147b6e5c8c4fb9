import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests import bronze
from tests.conftest import rows
from tidewright.operators.contracts import read_contracts, refresh_contracts
from tidewright.operators.quality import schema_fingerprint
from tidewright.schemas import GRID_BRONZE, GRID_HISTORY, tide_bronze, weather_bronze
from tidewright.sources import (
    classify_variant,
    clean_grid,
    conform,
    conform_union,
    current_snapshot,
    ensure_columns,
    invalid_boxes,
    landed_files,
    landing_times,
    latest_partition,
    path_date,
    read_points,
    scan_feed,
    tide_stats,
    with_bbox,
    zones_from_rows,
)


@pytest.fixture(scope="module")
def tree(spark, tmp_path_factory):
    """Runs on 31 January, 1 and 2 February: the lookback crosses a month boundary."""
    root = str(tmp_path_factory.mktemp("landed"))
    for day in range(3):
        run = bronze.START + dt.timedelta(days=day)
        bronze.land(spark, root, "stormglass", run)
        bronze.land(spark, root, "marea", run)
        bronze.land(spark, root, "copernicus", run)
    return root


def test_scan_prunes_by_folder_across_months(spark, tree):
    def dates(**kw):
        return rows(scan_feed(spark, f"{tree}/stormglass", weather_bronze(), **kw).select("path_date").distinct())

    assert dates() == [(dt.date(2026, 1, 31),), (dt.date(2026, 2, 1),), (dt.date(2026, 2, 2),)]
    assert dates(as_of="2026-02-01", lookback_days=1) == [(dt.date(2026, 1, 31),), (dt.date(2026, 2, 1),)]
    assert dates(as_of=dt.datetime(2026, 2, 3, 5), lookback_days=2) == [(dt.date(2026, 2, 1),), (dt.date(2026, 2, 2),)]
    with pytest.raises(FileNotFoundError):
        dates(as_of="2027-01-01", lookback_days=2)
    with pytest.raises(ValueError):
        dates(lookback_days=2)


def test_scan_prunes_by_name_and_falls_back(spark, tree):
    def count(as_of):
        return (
            scan_feed(spark, f"{tree}/marea", tide_bronze(), as_of, 0, layout="name", fallback_all=True)
            .select("source_path").distinct().count()
        )

    assert count("2026-02-02") == 1
    assert count("2027-02-02") == 3


def test_scan_merges_differing_schemas(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "id int, x string").write.parquet(f"{tmp_path}/feed/a.parquet")
    spark.createDataFrame([(2, 2.0)], "id int, y double").write.parquet(f"{tmp_path}/feed/b.parquet")
    merged = scan_feed(spark, f"{tmp_path}/feed").select("id", "x", "y")
    assert rows(merged) == [(1, "a", None), (2, None, 2.0)]


def test_landed_files_and_latest_partition(spark, tree):
    files = landed_files(spark, {"stormglass": f"{tree}/stormglass", "marea": f"{tree}/marea"})
    assert files.count() == 6 and set(r["variante"] for r in files.collect()) == {"forecast"}
    latest = latest_partition(files)
    assert rows(latest.select("source", "path_date")) == [
        ("marea", dt.date(2026, 2, 2)), ("stormglass", dt.date(2026, 2, 2)),
    ]
    far = dt.datetime(2100, 1, 1)
    assert landed_files(spark, {"marea": f"{tree}/marea"}, far, 2).count() == 0
    long_ago = dt.datetime(2000, 1, 1)
    assert landed_files(spark, {"marea": f"{tree}/marea"}, long_ago, 2).count() == 3


def test_paths(spark):
    paths = [
        ("s3://b/x/year=2026/month=2/forecast/day=1/f.parquet", dt.date(2026, 2, 1), "forecast"),
        ("/b/x/year=2026/month=02/historico/x_20260203.parquet", dt.date(2026, 2, 3), "historico"),
        ("/b/x/History/x_20260203_101010.parquet", dt.date(2026, 2, 3), "historico"),
        ("/b/x/FORECAST/other.parquet", None, "forecast"),
        ("/b/x/20269999.parquet", None, "desconocido"),
    ]
    df = spark.createDataFrame(paths, "path string, want date, variant string")
    got = classify_variant(df.withColumn("got", path_date("path")))
    for r in got.collect():
        assert (r["got"], r["variante"]) == (r["want"], r["variant"]), r["path"]


def test_landing_times_are_local(spark):
    df = spark.createDataFrame([(int(dt.datetime(2026, 2, 1, 3, tzinfo=dt.timezone.utc).timestamp() * 1000),)], "modTimeMs bigint")
    r = landing_times(df).first()
    assert (r["dia_pty"], r["hora_pty"], r["written_pty_str"]) == (dt.date(2026, 1, 31), "22", "2026-01-31 22:00:00")


def test_points_and_zones(spark, tmp_path):
    bronze.config(f"{tmp_path}/config.json")
    points = read_points(spark, f"{tmp_path}/config.json")
    assert points.count() == 6
    assert rows(points.where("not activo").select("punto_id")) == [("Z1_left",)]
    assert read_points(spark, f"{tmp_path}/config.json", active_only=True).count() == 5
    zones = zones_from_rows(spark, bronze.ZONES)
    own = spark.createDataFrame([("Z2", 7.35, 7.95)], "zona_id string, lat_min double, lat_max double")
    boxed = with_bbox(zones, 0.25, own)
    assert rows(boxed.select("zona_id", "lat_min", "lat_max")) == [("Z1", 9.15, 9.65), ("Z2", 7.35, 7.95)]
    assert invalid_boxes(boxed).count() == 0
    assert invalid_boxes(with_bbox(zones, -0.25)).count() == 2


def test_tide_stats(spark):
    moment = "struct<timestamp: bigint, datetime: string, height: double, state: string>"
    data = [
        ("a", ([(0, "", 1.234, "x"), (1, "", -0.5, "x")], [(0, "", 1.5, "HIGH TIDE"), (1, "", 1.7, "HIGH_TIDE"), (2, "", -0.2, "LOW_TIDE"), (3, "", 9.0, "OTHER")])),
        ("b", ([], [])),
        ("c", (None, None)),
    ]
    df = spark.createDataFrame(data, f"p string, raw_data struct<heights: array<{moment}>, extremes: array<{moment}>>")
    got = {r["p"]: tuple(r["estadisticas"]) for r in tide_stats(df).collect()}
    assert got["a"] == (-0.5, 1.23, 0.37, 1.73, 2, 1, 1.7, -0.2)
    assert got["b"] == got["c"] == (None, None, None, None, 0, 0, None, None)


def test_snapshot_takes_the_first_hour_and_plain_values(spark):
    df = spark.createDataFrame(
        [(1, ([("t0", (1.5,), 7.0), ("t1", (9.0,), 9.0)],)), (2, ([],)), (3, (None,))],
        "id int, raw_data struct<hours: array<struct<time: string, waveHeight: struct<sg: double>, pressure: double>>>",
    )
    got = current_snapshot(df).select("id", "datos_actuales.timestamp", "datos_actuales.waveHeight", "datos_actuales.pressure", "datos_actuales.gust")
    assert rows(got) == [(1, "t0", 1.5, 7.0, None)]


def test_grid_cleaning(spark):
    df = spark.createDataFrame(
        [("z", 0.5, 1.0, None), ("z", 2.0, 9.0, 9.0), ("z", 0.5, None, None), ("y", 2.0, None, 4.0), ("y", None, 1.0, 1.0)],
        "zona_id string, depth double, thetao double, so double",
    )
    assert rows(clean_grid(df, ["thetao", "so"], ["zona_id"]).select("zona_id", "thetao", "so")) == [
        ("y", 1.0, 1.0), ("y", None, 4.0), ("z", 1.0, None),
    ]


def test_conform_adds_typed_nulls_in_order(spark):
    a = spark.createDataFrame([(1, dt.datetime(2026, 2, 3))], "id int, time timestamp")
    got = conform(a, GRID_HISTORY, month_of="time")
    assert got.schema.names == GRID_HISTORY.names and got.first()["year_month"] == "2026-02"
    assert [f.dataType for f in got.schema] == [f.dataType for f in GRID_HISTORY]
    both = conform_union([a, spark.createDataFrame([(1.5,)], "thetao double")], GRID_BRONZE)
    assert both.count() == 2 and both.where("thetao = 1.5").count() == 1
    assert ensure_columns(ensure_columns(a, {"x": "double"}), {"x": "string"}).schema["x"].dataType.simpleString() == "double"


def test_contracts_refresh(spark, tree, tmp_path):
    files = landed_files(spark, {s: f"{tree}/{s}" for s in ("stormglass", "marea")})
    store = f"{tmp_path}/contracts"
    first = refresh_contracts(
        spark, files, ["stormglass", "marea", "copernicus"], store, dt.datetime(2026, 2, 3),
        {"stormglass": "raw_data.hours.visibility.sg", "marea": "raw_data.nothing"},
    )
    got = {r["source"]: r for r in first.collect()}
    assert [got[s]["status"] for s in ("stormglass", "marea", "copernicus")] == ["SUCCESS", "SUCCESS", "NOT_FOUND"]
    assert got["stormglass"]["field_present"] is True and got["marea"]["field_present"] is False
    assert got["stormglass"]["path_date"] == dt.date(2026, 2, 2) and got["stormglass"]["old_fp"] is None
    direct = spark.read.parquet(f"{tree}/stormglass/year=2026/month=02/forecast/day=02")
    assert got["stormglass"]["new_fp"] == schema_fingerprint(direct.schema)
    again = refresh_contracts(spark, files, ["stormglass"], store, dt.datetime(2026, 2, 4)).first()
    assert again["schema_changed"] is False
    assert read_contracts(spark, store).count() == 2
