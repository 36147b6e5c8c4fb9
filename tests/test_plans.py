"""Landed files to predictions, on a generated tree with the awkward cases in it."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests import bronze
from tests.conftest import rows
from tidewright.plans.dims import dim_points, dim_zones
from tidewright.plans.features import features
from tidewright.plans.gold import gold_current, gold_zone_hour
from tidewright.plans.serving import current_view, favourable_view, forecast_view
from tidewright.plans.silver import grid_range_report, silver_grid, silver_tide, silver_weather
from tidewright.schemas import CURRENT_COLUMNS, FEATURE_COLUMNS, GRID_BRONZE, GRID_HISTORY, tide_bronze, weather_bronze
from tidewright.sinks import upsert_table
from tidewright.sources import conform, scan_feed, zones_from_rows

RUN = dt.datetime(2026, 2, 1, 9)
AS_OF = dt.datetime(2026, 2, 1, 10)


@pytest.fixture(scope="module")
def facts(spark, tmp_path_factory):
    """Two daily runs of each feed, loaded twice into silver tables, then read back."""
    root = str(tmp_path_factory.mktemp("medallion"))
    for day in (-1, 0):
        run = RUN + dt.timedelta(days=day)
        bronze.land(spark, root, "stormglass", run, wave=lambda h: 3.0 if h == 2 else 0.5)
        bronze.land(spark, root, "marea", run)
        # The grid of today starts tomorrow.
        bronze.land(spark, root, "copernicus", run, first_day=1)
    out = f"{root}/silver"
    for _ in range(2):
        weather = silver_weather(scan_feed(spark, f"{root}/stormglass", weather_bronze(), RUN, 2), AS_OF)
        series, extremes = silver_tide(scan_feed(spark, f"{root}/marea", tide_bronze(), RUN, 2, "name", True), AS_OF)
        grid = silver_grid(scan_feed(spark, f"{root}/copernicus", GRID_BRONZE, RUN, 2, "name", True), AS_OF)
        upsert_table(spark, f"{out}/weather", weather, ["punto_id", "timestamp_forecast", "run_ts"], "run_date")
        upsert_table(spark, f"{out}/tide", series, ["punto_id", "timestamp_forecast", "run_ts"], "run_date")
        upsert_table(spark, f"{out}/extremes", extremes, ["punto_id", "timestamp_extremo", "run_ts"], "run_date")
        upsert_table(spark, f"{out}/grid", grid, ["zona_id", "timestamp_forecast", "lat", "lon", "run_ts"], "run_date")
    return {n: spark.read.parquet(f"{out}/{n}") for n in ("weather", "tide", "extremes", "grid")}


@pytest.fixture(scope="module")
def gold(facts):
    return gold_zone_hour(facts["weather"], facts["tide"], facts["grid"], AS_OF, 24).cache()


def test_silver_is_loaded_once(facts):
    assert facts["weather"].count() == 2 * 6 * 49
    assert facts["tide"].count() == 2 * 6 * 49
    assert facts["extremes"].count() == 2 * 6 * 8
    # Two zones, three days, two cells over water, two runs.
    assert facts["grid"].count() == 2 * 3 * 2 * 2
    assert facts["grid"].where("temperatura_mar_c IS NULL OR salinidad_psu IS NULL OR corriente_u_ms IS NULL").count() == 0
    assert grid_range_report(facts["grid"]).count() == 0


def test_tide_series_knows_the_next_extreme(facts):
    first = facts["tide"].where((F.col("run_ts") == RUN) & (F.col("punto_id") == "Z1_left")).orderBy("timestamp_forecast").collect()
    assert (first[0]["horas_hasta_cambio_marea"], first[0]["tipo_proximo_cambio"]) == (3.0, "HIGH")
    assert (first[3]["horas_hasta_cambio_marea"], first[3]["tipo_proximo_cambio"]) == (6.0, "LOW")
    assert (first[48]["horas_hasta_cambio_marea"], first[48]["tipo_proximo_cambio"]) == (None, None)
    extremes = facts["extremes"].where((F.col("run_ts") == RUN) & (F.col("punto_id") == "Z1_left"))
    assert {r["tipo"] for r in extremes.collect()} == {"HIGH", "LOW"}
    assert rows(extremes.select("amplitud_dia_m", "calidad_estrellas").distinct()) == [(2.0, 3)]


def test_silver_weather_guards(spark):
    data = bronze.weather_rows(RUN, hours=3, points=bronze.POINTS[:1])
    df = spark.createDataFrame(data + data, weather_bronze())
    assert silver_weather(df, AS_OF).count() == 3
    wild = spark.createDataFrame(bronze.weather_rows(RUN, hours=3, points=bronze.POINTS[:1], wave=lambda h: [1.0, 20.5, None][h]), weather_bronze())
    assert rows(silver_weather(wild, AS_OF).select("wave_height_m")) == [(1.0,), (None,)]
    nameless = df.withColumn("zona_id", F.lit(None).cast("string"))
    with pytest.raises(PySparkException, match="NULL in"):
        silver_weather(nameless, AS_OF).collect()
    assert silver_weather(nameless, AS_OF, on_null="drop").count() == 0
    assert silver_weather(nameless, AS_OF, on_null="keep").count() == 3


def test_history_files_take_the_clock_as_their_run(spark):
    history = conform(spark.createDataFrame(bronze.grid_rows(RUN, days=1), GRID_BRONZE).drop("timestamp_ingesta"), GRID_HISTORY, "time")
    fact = silver_grid(history, AS_OF)
    assert rows(fact.select("run_ts").distinct()) == [(AS_OF,)] and fact.count() == 4


def test_gold_has_every_hour_with_all_feeds(gold):
    assert gold.count() == 2 * 24
    assert gold.where("stormglass_n_puntos <> 3 OR marea_n_puntos <> 3").count() == 0
    assert rows(gold.select("stormglass_run_ts").distinct()) == [(RUN,)]
    by_day = {r["d"]: (r["n"], r["run"]) for r in gold.groupBy(F.to_date("timestamp_forecast").alias("d")).agg(
        F.count("temperatura_mar_c").alias("n"), F.max("copernicus_run_ts").alias("run")).collect()}
    # Today only exists in yesterday's run, tomorrow in today's.
    assert by_day[dt.date(2026, 2, 1)] == (2 * 14, RUN - dt.timedelta(days=1))
    assert by_day[dt.date(2026, 2, 2)] == (2 * 10, RUN)
    assert rows(gold.select("copernicus_n_grillas").distinct()) == [(2,)]


def test_gold_rain_ahead(gold):
    z = gold.where("zona_id = 'Z1'").orderBy("timestamp_forecast").collect()
    assert [r["precipitation_mm"] for r in z[:3]] == [1.0, 2.0, 0.0]
    assert [r["precipitation_3h_mm"] for r in z] == [3.0] * 22 + [z[22]["precipitation_mm"] + z[23]["precipitation_mm"], z[23]["precipitation_mm"]]


def test_single_cell_runs_are_optional(facts):
    one = gold_zone_hour(facts["weather"], facts["tide"], facts["grid"], AS_OF, 24, ties="one")
    assert rows(one.select("copernicus_n_grillas").distinct()) == [(1,)]


def test_current_conditions(gold):
    now = AS_OF + dt.timedelta(minutes=30)
    current = gold_current(gold, now)
    assert current.columns == CURRENT_COLUMNS and current.count() == 2
    r = current.where("zona_id = 'Z1'").first()
    assert r["timestamp_forecast_actual"] == dt.datetime(2026, 2, 1, 11)
    assert (r["wave_height_m"], r["safety_level"], r["alerta_texto"]) == (3.0, "PELIGRO", "Oleaje alto")
    assert r["wind_speed_kts"] == pytest.approx(5 * 1.94384) and r["corriente_speed_ms"] == pytest.approx(0.5**0.5)
    assert r["risk_score"] == pytest.approx(30 + 5 * 1.94384 + 5 * 0.5**0.5)
    assert r["minutes_since_update"] == 30 and r["updated_at"] == now
    assert gold_current(gold, AS_OF + dt.timedelta(days=9)).count() == 0
    assert current_view(current).count() == 2


def test_views(gold):
    forecast = forecast_view(gold, AS_OF, 72)
    assert forecast.count() == 48
    safe = favourable_view(gold, AS_OF, 72)
    # All hours but the rough one stay below the caution score.
    assert safe.count() == 46 and rows(safe.select("safety_level").distinct()) == [("SEGURO",)]


def test_features(gold):
    full = features(gold, AS_OF)
    assert full.columns == [*FEATURE_COLUMNS, "created_at"] and full.count() == 48
    z = full.where("zona_id = 'Z1'").orderBy("timestamp_forecast").collect()
    assert z[0]["wave_height_lag_1h"] is None and z[2]["wave_height_lag_1h"] == 3.0
    assert z[4]["wave_height_delta_3h"] == -2.5 and z[1]["wave_height_max_6h"] == z[7]["wave_height_max_6h"] == 3.0
    assert z[8]["wave_height_max_6h"] == 0.5 and z[8]["wave_height_max_24h"] == 3.0
    assert z[0]["wave_height_std_24h"] is None and z[0]["day_of_week"] == 1 and z[0]["is_weekend"]
    assert z[1]["safety_level"] == "PELIGRO" and z[0]["safety_level"] == "SEGURO"
    sliced = features(gold, AS_OF, slice_rows=10)
    assert rows(sliced) == rows(full)
    assert features(gold, AS_OF + dt.timedelta(hours=10), horizon_hours=5).count() == 10


def test_missing_current_counts_as_zero_only_in_features(gold):
    broken = gold.withColumn("corriente_v_ms", F.lit(None).cast("double"))
    assert features(broken).first()["corriente_speed_ms"] == 0.5
    assert gold_current(broken, AS_OF).first()["corriente_speed_ms"] is None


def test_dimensions(spark):
    zones = dim_zones(zones_from_rows(spark, bronze.ZONES), AS_OF)
    assert zones.count() == 2 and rows(zones.select("activo", "updated_at").distinct()) == [(True, AS_OF)]
    with pytest.raises(ValueError, match="invalid zone"):
        dim_zones(zones_from_rows(spark, bronze.ZONES), AS_OF, offset=-1.0)
    points = spark.createDataFrame(bronze.POINTS, "punto_id string, zona_id string")
    assert dim_points(points, AS_OF, zones).count() == 6
    with pytest.raises(ValueError, match="unknown zones"):
        dim_points(points, AS_OF, zones.where("zona_id = 'Z1'"))
    with pytest.raises(ValueError, match="without keys"):
        dim_points(points.withColumn("zona_id", F.lit(None).cast("string")), AS_OF)


def test_landed_audit_replaces_whole_local_days(spark, tmp_path):
    from tidewright.plans.bronze import LANDED_COLUMNS, reload_landed
    from tidewright.sources import classify_variant

    def files(*moments):
        rows = [("a", f"/x/forecast/{m}.parquet", m) for m in moments]
        return classify_variant(spark.createDataFrame(rows, "source string, path string, modTimeMs long"))

    # 2024-01-20 10:00 UTC; the first local day kept is the 18th, from 05:00 UTC on.
    as_of, day, start = "2024-01-20 10:00:00", 86_400_000, 1_705_554_000_000
    out = str(tmp_path / "audit")
    reload_landed(spark, out, files(start - 1, start, start + day), as_of)
    got = spark.read.parquet(out)
    assert set(got.columns) == set(LANDED_COLUMNS)
    assert sorted(r.modTimeMs for r in got.collect()) == [start, start + day]
    reload_landed(spark, out, files(start, start + 2 * day), as_of)
    assert sorted(r.modTimeMs for r in spark.read.parquet(out).collect()) == [start, start + 2 * day]
