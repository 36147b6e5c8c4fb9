import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests import bronze
from tests.conftest import rows
from tidewright.operators.quality import (
    TIDE_SUITE,
    WEATHER_SUITE,
    Contract,
    GridSuite,
    PointSuite,
    assert_zones,
    check_contract,
    file_schemas,
    has_field,
    judge_points,
    missing_columns,
    pending,
    point_metrics,
    raise_on_failures,
    rule_count,
    rule_coverage,
    rule_not_null,
    rule_presence,
    rule_ranges,
    rule_unique,
    schema_fingerprint,
    validate_files,
    validate_grid,
    validate_pending,
    validate_points,
)
from tidewright.schemas import GRID_BRONZE, tide_bronze, weather_bronze

RUN = bronze.START


def test_fingerprint():
    a = {"fields": [{"name": "x", "type": "int"}], "type": "struct"}
    b = {"type": "struct", "fields": [{"type": "int", "name": "x"}]}
    assert schema_fingerprint(a) == schema_fingerprint(b) and len(schema_fingerprint(a)) == 64
    assert int(schema_fingerprint(a), 16) >= 0
    assert schema_fingerprint(a) != schema_fingerprint({"fields": [{"name": "y", "type": "int"}], "type": "struct"})
    assert len(schema_fingerprint({"fields": []})) == 64
    assert schema_fingerprint(T.StructType([])) != schema_fingerprint(GRID_BRONZE)


def test_schema_checks(spark):
    df = spark.createDataFrame([], GRID_BRONZE)
    assert check_contract(df, schema_fingerprint(GRID_BRONZE)) and not check_contract(df.drop("so"), schema_fingerprint(GRID_BRONZE))
    assert has_field(weather_bronze(), "raw_data.hours.visibility.sg")
    assert not has_field(weather_bronze(), "raw_data.hours.visibility.noaa") and not has_field(weather_bronze(), "lat.x")
    assert missing_columns(df, ["so", "nope"]) == ["nope"]


def suite(**kw):
    return PointSuite("raw_data.hours", "time", **({"expected_points": 6, "duplicates": "DUPLICATES_HOURS"} | kw))


def frame(spark, data, schema=None):
    return spark.createDataFrame(data, schema or weather_bronze()).withColumn("path", F.lit("f1"))


def verdict(df, checked):
    return validate_points(df, checked, ["path"]).first()


def test_good_file_passes(spark):
    good = verdict(frame(spark, bronze.weather_rows(RUN)), suite())
    assert (good["status"], good["violations"], good["puntos_cnt"], good["bad_puntos"], good["dup_keys"]) == ("PASS", None, 6, 0, 0)


@pytest.mark.parametrize("expected", [5, 7, 30])
def test_point_count_must_match(spark, expected):
    bad = verdict(frame(spark, bronze.weather_rows(RUN)), suite(expected_points=expected))
    assert bad["status"] == "FAIL" and bad["violations"] == f"PUNTOS_COUNT found=6 expected={expected}"


@pytest.mark.parametrize("hours, bad", [(49, 0), (48, 0), (47, 6)])
def test_coverage_threshold_is_inclusive(spark, hours, bad):
    got = verdict(frame(spark, bronze.weather_rows(RUN, hours=hours)), suite())
    assert got["bad_puntos"] == bad


def test_enough_readings_in_too_short_a_span(spark):
    readings = [("f1", "p", float(s)) for s in range(0, 60 * 48, 60)]
    df = spark.createDataFrame(readings, "path string, point string, ts double")
    got = judge_points(point_metrics(df, ["path"], 48, 47.0), suite(expected_points=1)).first()
    assert got["bad_puntos"] == 1 and got["violations"].startswith("RANGE_OR_POINTS bad_puntos=1")


def test_all_violations_are_reported_together(spark):
    data = bronze.weather_rows(RUN, hours=10, points=bronze.POINTS[:4])
    got = verdict(frame(spark, data + data[:1]), suite())
    assert got["violations"] == (
        "PUNTOS_COUNT found=4 expected=6; RANGE_OR_POINTS bad_puntos=4 expected_points=48 min_range_h=47.0; "
        "DUPLICATES_HOURS dup_keys=10"
    )


def test_points_without_readings_count_as_points_only(spark):
    data = bronze.weather_rows(RUN)
    empty = data[0][:-1] + (([],),)
    nothing = data[1][:-1] + ((None,),)
    got = verdict(frame(spark, [empty, nothing, *data[2:]]), suite())
    assert (got["puntos_cnt"], got["bad_puntos"], got["status"]) == (6, 0, "PASS")


def test_tide_times_are_epoch_seconds(spark):
    got = verdict(frame(spark, bronze.tide_rows(RUN), tide_bronze()), TIDE_SUITE)
    assert got["violations"] == "PUNTOS_COUNT found=6 expected=30"


GRID = GridSuite(("Z1", "Z2", "Z3"), min_zones=2)


def grid_verdict(spark, data, checked=GRID):
    df = spark.createDataFrame(data, GRID_BRONZE).withColumn("path", F.lit("g"))
    return validate_grid(df, checked, ["path"]).first()


def test_grid_rules(spark):
    data = bronze.grid_rows(RUN)
    soft = grid_verdict(spark, data)
    assert (soft["status"], soft["violations"], soft["bad_puntos"], soft["puntos_cnt"]) == ("PASS", "SOFT:MISSING_ZONAS missing=Z3", 1, 2)
    assert grid_verdict(spark, data, GridSuite(("Z1", "Z2"), 2))["violations"] is None
    few = grid_verdict(spark, bronze.grid_rows(RUN, skip_zones=("Z2",)))
    assert few["status"] == "FAIL" and few["violations"] == "ZONAS_PRESENTES present=1 missing=Z2,Z3"
    twice = grid_verdict(spark, data + data[:2])
    assert twice["violations"] == "DUPLICATES dup_keys=2"
    holes = [r[:2] + (None,) + r[3:] if i < 3 else r for i, r in enumerate(data)]
    assert "NULLS_IN_REQUIRED latitude=3" in grid_verdict(spark, holes)["violations"]
    lacking = spark.createDataFrame(data, GRID_BRONZE).drop("tipo_dato").withColumn("path", F.lit("g"))
    assert validate_grid(lacking, GRID, ["path"]).first()["violations"] == "MISSING_COLUMNS tipo_dato"


def test_single_rules(spark):
    df = spark.createDataFrame([("f", "a", 1.0), ("f", "a", 1.0), ("f", "b", None), ("g", None, 50.0)], "path string, z string, v double")
    assert rows(rule_count(df, "z", 2, ["path"]).select("path", "n_rows", "found", "count_ok")) == [("f", 3, 2, True), ("g", 1, 0, False)]
    assert rows(rule_count(df.limit(0), "z", 2).select("n_rows", "not_empty")) == [(0, False)]
    assert rows(rule_unique(df, ["path", "z", "v"])) == [("f", "a", 1.0, 2)]
    assert rows(rule_not_null(df, ["z", "v"])) == [(1, 1)]
    assert rows(rule_presence(df, "z", ["a", "c", "b"], 2, ["path"])) == [("f", 2, "c", True), ("g", 0, "a,b,c", False)]
    assert rows(rule_ranges(df, {"v": (0.0, 10.0)})) == [(1,)]
    cov = spark.createDataFrame([("p", 48, 47.0), ("q", 47, 90.0), ("r", 90, 46.9)], "p string, n_points int, range_hours double")
    assert rows(rule_coverage(cov, 48, 47.0).select("p")) == [("q",), ("r",)]


def test_zone_assertion_looks_at_the_new_batch(spark):
    expected = spark.createDataFrame([("Z1",), ("Z2",)], "zona_id string")
    batch = spark.createDataFrame([("Z1", RUN), ("Z2", RUN - dt.timedelta(days=9))], "zona_id string, ts timestamp")
    assert_zones(batch, expected)
    with pytest.raises(ValueError, match="Z2"):
        assert_zones(batch, expected, ts="ts", as_of=RUN)


def test_pending_queue(spark):
    now = dt.datetime(2026, 2, 2, 12)
    landed = [("Marea", f"m{i}", now - dt.timedelta(minutes=i)) for i in range(20)]
    landed += [("marea", "old", now - dt.timedelta(hours=25)), ("other", "x", now), ("marea", "edge", now - dt.timedelta(hours=24))]
    files = spark.createDataFrame(landed, "source string, path string, written_utc timestamp")
    log = spark.createDataFrame([("m0", "PASS"), ("m1", "FAIL")], "path string, status string")
    queue = pending(files, log, now, ["marea"], hours=24, per_source=5)
    assert rows(queue.select("path")) == [(f"m{i}",) for i in range(2, 7)]
    retry = pending(files, log, now, ["marea"], hours=24, per_source=100, retry_failed=True)
    assert {r["path"] for r in retry.collect()} == {f"m{i}" for i in range(1, 20)} | {"edge"}


@pytest.fixture(scope="module")
def landed_tree(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("dq"))
    good = bronze.land(spark, root, "stormglass", RUN)
    short = bronze.land(spark, root, "stormglass", RUN + dt.timedelta(hours=8), hours=10)
    empty = bronze.land(spark, root, "stormglass", RUN + dt.timedelta(hours=9), rows=[])
    other = f"{root}/stormglass/other.parquet"
    bronze.write_one_file(spark.createDataFrame([(1,)], "x int"), other)
    broken = f"{root}/stormglass/broken.parquet"
    with open(broken, "w") as out:
        out.write("not parquet")
    return {"good": good, "short": short, "empty": empty, "other": other, "broken": broken}


def contract(spark, path):
    return Contract(spark.read.parquet(path).schema, suite())


def test_files_are_judged_together(spark, landed_tree):
    names = {v: k for k, v in landed_tree.items()}
    queue = spark.createDataFrame([("stormglass", p) for p in names], "source string, path string")
    log = validate_files(spark, queue, "stormglass", contract(spark, landed_tree["good"]), RUN)
    got = {names[r["path"]]: r for r in log.collect()}
    assert got["good"]["status"] == "PASS" and got["good"]["puntos_cnt"] == 6
    assert got["short"]["violations"].startswith("RANGE_OR_POINTS") and got["short"]["bad_puntos"] == 6
    assert got["empty"]["violations"] == "EMPTY_FILE"
    assert got["other"]["violations"].startswith("SCHEMA_MISMATCH")
    assert got["broken"]["violations"].startswith("UNREADABLE")
    assert {r["run_at"] for r in got.values()} == {RUN}
    with pytest.raises(RuntimeError, match="4 files"):
        raise_on_failures(log)


def test_queue_with_unknown_source(spark, landed_tree):
    queue = spark.createDataFrame([("stormglass", landed_tree["good"]), ("else", "/nowhere")], "source string, path string")
    log = validate_pending(spark, queue, {"stormglass": contract(spark, landed_tree["good"])}, RUN)
    assert rows(log.select("source", "status", "violations")) == [("else", "FAIL", "UNSUPPORTED_SOURCE"), ("stormglass", "PASS", None)]


def test_footers_give_the_schema_spark_reads(spark, landed_tree):
    files = spark.createDataFrame([(landed_tree["good"],)], "path string")
    assert file_schemas(spark, files).first()["schema_fp"] == schema_fingerprint(spark.read.parquet(landed_tree["good"]).schema)
    assert WEATHER_SUITE.expected_points == 30


def test_a_long_queue_is_judged_in_the_tasks(spark, tmp_path, monkeypatch):
    """Hundreds of files of several row groups; no frame with paths is collected while the verdicts are planned."""
    from pyspark.sql import functions as F
    from pyspark.sql.classic.dataframe import DataFrame as Classic

    from tidewright.sources.feeds import landed_files

    moment = F.array(*[F.struct(F.format_string("2026-02-01T%02d:00:00", F.lit(h)).alias("time")) for h in range(3)])
    rows = spark.range(2_400).select((F.col("id") % 300).alias("f"), F.col("id").cast("string").alias("punto_id"), F.struct(moment.alias("hours")).alias("raw_data"))
    root = str(tmp_path / "many")
    rows.repartition(4).write.partitionBy("f").option("parquet.block.size", 64).parquet(root)
    suite = PointSuite("raw_data.hours", "time", expected_points=2, min_readings=3, min_hours=2.0)
    agreed = Contract(rows.drop("f").schema, suite)
    queue = landed_files(spark, {"a": root})
    collected, plain = [], Classic.collect
    monkeypatch.setattr(Classic, "collect", lambda self: collected.append(self.columns) or plain(self))
    log = validate_files(spark, queue, "a", agreed, RUN)
    assert not [c for c in collected if "path" in c]
    monkeypatch.undo()
    found = log.collect()
    assert len(found) == queue.count() >= 300 and {r["path"] for r in found} == {r["path"] for r in queue.collect()}
    assert sum(r["puntos_cnt"] for r in found) == 2_400
    assert all((r["status"] == "PASS") == (r["puntos_cnt"] == 2) for r in found)


def test_a_broken_row_group_is_a_finding(spark, landed_tree, tmp_path):
    data = bytearray(open(landed_tree["good"], "rb").read())
    data[4:200] = bytes(196)  # the pages are gone, the footer is whole
    path = str(tmp_path / "torn.parquet")
    open(path, "wb").write(bytes(data))
    queue = spark.createDataFrame([("stormglass", path), ("stormglass", landed_tree["good"])], "source string, path string")
    log = {r["path"]: r for r in validate_files(spark, queue, "stormglass", contract(spark, landed_tree["good"]), RUN).collect()}
    assert log[path]["status"] == "FAIL" and log[path]["violations"].startswith("UNREADABLE")
    assert log[landed_tree["good"]]["status"] == "PASS"
