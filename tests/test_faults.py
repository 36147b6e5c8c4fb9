"""Faults that were reproduced once and must stay mended."""

import pytest
from pyspark.sql import functions as F

from tidewright.models.risk import ModelParams, build, model_inputs
from tidewright.operators.quality import file_schemas, pending, read_listed
from tidewright.operators.windows import trailing_stats
from tidewright.plans.serving import importance_view
from tidewright.schemas import NUMERIC_FEATURES
from tidewright.session import checkpoint_dir
from tidewright.sinks.upsert import upsert
from tidewright.sources.bronze import tide_stats
from tidewright.sources.feeds import scan_feed


def test_partial_upsert_into_an_empty_target_fails_on_repeated_keys(spark):
    target = spark.createDataFrame([], "k int, a int, b int")
    source = spark.createDataFrame([(1, 2, 3), (1, 4, 5)], "k int, a int, b int")
    with pytest.raises(Exception, match="several source rows"):
        upsert(target, source, ["k"], ["a"]).collect()


def test_partial_upsert_of_null_keys(spark):
    target = spark.createDataFrame([(1, 2, 3), (None, 4, 5), (2, 6, 7)], "k int, a int, b int")
    source = spark.createDataFrame([(1, None, 30), (None, 40, 50), (9, 90, 91)], "k int, a int, b int")
    got = sorted(map(tuple, upsert(target, source, ["k"], ["a"]).collect()), key=repr)
    assert got == sorted([(1, None, 3), (None, 4, 5), (None, 40, 50), (2, 6, 7), (9, 90, 91)], key=repr)


def test_trailing_figures_of_rows_without_a_time(spark):
    rows = spark.createDataFrame([("a", None, 1.0), ("a", None, 2.0), ("a", "2024-01-01", 5.0)], "z string, t string, v double")
    rows = rows.withColumn("t", F.col("t").cast("timestamp"))
    got = trailing_stats(rows, ["z"], "t", {"s": ("v", "sum", 3600), "m": ("v", "mean", 7200)}).collect()
    assert {(r.v, r.s, r.m) for r in got} == {(1.0, 3.0, 1.5), (2.0, 3.0, 1.5), (5.0, 5.0, 5.0)}


@pytest.mark.parametrize("kind", ["GBT", "RF"])
def test_trees_of_many_zones(spark, kind):
    zones = spark.range(160).select(F.format_string("z%03d", F.col("id") % 40).alias("zona_id"), (F.col("id") % 7).cast("double").alias("risk_score"))
    rows = zones.withColumns({c: F.lit(0.0) for c in NUMERIC_FEATURES})
    model = build(ModelParams(kind=kind, trees=1, depth=2)).fit(model_inputs(rows))
    assert model.transform(model_inputs(rows)).count() == 160


def test_tide_figures_skip_missing_heights(spark):
    shape = "raw_data struct<heights: array<struct<height: double>>, extremes: array<struct<state: string, height: double>>>"
    rows = spark.createDataFrame([(([(1.0,), (None,), (3.0,)], []),), (([(None,)], []),)], shape)
    got = [r.estadisticas for r in tide_stats(rows).collect()]
    assert got[0]["altura_prom_m"] == 2.0 and got[0]["altura_min_m"] == 1.0 and got[1]["altura_prom_m"] is None


def test_an_empty_day_file_is_a_match(spark, tmp_path):
    rows = spark.createDataFrame([(1,)], "v int")
    rows.write.parquet(f"{tmp_path}/year=2024/month=01/forecast/day=01")
    rows.limit(0).write.parquet(f"{tmp_path}/year=2024/month=01/forecast/day=05")
    assert scan_feed(spark, str(tmp_path), rows.schema, "2024-01-05 10:00:00", 1, fallback_all=True).count() == 0
    assert scan_feed(spark, str(tmp_path), rows.schema, "2024-03-05 10:00:00", 1, fallback_all=True).count() == 1
    with pytest.raises(FileNotFoundError):
        scan_feed(spark, str(tmp_path), rows.schema, "2024-03-05 10:00:00", 1)


def test_only_malformed_files_are_findings(spark, tmp_path):
    (tmp_path / "bad.parquet").write_bytes(b"PAR1 no footer here")
    (tmp_path / "tiny.parquet").write_bytes(b"x")
    spark.range(3).coalesce(1).write.parquet(f"{tmp_path}/good")
    good = next(str(p) for p in (tmp_path / "good").glob("*.parquet"))
    paths = [good, str(tmp_path / "bad.parquet"), str(tmp_path / "tiny.parquet")]
    found = {r.path: r for r in file_schemas(spark, spark.createDataFrame([(p,) for p in paths], "path string")).collect()}
    assert found[paths[0]].problem is None and found[paths[1]].problem and found[paths[2]].problem
    with pytest.raises(Exception):
        file_schemas(spark, spark.createDataFrame([("unheard://of/it.parquet",)], "path string")).collect()


def test_a_large_file_is_dealt_over_tasks(spark, tmp_path):
    """One row group of many readings is cut by rows; every row comes once, whatever the parts."""
    hours = F.transform(F.sequence(F.lit(0), F.col("id") % 5), lambda h: F.struct(h.alias("time")))
    rows = spark.range(1000).select(F.col("id").alias("punto_id"), F.struct(hours.alias("hours")).alias("raw_data"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/one")
    paths = [(str(p),) for p in (tmp_path / "one").glob("*.parquet")]
    files = spark.createDataFrame(paths, "path string")
    for most, parts in ((250_000, 1), (700, 5), (1, 1000)):
        listed = file_schemas(spark, files, most=most).withColumn("_file", F.lit(3).cast("long")).cache()
        assert len(listed.first()["rows"]) == parts and sum(listed.first()["rows"]) == 1000
        got = read_listed(listed, rows.schema, most)
        assert got.rdd.getNumPartitions() == (1 if parts == 1 else 3000 // most + (3000 % most > 0))
        assert got.select("_file", "_problem").distinct().collect() == [(3, None)]
        assert sorted(map(str, got.select(*rows.columns).collect())) == sorted(map(str, rows.collect()))


def test_the_queue_and_the_importances_are_whole(spark):
    files = spark.range(5000).select(F.lit("marea").alias("source"), F.format_string("f%d", "id").alias("path"), F.lit("2024-01-01").cast("timestamp").alias("written_utc"))
    log = spark.createDataFrame([("f7", "PASS")], "path string, status string")
    assert pending(files, log, "2024-06-01 00:00:00", ["marea"]).count() == 4999
    assert importance_view(spark.range(40).withColumnRenamed("id", "rank")).count() == 40


def test_checkpoint_folder_of_a_cluster_must_be_named(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda *a: None)

    with pytest.raises(ValueError, match="checkpoint"):
        checkpoint_dir(Session())
