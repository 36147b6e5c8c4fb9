import datetime as dt
import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewright.models.metrics import error_table, evaluate, verdict
from tidewright.models.risk import (
    ModelParams,
    build,
    feature_importance,
    fit_risk_model,
    model_inputs,
    score,
    temporal_split,
    train,
    training_frame,
)
from tidewright.plans.features import features
from tidewright.plans.serving import importance_view, prediction_view
from tidewright.schemas import INTERACTION_COLUMNS, NUMERIC_FEATURES
from tidewright.sinks import upsert

T0 = dt.datetime(2026, 1, 1)


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(9)
    data = []
    for zone in ("A", "B", "C"):
        level = 1.0
        for h in range(120):
            level = min(3.0, max(0.2, level + rng.uniform(-0.3, 0.3)))
            data.append((zone, T0 + dt.timedelta(hours=h), level, 4 + 2 * level + rng.random(), 25.0, 0.0, 0.0, 10.0, 0.5, 26.0, 35.0, 0.2, 0.1))
    columns = [
        "wave_height_m", "wind_speed_ms", "air_temperature_c", "precipitation_mm", "precipitation_3h_mm", "visibility_km",
        "altura_marea_m", "temperatura_mar_c", "salinidad_psu", "corriente_u_ms", "corriente_v_ms",
    ]
    schema = "zona_id string, timestamp_forecast timestamp, " + ", ".join(f"{c} double" for c in columns)
    return features(spark.createDataFrame(data, schema), T0).cache()


def test_inputs_are_29_without_the_leaking_products():
    assert len(NUMERIC_FEATURES) == 28 and not set(INTERACTION_COLUMNS) & set(NUMERIC_FEATURES)


def test_training_frame(spark, table):
    assert training_frame(table).count() == 360
    assert training_frame(table, until=dt.date(2026, 1, 2), min_rows=1).count() == 3 * 48
    with pytest.raises(ValueError, match="at least 100"):
        training_frame(table.limit(99))
    wild = table.withColumn("risk_score", F.when(F.hour("timestamp_forecast") == 3, 200.5).otherwise(F.col("risk_score")))
    assert training_frame(wild).count() == 360 - 15


@pytest.mark.parametrize("share", [0.1, 0.5, 0.8])
def test_split_keeps_ties_together(spark, share):
    rng = random.Random(4)
    moments = [T0 + dt.timedelta(minutes=rng.randrange(40)) for _ in range(500)]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(moments)], "i int, ts timestamp")
    earlier, later = temporal_split(df, "ts", share)
    cut = sorted(moments)[int(500 * share)]
    assert earlier.count() == sum(m < cut for m in moments)
    assert later.count() == sum(m >= cut for m in moments)


def test_split_of_zoneless_times(spark):
    df = spark.range(100).select(F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).cast("timestamp_ntz").alias("ts"))
    assert [side.count() for side in temporal_split(df, "ts", 0.8)] == [80, 20]


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 5.0)], "y double, p double")
    r = evaluate(df, "y", "p").first()
    assert (r["n"], r["mae"]) == (3, 1.0)
    assert r["rmse"] == pytest.approx((5 / 3) ** 0.5) and r["r2"] == pytest.approx(1 - 5 / 2)
    assert rows(error_table(df, [], "y", "p").select("error", "abs_error")) == [(0.0, 0.0), (1.0, 1.0), (2.0, 2.0)]
    assert [verdict(0.9, 0.7, 1.0), verdict(0.9, 0.8, 21.0), verdict(0.9, 0.8, 5.0)] == ["OVERFIT", "HIGH_RMSE", "OK"]


def test_zone_codes_are_alphabetical_and_saved(spark, table):
    model = build(ModelParams(kind="LR")).fit(model_inputs(table))
    assert list(model.stages[0].labels) == ["A", "B", "C"]
    fewer = model.transform(model_inputs(table.where("zona_id = 'C'")))
    assert rows(fewer.select("zona_id_encoded").distinct()) == [(2.0,)]
    stranger = model.transform(model_inputs(table.limit(1).withColumn("zona_id", F.lit("ZZ"))))
    assert stranger.first()["zona_id_encoded"] == 3.0


def test_gbt_beats_the_mean_and_scores(spark, table, tmp_path):
    run = train(table, T0, ModelParams(trees=8, depth=4), save_to=str(tmp_path), run_id="r1")
    record = run.record.first()
    later = run.test_predictions
    baseline = later.select(F.stddev_pop("risk_score")).first()[0]
    assert record["rmse"] < baseline and record["num_features"] == 29
    assert (record["train_records"], record["test_records"]) == (288, 72)
    ranks = run.importances.orderBy("rank").collect()
    assert len(ranks) == 29 and [r["rank"] for r in ranks] == list(range(1, 30))
    assert all(a["importance"] >= b["importance"] for a, b in zip(ranks, ranks[1:]))
    assert importance_view(run.importances, 3).count() == 3

    loaded = PipelineModel.load(f"{tmp_path}/r1")
    scored = score(loaded, table, T0, "3", "r1")
    assert scored.count() == 360
    values = [r["risk_score_pred"] for r in scored.collect()]
    assert all(0 <= v <= 100 and round(v, 2) == v for v in values)
    merged = upsert(scored, score(loaded, table.where("zona_id = 'A'"), T0, "4", "r2"), ["zona_id", "timestamp_forecast"])
    assert merged.count() == 360 and merged.where("model_version = '4'").count() == 120
    assert prediction_view(scored, T0, 10).count() == 30


@pytest.mark.parametrize("kind", ["RF", "LR"])
def test_other_kinds(spark, table, kind):
    model = fit_risk_model(table, ModelParams(kind=kind, trees=3, depth=3))
    weights = feature_importance(model, spark, "r", T0, kind).orderBy("rank").collect()
    sizes = [abs(r["importance"]) for r in weights]
    assert len(sizes) == 29 and sizes == sorted(sizes, reverse=True)
    with pytest.raises(ValueError):
        build(ModelParams(kind="other"))
