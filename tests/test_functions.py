import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewright.functions import (
    alert_text,
    clip_round,
    hours_between,
    json_field,
    local_time,
    minutes_since,
    parse_ts,
    risk_score,
    run_context,
    safety_level,
    speed,
    star_rating,
    tide_kind,
)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def num(value):
    return F.lit(value).cast("double")


@pytest.mark.parametrize(
    "wave, wind, current, vis, expected",
    [
        (0.5, 5.0, 0.1, 10.0, 10.5),
        (3.0, 0.0, 0.0, 10.0, 30.0),
        (1.0, 10.0, 2.0, 10.0, 30.0),
        (1.0, 0.0, 0.0, 2.0, 10.0),
        (1.0, 0.0, 0.0, 1.0, 30.0),
        (None, None, None, None, 0.0),
        (0.0, 0.0, 0.0, None, 0.0),
    ],
)
def test_risk_score(spark, wave, wind, current, vis, expected):
    assert one(spark, risk_score(num(wave), num(wind), num(current), num(vis))) == pytest.approx(expected)


@pytest.mark.parametrize(
    "score, wave, wind, vis, variant, level",
    [
        (20.0, 2.0, 0.0, 10.0, "current", "PRECAUCION"),
        (19.999, 0.0, 0.0, 10.0, "current", "SEGURO"),
        (40.0, 0.0, 0.0, 10.0, "current", "PELIGRO"),
        (25.0, 2.5, 0.0, 10.0, "current", "PELIGRO"),
        (25.0, 0.0, 25.0, 10.0, "current", "PELIGRO"),
        (20.0, 0.0, 0.0, 0.999, "current", "PELIGRO"),
        (20.0, 0.0, 0.0, 1.0, "current", "PRECAUCION"),
        (25.0, 2.5, 30.0, 10.0, "features", "PRECAUCION"),
        (10.0, 0.0, 0.0, 0.5, "features", "PELIGRO"),
        (10.0, 9.0, 90.0, 0.1, "prediction", "SEGURO"),
        (40.0, 0.0, 0.0, 10.0, "prediction", "PELIGRO"),
        (0.0, None, None, None, "current", "SEGURO"),
    ],
)
def test_safety_level(spark, score, wave, wind, vis, variant, level):
    assert one(spark, safety_level(num(score), num(wave), num(wind), num(vis), variant)) == level


def test_unknown_variant_is_refused():
    with pytest.raises(ValueError):
        safety_level(F.lit(1.0), variant="other")


@pytest.mark.parametrize(
    "score, wave, wind, text",
    [
        (90.0, 2.5, 30.0, "Oleaje alto"),
        (90.0, 1.0, 25.0, "Viento fuerte"),
        (40.0, 1.0, 1.0, "Condiciones riesgosas"),
        (20.0, None, None, "Precaucion recomendada"),
        (19.0, 1.0, 1.0, None),
    ],
)
def test_alert_text(spark, score, wave, wind, text):
    assert one(spark, alert_text(num(score), num(wave), num(wind))) == text


@pytest.mark.parametrize("amplitude, stars", [(None, 1), (0.49, 1), (0.5, 2), (1.0, 2), (1.99, 2), (2.0, 3)])
def test_star_rating(spark, amplitude, stars):
    assert one(spark, star_rating(num(amplitude))) == stars


def test_speed_null_policy(spark):
    assert one(spark, speed(num(3.0), num(4.0))) == 5.0
    assert one(spark, speed(num(3.0), num(None))) is None
    assert one(spark, speed(num(3.0), num(None), 0.0)) == 3.0


@pytest.mark.parametrize(
    "state, kind",
    [("HIGH TIDE", "HIGH"), ("HIGH_TIDE", "HIGH"), ("low tide", "LOW"), ("LOW_TIDE", "LOW"), ("SLACK", "SLACK"), (None, None)],
)
def test_tide_kind(spark, state, kind):
    assert one(spark, tide_kind(F.lit(state).cast("string"))) == kind


@pytest.mark.parametrize("hour, label", [(9, "MADRUGADA_CRITICA"), (17, "MEDIODIA_SEGUIMIENTO"), (23, "NOCTURNA_PLANIFICACION"), (10, "MANUAL_TESTING")])
def test_run_context(spark, hour, label):
    assert one(spark, run_context(F.lit(dt.datetime(2026, 2, 1, hour, 5)))) == label


def test_clip_round(spark):
    assert one(spark, clip_round(num(-3.0))) == 0.0
    assert one(spark, clip_round(num(123.0))) == 100.0
    assert one(spark, clip_round(num(1.239))) == 1.24
    assert one(spark, clip_round(num(None))) is None


def test_clock_helpers(spark):
    ts = F.lit("2026-02-01 00:00:00").cast("timestamp")
    assert one(spark, minutes_since(ts, "2026-02-01 01:30:00")) == 90
    assert one(spark, hours_between(ts, F.lit("2026-02-01 01:30:00").cast("timestamp"))) == 1.5
    assert one(spark, local_time(ts)) == dt.datetime(2026, 1, 31, 19, 0)
    assert one(spark, parse_ts(F.lit("not a time"))) is None
    assert one(spark, parse_ts(F.lit("2026-02-01T03:00:00+00:00"))) == dt.datetime(2026, 2, 1, 3, 0)


def test_json_field(spark):
    assert one(spark, json_field(F.lit('{"k": 4}'), "k int", "k")) == 4
    assert one(spark, json_field(F.lit("broken"), "k int", "k")) is None
