import datetime as dt
import json

import pytest

from tests import bronze
from tests.conftest import rows
from tidewright.operators.quality import Contract, PointSuite
from tidewright.schemas import tide_bronze, weather_bronze
from tidewright.sources import enrich
from tidewright.streaming import landing_stream, notice_stream, stream_enrich, stream_validate
from tidewright.streaming.landing import validation_log

RUN = bronze.START


@pytest.fixture
def landed(spark, tmp_path):
    good = bronze.land(spark, str(tmp_path), "stormglass", RUN)
    short = bronze.land(spark, str(tmp_path), "stormglass", RUN + dt.timedelta(hours=8), hours=5)
    suite = PointSuite("raw_data.hours", "time", expected_points=6, duplicates="DUPLICATES_HOURS")
    return good, short, {"stormglass": Contract(spark.read.parquet(good).schema, suite)}


def test_notices_are_validated_once(spark, landed, tmp_path):
    good, short, contracts = landed
    inbox = tmp_path / "notices"
    inbox.mkdir()

    def announce(name, *messages):
        (inbox / name).write_text("\n".join(json.dumps(m) for m in messages))

    def drain():
        query = stream_validate(notice_stream(spark, str(inbox)), contracts, f"{tmp_path}/out", f"{tmp_path}/cp", RUN)
        query.awaitTermination()

    announce("1.json", {"source": " Stormglass ", "path": good, "run_ts": "x"}, {"source": "stormglass"}, {"source": "stormglass", "path": " "})
    drain()
    announce("2.json", {"source": "stormglass", "path": short}, {"source": "nobody", "path": "/x"}, {"source": "stormglass", "path": good})
    drain()
    drain()
    log = validation_log(spark, f"{tmp_path}/out")
    assert {r["path"]: (r["status"], r["violations"]) for r in log.collect()} == {
        good: ("PASS", None),
        short: ("FAIL", "RANGE_OR_POINTS bad_puntos=6 expected_points=48 min_range_h=47.0"),
        "/x": ("FAIL", "UNSUPPORTED_SOURCE"),
    }
    assert spark.read.parquet(f"{tmp_path}/out/rejected").count() == 2
    assert spark.read.parquet(f"{tmp_path}/out/log").count() == 4


def test_landed_tree_as_a_stream_agrees_with_notices(spark, landed, tmp_path):
    good, short, contracts = landed
    stream = landing_stream(spark, f"{tmp_path}/stormglass", "stormglass")
    stream_validate(stream, contracts, f"{tmp_path}/out", f"{tmp_path}/cp", RUN).awaitTermination()
    log = validation_log(spark, f"{tmp_path}/out")
    assert sorted(r["status"] for r in log.collect()) == ["FAIL", "PASS"]


@pytest.mark.parametrize("feed, folder, schema", [("weather", "stormglass", weather_bronze()), ("tide", "marea", tide_bronze())])
def test_enriched_stream_equals_batch(spark, tmp_path, feed, folder, schema):
    bronze.land(spark, str(tmp_path), folder, RUN)
    root = f"{tmp_path}/{folder}"
    query = (
        stream_enrich(spark, root, schema, feed)
        .writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp")
        .trigger(availableNow=True).start(f"{tmp_path}/out")
    )
    query.awaitTermination()
    batch = enrich(spark.read.schema(schema).option("recursiveFileLookup", True).parquet(root), feed)
    streamed = spark.read.parquet(f"{tmp_path}/out").select(*batch.columns)
    assert rows(streamed) == rows(batch) and batch.first()["contexto"] == "MADRUGADA_CRITICA"
    with pytest.raises(ValueError):
        enrich(batch, "other")
