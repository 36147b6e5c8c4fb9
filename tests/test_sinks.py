import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewright.operators.shape import with_run_date
from tidewright.sinks import (
    DuplicateKeys,
    log_results,
    overwrite,
    recent_log,
    replace_range,
    replaced_rows,
    upsert,
    upsert_table,
    write_clustered,
)

SCHEMA = "k int, a string, b double"


def merged(target, source, cols=None):
    """What a merge does, row by row."""
    out = {r[0]: list(r) for r in target}
    for r in source:
        if r[0] in out and cols:
            for i, name in enumerate(("k", "a", "b")):
                if name in cols:
                    out[r[0]][i] = r[i]
        else:
            out[r[0]] = list(r)
    return sorted((tuple(r) for r in out.values()), key=repr)


@pytest.mark.parametrize("cols", [None, ["b"], ["a", "b"]])
@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_upsert_equals_brute_force(spark, cols, threshold):
    rng = random.Random(5)
    target = [(k, f"old{k}", float(k)) for k in rng.sample(range(200), 120)]
    source = [(k, None if k % 5 == 0 else f"new{k}", None if k % 3 == 0 else -1.0) for k in rng.sample(range(200), 80)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = upsert(spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA), ["k"], cols)
        assert rows(got) == merged(target, source, cols)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_keys_never_match(spark):
    target = spark.createDataFrame([(None, "t", 1.0)], SCHEMA)
    source = spark.createDataFrame([(None, "s", 2.0), (None, "s2", 2.0)], SCHEMA)
    assert upsert(target, source, ["k"]).count() == 3
    assert upsert(target, source, ["k"], ["b"]).count() == 3


def test_repeated_source_keys_fail(spark):
    target = spark.createDataFrame([(1, "t", 1.0)], SCHEMA)
    source = spark.createDataFrame([(1, "s", 2.0), (1, "s", 2.0)], SCHEMA)
    with pytest.raises(PySparkException, match="several source rows"):
        upsert(target, source, ["k"]).collect()
    with pytest.raises(PySparkException, match="several source rows"):
        upsert(target, source, ["k"], ["a"]).collect()
    with pytest.raises(DuplicateKeys):
        upsert(target, source, ["k"], check="eager")
    assert upsert(target, source, ["k"], check="none").count() == 2


def day(n):
    return dt.datetime(2026, 2, n, 6)


def facts(spark, data):
    return with_run_date(spark.createDataFrame(data, "k int, run_ts timestamp, v double"))


def test_table_upsert_touches_only_its_partitions(spark, tmp_path):
    path = f"{tmp_path}/fact"
    upsert_table(spark, path, facts(spark, [(1, day(1), 1.0), (2, day(1), 1.0), (3, day(2), 1.0)]), ["k", "run_ts"], "run_date")
    untouched = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "fact" / "run_date=2026-02-01").glob("*.parquet")}
    upsert_table(spark, path, facts(spark, [(3, day(2), 9.0), (4, day(2), 9.0), (5, day(3), 9.0)]), ["k", "run_ts"], "run_date")
    assert rows(spark.read.parquet(path).select("k", "v")) == [(1, 1.0), (2, 1.0), (3, 9.0), (4, 9.0), (5, 9.0)]
    assert untouched == {p.name: p.stat().st_mtime_ns for p in (tmp_path / "fact" / "run_date=2026-02-01").glob("*.parquet")}
    upsert_table(spark, path, facts(spark, [(1, day(1), 5.0)]), ["k", "run_ts"], "run_date", ["v"])
    assert rows(spark.read.parquet(path).where("k < 3").select("k", "v")) == [(1, 5.0), (2, 1.0)]


def test_range_reload_is_idempotent_and_empties_dates(spark, tmp_path):
    path = f"{tmp_path}/landed"
    old = facts(spark, [(n, day(n), 1.0) for n in range(1, 6)])
    new = facts(spark, [(10, day(4), 2.0), (11, day(2), 2.0)])
    start = dt.date(2026, 2, 3)
    want = [(1, 1.0), (10, 2.0), (2, 1.0)]
    assert rows(replaced_rows(old, new, "run_date", start).select("k", "v")) == want
    replace_range(spark, path, old, "run_date", dt.date(2026, 2, 1))
    for _ in range(2):
        replace_range(spark, path, new, "run_date", start)
        assert rows(spark.read.parquet(path).select("k", "v")) == want


def test_log_and_layout(spark, tmp_path):
    log = spark.createDataFrame([(f"p{i}", day(1 + i % 3)) for i in range(9)], "path string, run_at timestamp")
    log_results(log, f"{tmp_path}/log")
    log_results(log, f"{tmp_path}/log")
    stored = spark.read.parquet(f"{tmp_path}/log")
    assert stored.count() == 18 and {r["run_at"] for r in recent_log(stored, 6).collect()} == {day(3)}
    df = spark.range(1000).select((F.col("id") % 7).alias("z"), "id")
    write_clustered(df, f"{tmp_path}/clustered", ["z", "id"], files=3)
    back = spark.read.parquet(f"{tmp_path}/clustered")
    spans = back.groupBy(F.input_file_name().alias("f")).agg(F.min("z").alias("lo"), F.max("z").alias("hi")).orderBy("lo").collect()
    assert back.count() == 1000 and len(spans) == 3
    assert all(a["hi"] <= b["lo"] for a, b in zip(spans, spans[1:]))
    overwrite(df.limit(5), f"{tmp_path}/clustered")
    assert spark.read.parquet(f"{tmp_path}/clustered").count() == 5
