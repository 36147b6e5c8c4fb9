"""Data-quality rules, evaluated for all files of a feed in one grouped job.

The file path is a column. Each rule is an aggregate that first combines by the finest key and then
by file, so neither the number of files nor the size of one of them decides how the work is spread.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.scalars import as_literal, epoch_seconds, parse_ts
from tidewright.operators.joins import missing_keys
from tidewright.operators.shape import since
from tidewright.operators.windows import top_n
from tidewright.schemas import GRID_NATURAL_KEY, GRID_REQUIRED, VALIDATION_LOG
from tidewright.session import settle


def schema_fingerprint(schema: T.StructType | dict) -> str:
    """SHA-256 of a schema's JSON with sorted keys."""
    document = schema if isinstance(schema, dict) else schema.jsonValue()
    return hashlib.sha256(json.dumps(document, sort_keys=True).encode()).hexdigest()


def check_contract(df: DataFrame, fingerprint: str) -> bool:
    """Whether a frame has the agreed schema."""
    return schema_fingerprint(df.schema) == fingerprint


def has_field(schema: T.DataType, path: str) -> bool:
    """Whether a dotted path exists in a schema; arrays are looked through."""
    kind: T.DataType | None = schema
    for name in path.split("."):
        while isinstance(kind, T.ArrayType):
            kind = kind.elementType
        if not isinstance(kind, T.StructType) or name not in kind.names:
            return False
        kind = kind[name].dataType
    return True


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    """Required columns that the frame lacks."""
    return [c for c in required if c not in df.columns]


#: Readings (values of the longest column) that a task gets at once, row groups with fewer that it may get, and readings
#: that are decoded together.
READINGS_PER_TASK, GROUPS_PER_TASK, READINGS_PER_BATCH = 250_000, 32, 65_536


def row_slices(found, most: int) -> list[tuple[int, int, int, int]]:
    """(row group, first row, rows, readings) of the parts of a parquet file, given its metadata: row groups, those of
    more than ``most`` readings cut by rows."""
    out = []
    for k in range(found.num_row_groups):
        group = found.row_group(k)
        rows, readings = group.num_rows, max([group.num_rows, *(group.column(i).num_values for i in range(group.num_columns))])
        parts = min(rows, -(-readings // most))
        cuts = [rows * i // parts for i in range(parts + 1)] if rows else []
        out += [(k, a, b - a, -(-readings // parts)) for a, b in zip(cuts, cuts[1:])]
    return out


def file_schemas(spark: SparkSession, files: DataFrame, path: str = "path", most: int = READINGS_PER_TASK) -> DataFrame:
    """Schema JSON, fingerprint and parts (see ``row_slices``; four arrays) of each parquet file, from the footers alone,
    read in the tasks."""
    parts = ["row_group", "first", "rows", "readings"]

    def footers(batches):
        import io

        import pandas as pd
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_schema

        for batch in batches:
            rows = []
            for location in batch["path"]:
                # A store that cannot be reached fails the task, so that Spark tries again.
                with _opened(location) as handle:
                    size = handle.size()
                    end = handle.read_at(min(8, size), max(0, size - 8))
                    length = int.from_bytes(end[:4], "little") if len(end) == 8 else 0
                    footer = handle.read_at(length, size - 8 - length) if end[4:] == b"PAR1" and length <= size - 8 else b""
                try:
                    found = pq.read_metadata(io.BytesIO(b"PAR1" + footer + end))
                    schema = from_arrow_schema(found.schema.to_arrow_schema()).jsonValue()
                    cut = row_slices(found, most)
                    rows.append((location, json.dumps(schema, sort_keys=True), None, *([x[i] for x in cut] for i in range(4))))
                except Exception as problem:  # a malformed footer is a finding, not a failure
                    rows.append((location, None, str(problem), [], [], [], []))
            yield pd.DataFrame(rows, columns=["path", "schema_json", "problem", *parts])

    located = files.select(F.col(path).alias("path"))
    found = located.mapInPandas(footers, "path string, schema_json string, problem string, " + ", ".join(f"{c} array<long>" for c in parts))
    return found.withColumn("schema_fp", F.sha2("schema_json", 256))


def _opened(location: str):
    from pyarrow import fs

    filesystem, inner = fs.FileSystem.from_uri(location)
    return filesystem.open_input_file(inner)


def read_listed(listed: DataFrame, schema: T.StructType, most: int = READINGS_PER_TASK) -> DataFrame:
    """Rows of the listed files (a settled table of ``file_schemas`` with a number ``_file``) with their number, and the
    problem of a row group that cannot be decoded.

    The list stays distributed: parts of files are dealt over the tasks, which read these and nothing else, so neither
    the number of files nor what else lies in their folders matters. The more readings, the more tasks: what follows in
    a task grows neither with the queue nor with its files. Rows carry a number, as paths are longer than what they name.
    """
    zipped = F.explode(F.arrays_zip("row_group", "first", "rows", "readings")).alias("part")
    units = settle(listed.select("path", "_file", zipped).select("path", "_file", "part.*"), "units")
    total = units.agg(F.sum("readings").alias("readings"), F.count("*").alias("parts")).first()
    tasks = max(1, -(-(total["readings"] or 0) // most), -(-total["parts"] // GROUPS_PER_TASK))
    full = T.StructType([T.StructField("_file", T.LongType()), T.StructField("_problem", T.StringType()), *schema.fields])

    def read(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        wanted = to_arrow_schema(schema)
        names = ["_file", "_problem", *wanted.names]

        def columns(file, problem, n, values):
            return pa.RecordBatch.from_arrays([pa.array([file] * n, pa.int64()), pa.array([problem] * n, pa.string()), *values], names=names)

        for batch in batches:
            for location, file, group, first, rows, readings in zip(*(c.to_pylist() for c in batch.columns)):
                size = max(1, min(4096, READINGS_PER_BATCH * rows // readings))
                with _opened(location) as handle:
                    try:
                        place = 0
                        for part in pq.ParquetFile(handle).iter_batches(batch_size=size, row_groups=[group], use_threads=False):
                            own = part.slice(max(0, first - place), max(0, min(part.num_rows, first + rows - place) - max(0, first - place)))
                            place += part.num_rows
                            if own.num_rows:
                                yield columns(file, None, own.num_rows, [own.column(f.name).cast(f.type) for f in wanted])
                            if place >= first + rows:
                                break
                    except (pa.ArrowException, OSError) as problem:
                        handle.read_at(1, 0)  # raises where the store is at fault, so that the task is tried again
                        yield columns(file, str(problem), 1, [pa.nulls(1, f.type) for f in wanted])

    return units.repartition(tasks).mapInArrow(read, full)


@dataclass(frozen=True)
class PointSuite:
    """Rules for feeds with one row per point and an array of readings."""

    array: str
    time: str
    expected_points: int = 30
    min_readings: int = 48
    min_hours: float = 47.0
    duplicates: str = "DUPLICATES"
    numeric_time: bool = False


# Rule names as they appear in the log.
WEATHER_SUITE = PointSuite("raw_data.hours", "time", duplicates="DUPLICATES_HOURS")
TIDE_SUITE = PointSuite("raw_data.heights", "timestamp", duplicates="DUPLICATES_HEIGHTS", numeric_time=True)


@dataclass(frozen=True)
class GridSuite:
    """Rules for flat grid files."""

    expected_zones: tuple[str, ...]
    min_zones: int = 8
    required: tuple[str, ...] = tuple(GRID_REQUIRED)
    key: tuple[str, ...] = field(default=tuple(GRID_NATURAL_KEY))


def point_readings(df: DataFrame, suite: PointSuite, by: list[str], point: str = "punto_id") -> DataFrame:
    """Point and time of every array element; a row without elements stays, with no time."""
    element = df.select(*by, F.col(point).alias("point"), F.explode_outer(suite.array).alias("e"))
    moment = F.col("e")[suite.time]
    seconds = moment.cast("double") if suite.numeric_time else epoch_seconds(parse_ts(moment)).cast("double")
    return element.select(*by, "point", seconds.alias("ts"))


def point_metrics(readings: DataFrame, by: list[str], min_readings: int, min_hours: float) -> DataFrame:
    """Per file: points, points that are too thin or too short, and duplicated (point, time) keys.

    ``readings`` has the columns ``point`` and ``ts`` (seconds). Three nested groupings over ever
    smaller intermediates replace one distinct count per rule.
    """
    moments = readings.groupBy(*by, "point", "ts").agg(F.count(F.lit(1)).alias("c"))
    known = F.col("ts").isNotNull()
    points = moments.groupBy(*by, "point").agg(
        F.coalesce(F.sum(F.when(known, F.col("c"))), F.lit(0)).alias("n_points"),
        ((F.max("ts") - F.min("ts")) / F.lit(3600.0)).alias("range_hours"),
        F.count_if(known & (F.col("c") > 1)).alias("dups"),
    )
    thin = (F.col("n_points") > 0) & ((F.col("n_points") < min_readings) | (F.col("range_hours") < min_hours))
    return points.groupBy(*by).agg(
        F.count(F.lit(1)).alias("puntos_cnt"),
        F.count_if(thin).alias("bad_puntos"),
        F.coalesce(F.sum("dups"), F.lit(0)).alias("dup_keys"),
    )


def _violation(broken: Column, *parts) -> Column:
    return F.when(broken, F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts]))


def judge_points(metrics: DataFrame, suite: PointSuite) -> DataFrame:
    """PASS or FAIL per file, with all violations listed in a fixed order."""
    found = F.array_compact(
        F.array(
            _violation(
                F.col("puntos_cnt") != suite.expected_points,
                "PUNTOS_COUNT found=", F.col("puntos_cnt").cast("string"), f" expected={suite.expected_points}",
            ),
            _violation(
                F.col("bad_puntos") > 0,
                "RANGE_OR_POINTS bad_puntos=", F.col("bad_puntos").cast("string"),
                f" expected_points={suite.min_readings} min_range_h={suite.min_hours}",
            ),
            _violation(F.col("dup_keys") > 0, f"{suite.duplicates} dup_keys=", F.col("dup_keys").cast("string")),
        )
    )
    listed = metrics.withColumn("_found", found)
    return listed.select(
        *metrics.columns,
        F.when(F.size("_found") == 0, "PASS").otherwise("FAIL").alias("status"),
        F.when(F.size("_found") > 0, F.concat_ws("; ", "_found")).alias("violations"),
    )


def validate_points(df: DataFrame, suite: PointSuite, by: list[str], point: str = "punto_id") -> DataFrame:
    """One verdict per file of a point feed."""
    readings = point_readings(df, suite, by, point)
    return judge_points(point_metrics(readings, by, suite.min_readings, suite.min_hours), suite)


def validate_grid(df: DataFrame, suite: GridSuite, by: list[str], zone: str = "zona_id") -> DataFrame:
    """One verdict per grid file. Missing zones only warn while enough of them are present."""
    lacking = missing_columns(df, list(suite.required))
    if lacking:
        return df.select(*by).distinct().select(
            *by,
            F.lit(None).cast("bigint").alias("puntos_cnt"),
            F.lit(None).cast("bigint").alias("bad_puntos"),
            F.lit(None).cast("bigint").alias("dup_keys"),
            F.lit("FAIL").alias("status"),
            F.lit(f"MISSING_COLUMNS {','.join(lacking)}").alias("violations"),
        )

    nulls = [F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in suite.required]
    wanted = sorted(suite.expected_zones)
    cells = df.groupBy(*dict.fromkeys([*by, zone, *suite.key])).agg(F.count(F.lit(1)).alias("_c"), *nulls)
    zones = cells.groupBy(*dict.fromkeys([*by, zone])).agg(
        F.count_if(F.col("_c") > 1).alias("_dups"), *[F.sum(f"_null_{c}").alias(f"_null_{c}") for c in suite.required]
    )
    files = zones.groupBy(*by).agg(
        F.count(zone).alias("puntos_cnt"),
        # At most the expected zones enter this set.
        F.collect_set(F.when(F.col(zone).isin(wanted), F.col(zone))).alias("_present"),
        F.sum("_dups").alias("dup_keys"),
        *[F.sum(f"_null_{c}").alias(f"_null_{c}") for c in suite.required],
    )
    missing = F.array_sort(F.array_except(F.array(*[F.lit(z) for z in wanted]), F.col("_present")))
    null_text = F.concat_ws(
        ",", *[_violation(F.col(f"_null_{c}") > 0, f"{c}=", F.col(f"_null_{c}").cast("string")) for c in suite.required]
    )
    listed = files.withColumns({"_missing": missing, "_nulls": null_text})
    missing_text = F.concat_ws(",", "_missing")
    found = F.array_compact(
        F.array(
            _violation(F.col("_nulls") != "", "NULLS_IN_REQUIRED ", F.col("_nulls")),
            _violation(
                F.col("puntos_cnt") < suite.min_zones,
                "ZONAS_PRESENTES present=", F.col("puntos_cnt").cast("string"), " missing=", missing_text,
            ),
            _violation(F.col("dup_keys") > 0, "DUPLICATES dup_keys=", F.col("dup_keys").cast("string")),
        )
    )
    warned = _violation(F.size("_missing") > 0, "SOFT:MISSING_ZONAS missing=", missing_text)
    judged = listed.withColumns({"_found": found, "_warned": warned})
    return judged.select(
        *by,
        "puntos_cnt",
        F.size("_missing").cast("bigint").alias("bad_puntos"),
        "dup_keys",
        F.when(F.size("_found") == 0, "PASS").otherwise("FAIL").alias("status"),
        F.when(F.size("_found") > 0, F.concat_ws("; ", "_found")).otherwise(F.col("_warned")).alias("violations"),
    )


def empty_files(landed: DataFrame, rows: DataFrame, path: str = "path") -> DataFrame:
    """Landed files without a single row."""
    return landed.join(rows.select(path).distinct(), path, "left_anti")


def rule_count(df: DataFrame, col: str, expected: int, by: list[str] | None = None) -> DataFrame:
    """Distinct values per file against the expected number, and whether the file is empty."""
    values = df.groupBy(*(by or []), col).agg(F.count(F.lit(1)).alias("_n"))
    counted = values.groupBy(*(by or [])).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), F.count(col).alias("found")
    )
    return counted.withColumns(
        {
            "expected": F.lit(expected),
            "count_ok": F.col("found") == expected,
            "not_empty": F.col("n_rows") > 0,
        }
    )


def rule_coverage(coverage: DataFrame, min_readings: int, min_hours: float) -> DataFrame:
    """Keys with too few readings or too short a span."""
    return coverage.where((F.col("n_points") < min_readings) | (F.col("range_hours") < min_hours))


def rule_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def rule_not_null(df: DataFrame, cols: list[str], by: list[str] | None = None) -> DataFrame:
    """Missing values per required column, in one pass."""
    return df.groupBy(*(by or [])).agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols])


def rule_presence(df: DataFrame, col: str, expected: list[str], minimum: int, by: list[str]) -> DataFrame:
    """Distinct values present per file, the expected ones that are missing (sorted), and whether enough remain."""
    wanted = sorted(set(expected))
    values = df.select(*by, col).distinct()
    grouped = values.groupBy(*by).agg(
        F.count(col).alias("n_present"),
        F.collect_set(F.when(F.col(col).isin(wanted), F.col(col))).alias("_present"),
    )
    missing = F.array_sort(F.array_except(F.array(*[F.lit(z) for z in wanted]), F.col("_present")))
    return grouped.select(
        *by, "n_present", F.concat_ws(",", missing).alias("missing"), (F.col("n_present") >= minimum).alias("enough")
    )


def rule_ranges(df: DataFrame, rules: dict[str, tuple[float, float]], by: list[str] | None = None) -> DataFrame:
    """Rows outside the closed range of each metric, in one pass; missing values are not counted."""
    outside = [F.count_if(~F.col(c).between(low, high)).alias(f"out_{c}") for c, (low, high) in rules.items()]
    return df.groupBy(*(by or [])).agg(*outside)


def require_none(df: DataFrame, message: str) -> None:
    """Raise when a frame of findings has any row; a few of them go into the message."""
    sample = df.limit(10).collect()
    if sample:
        raise ValueError(f"{message}: {[r.asDict() for r in sample]}")


def assert_zones(batch: DataFrame, expected: DataFrame, key: str = "zona_id", ts: str | None = None, as_of=None) -> None:
    """Raise when an expected zone is missing from a new batch, or has nothing at or after ``as_of``."""
    if ts is not None:
        batch = batch.where(F.col(ts) >= as_literal(as_of, batch.schema[ts].dataType))
    require_none(missing_keys(expected.select(key), batch, [key]), "zones without data")


def pending(
    landed: DataFrame,
    log: DataFrame,
    as_of,
    sources: list[str],
    hours: float | None = None,
    per_source: int | None = None,
    retry_failed: bool = False,
    event_time: str = "written_utc",
) -> DataFrame:
    """Work queue: all files of known sources without a verdict.

    ``hours`` looks only at files as recent as that, ``per_source`` takes only the newest few of each
    source; without them the queue is whole. With ``retry_failed`` only a PASS counts as a verdict.
    """
    considered = landed if hours is None else since(landed, event_time, as_of, hours=hours)
    recent = considered.select(
        F.lower("source").alias("source"), "path", F.col(event_time).alias("event_time")
    )
    known = recent.where(F.col("source").isin([s.lower() for s in sources]))
    done = log.where(F.col("status") == "PASS") if retry_failed else log
    queue = missing_keys(known, done, ["path"])
    if per_source is None:
        return queue
    return top_n(queue, ["source"], [F.col("event_time").desc(), F.col("path")], per_source)


def as_log(verdicts: DataFrame, source: str, run_at, fingerprint: str | Column, path: str = "path") -> DataFrame:
    """Verdicts in the columns and types of the validation log."""
    fp = fingerprint if isinstance(fingerprint, Column) else F.lit(fingerprint)
    full = verdicts.withColumns(
        {"run_at": as_literal(run_at), "source": F.lit(source), "path": F.col(path), "schema_fp": fp}
    )
    return full.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in VALIDATION_LOG.fields])


@dataclass(frozen=True)
class Contract:
    """What a feed has agreed to deliver: its schema and its content rules."""

    schema: T.StructType
    suite: PointSuite | GridSuite
    fingerprint: str | None = None

    @property
    def expected_fp(self) -> str:
        return self.fingerprint or schema_fingerprint(self.schema)


def validate_files(
    spark: SparkSession, files: DataFrame, source: str, contract: Contract, run_at
) -> DataFrame:
    """One log row per file: contract check on the footers, then content rules for all matching files in one job.

    ``files`` is a work queue (see ``pending``) of any length or one micro-batch. The footers' verdicts are settled as a
    frame; no path comes to the driver.
    """
    expected = contract.expected_fp
    numbered = file_schemas(spark, files.select("path").distinct()).withColumn("_file", F.monotonically_increasing_id())
    footers = settle(numbered, "footers")
    agreed = footers.where(F.col("schema_fp") == expected)
    reason = F.when(
        F.col("schema_fp").isNotNull(), F.concat(F.lit("SCHEMA_MISMATCH fp="), "schema_fp", F.lit(f" expected={expected}"))
    ).otherwise(F.concat(F.lit("UNREADABLE "), F.coalesce("problem", F.lit(""))))
    counts = {c: F.lit(None).cast("int") for c in ("puntos_cnt", "bad_puntos", "dup_keys")}
    bad = footers.where(~F.col("schema_fp").eqNullSafe(expected)).select(
        "path", F.coalesce("schema_fp", F.lit(expected)).alias("fp"), reason.alias("violations")
    )
    refused = as_log(bad.withColumns({"status": F.lit("FAIL"), **counts}), source, run_at, F.col("fp"))

    rows = read_listed(agreed, contract.schema)
    judge = validate_points if isinstance(contract.suite, PointSuite) else validate_grid
    verdicts = judge(rows.where(F.col("_problem").isNull()), contract.suite, ["_file"])
    broken = rows.where(F.col("_problem").isNotNull()).groupBy("_file").agg(F.min("_problem").alias("_problem"))
    full = agreed.select("path", "_file").join(verdicts, "_file", "left").join(broken, "_file", "left")
    known = F.col("_problem").isNull()
    full = full.withColumns(
        {
            "violations": F.when(~known, F.concat(F.lit("UNREADABLE "), "_problem"))
            .when(F.col("status").isNull(), F.lit("EMPTY_FILE")).otherwise(F.col("violations")),
            "status": F.when(known, F.coalesce("status", F.lit("FAIL"))).otherwise(F.lit("FAIL")),
            **{c: F.when(known, F.col(c)) for c in counts},
        }
    )
    return refused.unionByName(as_log(full, source, run_at, expected))


def validate_pending(
    spark: SparkSession, queue: DataFrame, contracts: dict[str, Contract], run_at
) -> DataFrame:
    """Verdicts for a whole work queue: one job per source, all its files together. Unknown sources fail."""
    results = [
        validate_files(spark, queue.where(F.col("source") == source), source, contract, run_at)
        for source, contract in contracts.items()
    ]
    unknown = queue.where(~F.col("source").isin(list(contracts)))
    failed = unknown.select(
        as_literal(run_at).alias("run_at"), "source", "path", F.lit("FAIL").alias("status"),
        F.lit(None).cast("string").alias("schema_fp"),
        *[F.lit(None).cast("int").alias(c) for c in ("puntos_cnt", "bad_puntos", "dup_keys")],
        F.lit("UNSUPPORTED_SOURCE").alias("violations"),
    )
    return reduce(DataFrame.unionByName, results, failed)


def raise_on_failures(log: DataFrame) -> None:
    """Fail at the end of a run, with the number of failed files."""
    failed = log.where(F.col("status") != "PASS").count()
    if failed:
        raise RuntimeError(f"{failed} files failed validation")
