"""Schema contracts: refreshed from the newest landed file of each source and kept as a small table."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.scalars import as_literal
from tidewright.operators.quality import file_schemas, has_field
from tidewright.operators.windows import top_n
from tidewright.sources.feeds import latest_partition

STORED = "source string, schema_fp string, schema_json string, updated_at timestamp"


def read_contracts(spark: SparkSession, path: str) -> DataFrame:
    """Stored contracts, one row per source; empty before the first refresh."""
    try:
        return spark.read.schema(STORED).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STORED)


def refresh_contracts(
    spark: SparkSession,
    files: DataFrame,
    sources: list[str],
    contracts_path: str,
    as_of,
    required_fields: dict[str, str] | None = None,
) -> DataFrame:
    """Store the fingerprint of the newest file of each source and report what happened.

    ``files`` lists landed files (source, path). The report has one row per source with status
    SUCCESS, FAILED or NOT_FOUND, the date used, the old and new fingerprint, whether the schema
    changed, and whether the field in ``required_fields`` is present. Sources that did not succeed
    keep their old contract.
    """
    newest = latest_partition(files.where(F.col("source").isin(sources)))
    first = top_n(newest, ["source"], ["path"], 1).select("source", "path", "path_date")
    schemas = file_schemas(spark, first)
    before = read_contracts(spark, contracts_path)
    # One row per source from here on.
    found = {r["source"]: r for r in first.join(schemas, "path", "left").collect()}
    old = {r["source"]: r for r in before.collect()}

    updated = {s: r for s, r in found.items() if r["schema_fp"] is not None}
    kept = [(s, r["schema_fp"], r["schema_json"], r["updated_at"]) for s, r in old.items() if s not in updated]
    fresh = spark.createDataFrame(
        [(s, r["schema_fp"], r["schema_json"]) for s, r in updated.items()],
        "source string, schema_fp string, schema_json string",
    ).withColumn("updated_at", as_literal(as_of))
    table = fresh.unionByName(spark.createDataFrame(kept, STORED))
    if updated:
        table.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(contracts_path)
    stored = {r["source"]: r["schema_fp"] for r in read_contracts(spark, contracts_path).collect()}

    report = []
    for source in sources:
        row, was = found.get(source), old.get(source)
        fp = row["schema_fp"] if row else None
        if row is None:
            status, problem = "NOT_FOUND", "no dated parquet files"
        elif fp is None:
            status, problem = "FAILED", row["problem"]
        elif stored.get(source) != fp:
            status, problem = "FAILED", "stored fingerprint differs after writing"
        else:
            status, problem = "SUCCESS", None
        wanted = (required_fields or {}).get(source)
        present = None
        if wanted and row and row["schema_json"]:
            present = has_field(T.StructType.fromJson(json.loads(row["schema_json"])), wanted)
        report.append(
            (source, status, row["path_date"] if row else None, was["schema_fp"] if was else None, fp,
             (was["schema_fp"] != fp) if was and fp else None, present, problem)
        )
    return spark.createDataFrame(
        report,
        "source string, status string, path_date date, old_fp string, new_fp string, "
        "schema_changed boolean, field_present boolean, problem string",
    )
