"""Newly landed files as a stream: announced by notices or found by watching the tree.

Each micro-batch is validated as one grouped job. The log of a batch is written to a folder named
after the batch, so a batch that is replayed after a failure replaces its own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewright.operators.quality import Contract, validate_pending
from tidewright.schemas import LANDED_NOTICE
from tidewright.sources.bronze import enrich


def notice_stream(spark: SparkSession, root: str, max_files: int = 100) -> DataFrame:
    """"File landed" notices (source, path, run_ts), one JSON document per line."""
    notices = spark.readStream.schema(LANDED_NOTICE).option("maxFilesPerTrigger", max_files).json(root)
    return notices.withColumns(
        {"source": F.lower(F.trim(F.coalesce("source", F.lit("")))), "path": F.nullif(F.trim("path"), F.lit(""))}
    )


def landing_stream(spark: SparkSession, root: str, source: str, max_files: int = 100) -> DataFrame:
    """The same, from the landed files themselves; their contents are not read here."""
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", max_files)
        .load(root)
    )
    return files.select(F.lit(source).alias("source"), "path", F.col("modificationTime").cast("string").alias("run_ts"))


def stream_validate(
    notices: DataFrame,
    contracts: dict[str, Contract],
    out: str,
    checkpoint: str,
    run_at=None,
) -> StreamingQuery:
    """Validate every announced file once and log the verdict under ``out/log``.

    Notices without a path are skipped and logged under ``out/rejected``. ``run_at`` fixes the clock
    of the log; by default it is the time of the micro-batch.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rejected = batch.where(F.col("path").isNull())
        accepted = batch.where(F.col("path").isNotNull()).select("source", "path").distinct()
        clock = run_at if run_at is not None else spark.sql("SELECT current_timestamp()").first()[0]
        log = validate_pending(spark, accepted, contracts, clock)
        for rows, name in ((log, "log"), (rejected, "rejected")):
            rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
                f"{out}/{name}/batch={batch_id}"
            )

    writer = notices.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def validation_log(spark: SparkSession, out: str) -> DataFrame:
    """The log so far: the latest verdict of each path, however often the file was announced."""
    log = spark.read.option("basePath", f"{out}/log").parquet(f"{out}/log")
    newest = F.max_by(F.struct(*[c for c in log.columns if c != "path"]), F.struct("run_at", "batch"))
    return log.groupBy("path").agg(newest.alias("r")).select("path", "r.*").drop("batch")


def stream_enrich(spark: SparkSession, root: str, schema: T.StructType, feed: str, max_files: int = 100) -> DataFrame:
    """Reading events of newly landed bronze files, enriched as they arrive."""
    files = (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", max_files)
        .parquet(root)
    )
    return enrich(files, feed)
