"""Readers for the feed, the layer tables and the edit store."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editengine import schema as S
from editengine.operators.ingest import parse_lines
from editengine.operators.serving import alive, upsert_latest

_MESSAGE_DDL = "key string, value string"


def read_lines(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """JSON text lines of the raw feed."""
    return (spark.readStream if stream else spark.read).text(path)


def read_raw_events(lines: DataFrame) -> DataFrame:
    """Records of the feed; blank and unparsable lines are left out (``ingest.counters`` counts them)."""
    return parse_lines(lines).where(F.col("outcome") == "record").select("e.*")


def read_kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    fail_on_data_loss: bool = False,
    max_records: int | None = None,
) -> DataFrame:
    """(key, value) messages of one topic. Needs the Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    if max_records:
        reader = reader.option("maxOffsetsPerTrigger", max_records)
    return reader.load()


def read_message_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """(key, value) messages from a folder; ``max_files`` is the rate limit of one trigger."""
    reader = spark.readStream.schema(_MESSAGE_DDL)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """The silver folder as a whole, so that the sink's commit log decides which files count."""
    return spark.read.parquet(path)


def silver_size(silver: DataFrame, enough: int = S.MIN_SILVER_ROWS) -> DataFrame:
    rows = F.count("*")
    return silver.agg(rows.alias("rows"), (rows < enough).alias("few"))


def read_silver_union(spark: SparkSession, *paths: str) -> DataFrame:
    """One scan over files whose columns may differ; a missing column reads as null."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        rows = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return rows.toDF(*[c.lower() for c in rows.columns])


def store_versions(spark: SparkSession, path: str, snapshot: str | None = None) -> tuple[DataFrame, list[str]]:
    """All versions of the store's rows, and the columns that tell the newer of two; none for a snapshot alone."""
    rows = _stored(spark, path)
    if snapshot is not None and (older := _stored(spark, snapshot)) is not None:
        # What was compacted is older than any batch since.
        older = older.drop("event_date").withColumns({"written_ms": F.lit(-1).cast("long"), "batch_id": F.lit(-1)})
        if rows is not None and "written_ms" not in rows.columns:
            rows = rows.withColumn("written_ms", F.lit(0).cast("long"))
        rows = older if rows is None else older.unionByName(rows, allowMissingColumns=True)
    if rows is None:
        rows = spark.createDataFrame([], S.STORE_DDL)
    return rows, [c for c in ("written_ms", "batch_id") if c in rows.columns]


def scan_store(
    spark: SparkSession, path: str, as_of: Column | None = None, snapshot: str | None = None
) -> DataFrame:
    """The edit store's current rows, lower-case columns; none where nothing was written yet.

    Micro-batches append their rows under ``stream=`` and ``batch_id=``, so there the newest version of a
    key is chosen while reading, by the time of writing. A compacted snapshot holds each key once and is
    read as it is, without a shuffle and with its folders per wiki and day (``event_date``) available for
    pruning. With ``snapshot`` the batches since then are read over it. ``as_of`` leaves expired rows
    out, after the newest versions are chosen: an expired version does not bring an older one back.
    """
    rows, version = store_versions(spark, path, snapshot)
    if version:
        rows = upsert_latest(rows, *version).drop("stream")
    return rows if as_of is None else alive(rows, as_of)
