"""The whole pipeline: messages -> bronze -> silver -> gold and edit store.

The source is read and parsed once. Silver follows the bronze table, gold and the store follow the
silver table, each with its own checkpoint; a table written by one query is read by the next through
the sink's commit log, so every layer starts from the same records.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from editengine import schema as S
from editengine.operators import bronze, gold, silver
from editengine.streaming import sinks


def with_counters(messages: DataFrame, name: str = "ingest") -> DataFrame:
    """Count messages and the blank and malformed ones as they pass; the figures come with every progress report."""
    value = F.col("value").cast("string")
    blank = value.isNull() | (F.trim(value) == "")
    return messages.observe(
        name,
        F.count(F.lit(1)).alias("messages"),
        F.count_if(blank).alias("blank"),
        F.count_if(~blank & (F.try_parse_json(value).isNull() | ~F.ltrim(value).startswith("{"))).alias("parse_errors"),
    )


@dataclass
class Pipeline:
    root: str
    queries: dict[str, StreamingQuery] = field(default_factory=dict)
    store: sinks.StoreWriter | None = None

    def path(self, layer: str) -> str:
        return f"{self.root}/{layer}"

    def checkpoint(self, layer: str) -> str:
        return f"{self.root}/_checkpoints/{layer}"

    def stop(self) -> None:
        for query in self.queries.values():
            query.stop()

    def await_any(self) -> None:
        """Block until one query ends, then stop the others."""
        spark = next(iter(self.queries.values())).sparkSession if self.queries else SparkSession.active()
        try:
            spark.streams.awaitAnyTermination()
        finally:
            self.stop()


def _follow(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.readStream.schema(like.schema).parquet(path)


def start(
    messages: DataFrame, root: str, available_now: bool = False, every: str = S.TRIGGER, watermark: str = S.GOLD_WATERMARK,
    keep_rejects: bool = False,
) -> Pipeline:
    """Start the four queries. With ``available_now`` each layer finishes before the next begins.

    ``keep_rejects`` adds a query on the same source that keeps the messages bronze leaves out, with
    their causes, in a table ``rejects``.
    """
    spark = messages.sparkSession
    run = Pipeline(root)

    def table(layer: str, stream: DataFrame) -> None:
        query = sinks.write_parquet(stream, run.path(layer), run.checkpoint(layer), available_now=available_now, every=every)
        run.queries[layer] = query
        if available_now:
            query.awaitTermination()

    parsed = bronze.to_bronze(with_counters(messages))
    table("bronze", parsed)
    cleaned = silver.to_silver(_follow(spark, run.path("bronze"), parsed))
    table("silver", cleaned)
    if keep_rejects:
        table("rejects", bronze.rejects(messages))
    table("gold", gold.to_gold(_follow(spark, run.path("silver"), cleaned), watermark=watermark))
    run.queries["store"], run.store = sinks.write_store(
        _follow(spark, run.path("silver"), cleaned), run.path("store"), run.checkpoint("store"), available_now, every
    )
    if available_now:
        run.queries["store"].awaitTermination()
    return run
