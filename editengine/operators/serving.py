"""Serving: the keyed edit store's rows, their newest versions, order and expiry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from editengine import schema as S
from editengine.functions import columns as C


def _filled() -> dict[str, Column]:
    def number(name, default=0):
        return F.coalesce(F.col(name), F.lit(default))

    return {
        "wiki": C.text_or(F.col("wiki"), "unknown"),
        "wiki_lang": C.text_or(F.col("wikiLang"), "unknown"),
        "event_time": F.col("eventTime"),
        "event_id": number("id"),
        "ingestion_ts": number("ingestion_ts"),
        "type": C.text_or(F.col("type"), "unknown"),
        "title": C.text_or(F.col("title"), ""),
        "title_url": C.text_or(F.col("title_url"), ""),
        "namespace": number("namespace"),
        "user_name": C.text_or(F.col("user"), "anonymous"),
        "is_bot": C.flag_or_false(F.col("bot")),
        "is_minor": C.flag_or_false(F.col("minor")),
        "is_anon": C.flag_or_false(F.col("isAnon")),
        "byte_delta": number("byte_delta"),
        "title_len": number("title_len"),
        "comment_len": number("commentLen"),
        "comment": C.text_or(F.col("comment"), ""),
        "hour_of_day": number("hourOfDay"),
        "day_of_week": number("dayOfWeek", 1),
        "latency_ms": number("latencyMs"),
        "edit_size_cat": C.text_or(F.col("editSizeCategory"), "unknown"),
        "server_name": C.text_or(F.col("server_name"), ""),
    }


def serving_rows(silver: DataFrame) -> DataFrame:
    """Store rows with nulls filled; rows without an event time cannot be keyed and are left out."""
    filled = _filled()
    return silver.where(F.col("eventTime").isNotNull()).select(*[filled[c].alias(c) for c in S.STORE_COLUMNS])


def serving_rejects(silver: DataFrame) -> DataFrame:
    return silver.where(F.col("eventTime").isNull())


def upsert_latest(rows: DataFrame, *version: str, also: tuple[str, ...] = ()) -> DataFrame:
    """One row per store key: the last written.

    ``version`` columns (a batch number, say) decide first, then the arrival time, then the content.
    Spark limits each map task to one row per key before the shuffle (window group limit), so a key
    that repeats millions of times moves one row per task. ``also`` names columns that follow from the
    key: rows that are dealt out by some of them already are not moved again.
    """
    content = ["type", "title", "user_name", "byte_delta", "comment"]
    # The key's most selective part comes first: the sort compares it by its binary prefix.
    key = sorted(S.STORE_KEY, key=("event_time", "event_id", "wiki", "wiki_lang").index)
    newest = Window.partitionBy(*key, *also).orderBy(
        *[F.desc(c) for c in (*version, "ingestion_ts", *content)]
    )
    return rows.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank", *version)


def by_wiki_and_day(rows: DataFrame, salts: int = 8) -> DataFrame:
    """Rows dealt out by wiki and day, each over ``salts`` tasks, with both as columns ``event_date`` and ``salt``."""
    dated = rows.withColumns({
        "event_date": F.to_date("event_time"), "salt": F.pmod(F.xxhash64("event_time", "event_id"), F.lit(salts)),
    })
    return dated.repartition("wiki", "event_date", "salt")


def newest_first(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """Physical order of the store: by wiki, newest first; a large wiki spans several ranges."""
    order = [F.col("wiki"), F.col("wiki_lang"), F.desc("event_time"), F.desc("event_id")]
    ranged = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


def latest_per_wiki(rows: DataFrame, n: int = 10) -> DataFrame:
    newest = Window.partitionBy("wiki", "wiki_lang").orderBy(F.desc("event_time"), F.desc("event_id"))
    return rows.withColumn("position", F.row_number().over(newest)).where(F.col("position") <= n)


def alive(rows: DataFrame, as_of: Column, ttl_seconds: int = S.RETENTION_SECONDS) -> DataFrame:
    """Rows whose time to live, counted from the write, has not run out at ``as_of``."""
    written = F.col("ingestion_ts")
    return rows.where(written > F.unix_millis(as_of) - F.lit(ttl_seconds * 1000))


def hourly_summary(rows: DataFrame, types: tuple[str, ...] = ("edit",)) -> DataFrame:
    return (
        rows.where(F.col("type").isin(*types))
        .groupBy("wiki", "wiki_lang", F.date_trunc("hour", "event_time").alias("hour_bucket"))
        .agg(F.count("*").alias("total_edits"))
    )


def hourly_stream(rows: DataFrame, watermark: str = S.GOLD_WATERMARK, types: tuple[str, ...] = ("edit",)) -> DataFrame:
    """The hourly counts of a stream; an hour leaves the state once the watermark has passed it."""
    return (
        rows.where(F.col("type").isin(*types))
        .withWatermark("event_time", watermark)
        .groupBy("wiki", "wiki_lang", F.window("event_time", "1 hour").alias("span"))
        .agg(F.count("*").alias("total_edits"))
        .select("wiki", "wiki_lang", F.col("span.start").alias("hour_bucket"), "total_edits")
    )


def summary_columns(bot: str = "bot") -> list[Column]:
    return [
        F.count("*").alias("written"),
        F.count_if(F.col("type") == "edit").alias("edits"),
        F.count_if(F.coalesce(F.col(bot), F.lit(False))).alias("bots"),
    ]


def batch_summary(silver: DataFrame) -> DataFrame:
    return silver.agg(*summary_columns())
