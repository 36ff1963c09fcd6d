"""The analytical queries over the edit store (serving dialect).

Every function takes ``top``: the report's length, or ``None`` for all rows. Ties are broken by the
group keys, so a report is the same on every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from editengine import schema as S
from editengine.functions import columns as C
from editengine.operators.percentiles import exact_percentile


def _edits(store: DataFrame, *keys: str) -> DataFrame:
    rows = store.where(F.col("type") == "edit")
    for key in keys:
        rows = rows.where(F.col(key).isNotNull())
    return rows


def _ranked(df: DataFrame, top: int | None, *order: Column | str) -> DataFrame:
    ordered = df.orderBy(*order)
    return ordered if top is None else ordered.limit(top)


def edit_spikes(store: DataFrame, top: int | None = 20) -> DataFrame:
    """Pages with more than twice the mean number of edits per page."""
    pages = _edits(store, "title").groupBy("title").agg(F.count("*").alias("editCount"))
    mean = pages.agg(F.sum("editCount") / F.count("*")).scalar()
    return _ranked(pages.where(F.col("editCount") > 2 * mean), top, F.desc("editCount"), "title")


def median_edit_size(store: DataFrame, top: int | None = 20) -> DataFrame:
    medians = exact_percentile(_edits(store, "wiki"), "byte_delta", 0.5, ["wiki"], "medianByteDelta")
    return _ranked(medians, top, F.desc("medianByteDelta"), "wiki")


def multi_user_pages(store: DataFrame, top: int | None = 20, min_users: int = 3) -> DataFrame:
    """Pages that several users touched within one calendar hour."""
    hours = (
        _edits(store, "title", "event_time")
        .groupBy("title", F.date_trunc("hour", "event_time").alias("hourBucket"))
        .agg(F.count_distinct("user_name").alias("uniqueUsers"), F.count("*").alias("totalEdits"))
    )
    return _ranked(
        hours.where(F.col("uniqueUsers") >= min_users), top, F.desc("uniqueUsers"), "title", "hourBucket"
    )


def repeated_edits(store: DataFrame, top: int | None = 20, min_edits: int = 3) -> DataFrame:
    pairs = _edits(store, "user_name", "title").groupBy("user_name", "title").agg(F.count("*").alias("editCount"))
    return _ranked(
        pairs.where(F.col("editCount") >= min_edits), top, F.desc("editCount"), "user_name", "title"
    )


def cross_language(store: DataFrame, top: int | None = 20, min_languages: int = 2) -> DataFrame:
    users = (
        store.where(F.col("user_name").isNotNull())
        .groupBy("user_name")
        .agg(F.count_distinct("wiki_lang").alias("languageCount"))
    )
    return _ranked(
        users.where(F.col("languageCount") >= min_languages), top, F.desc("languageCount"), "user_name"
    )


def edit_sessions(
    store: DataFrame, top: int | None = 20, gap_seconds: int = S.SESSION_GAP_SECONDS
) -> DataFrame:
    """Runs of a user's edits with no pause longer than the gap.

    Two edits inside one slot of ``gap_seconds`` always share a session, so edits are first summed
    per (user, slot), on the map side. Only the slots are put in order: a user's window holds one row
    per slot of the time span, not one per edit, even if the user made a third of all edits.
    """
    second = F.unix_seconds("event_time")
    slots = (
        _edits(store, "user_name", "event_time")
        .groupBy("user_name", F.floor(second / gap_seconds).alias("slot"))
        .agg(
            F.count("title").alias("edits"),
            F.min("event_time").alias("first"),
            F.max("event_time").alias("last"),
        )
    )
    order = Window.partitionBy("user_name").orderBy("slot")
    pause = F.unix_micros("first") - F.unix_micros(F.lag("last").over(order))
    starts = F.when(pause <= gap_seconds * 1_000_000, 0).otherwise(1)  # the first slot has no pause
    sessions = (
        slots.withColumn("starts", starts)
        .withColumn("sessionId", F.sum("starts").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("user_name", "sessionId")
        .agg(
            F.sum("edits").alias("sessionEdits"),
            F.min("first").alias("sessionStart"),
            F.max("last").alias("sessionEnd"),
        )
        .withColumn("durationMin", _minutes("sessionStart", "sessionEnd"))
    )
    return _ranked(sessions, top, F.desc("sessionEdits"), "user_name", "sessionId")


def _minutes(start: str, end: str) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / 1_000_000 / 60


def session_stream(
    store: DataFrame, gap_seconds: int = S.SESSION_GAP_SECONDS, watermark: str = S.GOLD_WATERMARK
) -> DataFrame:
    """The same sessions from a stream, each emitted once the watermark has passed its end."""
    return (
        _edits(store, "user_name", "event_time")
        .withWatermark("event_time", watermark)
        .groupBy("user_name", F.session_window("event_time", f"{gap_seconds} seconds").alias("span"))
        .agg(
            F.count("title").alias("sessionEdits"),
            F.min("event_time").alias("sessionStart"),
            F.max("event_time").alias("sessionEnd"),
        )
        .drop("span")
        .withColumn("durationMin", _minutes("sessionStart", "sessionEnd"))
    )


def max_edits_per_day(store: DataFrame, top: int | None = 20) -> DataFrame:
    days = (
        _edits(store, "user_name", "event_time")
        .groupBy("user_name", F.to_date("event_time").alias("date"))
        .agg(F.count("*").alias("editsInDay"))
    )
    return _ranked(days, top, F.desc("editsInDay"), "user_name", "date")


def high_impact(store: DataFrame, top: int | None = 20, min_edits: int = 2) -> DataFrame:
    """Human users by mean absolute size change, rounded before ranking."""
    users = (
        _edits(store, "user_name")
        .where(~F.col("is_bot"))
        .groupBy("user_name")
        .agg(
            F.count("title").alias("totalEdits"),
            C.round_half_even(F.avg(C.magnitude(F.col("byte_delta")))).alias("avgAbsDelta"),
            F.sum("byte_delta").alias("totalBytes"),
        )
    )
    return _ranked(users.where(F.col("totalEdits") >= min_edits), top, F.desc("avgAbsDelta"), "user_name")


def comment_bins(store: DataFrame) -> DataFrame:
    bins = (
        _edits(store)
        .withColumn("binOrder", C.comment_bin(F.col("comment_len")))
        .where(F.col("binOrder").isNotNull())
        .groupBy("binOrder")
        .agg(
            F.count("title").alias("count"),
            C.round_half_even(F.avg("byte_delta")).alias("avgByteDelta"),
            C.round_half_even(F.avg(C.magnitude(F.col("byte_delta")))).alias("avgAbsDelta"),
        )
    )
    return bins.select(
        C.comment_bin_label(F.col("binOrder")).alias("commentBin"), "count", "avgByteDelta", "avgAbsDelta", "binOrder"
    ).orderBy("binOrder")


def size_by_language(store: DataFrame, top: int | None = 15) -> DataFrame:
    """Edits per language and size category; a fixed column per category."""
    table = (
        _edits(store, "wiki_lang")
        .groupBy("wiki_lang")
        .pivot("edit_size_cat", list(S.SIZE_CATEGORIES))
        .agg(F.count(F.lit(1)))
        .fillna(0, list(S.SIZE_CATEGORIES))
    )
    return _ranked(table, top, "wiki_lang")


def collaboration(store: DataFrame, top: int | None = 20, min_editors: int = 3) -> DataFrame:
    pages = _edits(store, "title").groupBy("title").agg(F.count_distinct("user_name").alias("uniqueEditors"))
    return _ranked(pages.where(F.col("uniqueEditors") >= min_editors), top, F.desc("uniqueEditors"), "title")


def outlier_edits(store: DataFrame, top: int | None = 20, share: float = 0.95) -> DataFrame:
    """Edits whose absolute size change lies above the percentile, largest additions first."""
    rows = _edits(store)
    cut = exact_percentile(rows.select(C.magnitude(F.col("byte_delta")).alias("size")), "size", share).scalar()
    found = rows.where(C.magnitude(F.col("byte_delta")) > cut).select(
        "wiki", "title", "user_name", "byte_delta", "comment_len", "is_bot", "is_anon", "event_time", "event_id"
    )
    return _ranked(found, top, F.desc("byte_delta"), "event_time", "event_id").drop("event_id")


def negative_latency(store: DataFrame) -> DataFrame:
    """Events that arrived before their own time, per wiki."""
    return (
        store.where(F.col("latency_ms") < 0)
        .groupBy("wiki")
        .agg(F.count("*").alias("events"), F.min("latency_ms").alias("minLatencyMs"))
        .orderBy(F.desc("events"), "wiki")
    )


def dominant_editors(store: DataFrame, top: int | None = 20, min_edits: int = 3) -> DataFrame:
    """Per page the most active editor (first by name on ties) and that editor's share.

    Both come from one combinable aggregate over (page, editor) counts; no page's editors are ever
    put in one window.
    """
    pairs = _edits(store, "title", "user_name").groupBy("title", "user_name").agg(F.count("*").alias("n"))
    pages = (
        pairs.groupBy("title")
        .agg(
            F.min(F.struct((-F.col("n")).alias("negative"), "user_name")).alias("best"),
            F.sum("n").alias("totalEdits"),
        )
        .select(
            "title",
            F.col("best.user_name").alias("user_name"),
            (-F.col("best.negative")).alias("userEdits"),
            "totalEdits",
        )
        .where(F.col("totalEdits") >= min_edits)
        .withColumn("share", F.col("userEdits") / F.col("totalEdits"))
    )
    return _ranked(pages, top, F.desc("share"), F.desc("totalEdits"), "title")


def time_profile(store: DataFrame) -> DataFrame:
    """Per user and hour of day the edits, with the user's busiest hour."""
    hours = _edits(store, "user_name").groupBy("user_name", "hour_of_day").agg(F.count("*").alias("edits"))
    user = Window.partitionBy("user_name")  # at most 24 rows each
    busiest = F.min(F.struct((-F.col("edits")).alias("negative"), "hour_of_day")).over(user)
    return hours.withColumn("peakHour", busiest.getField("hour_of_day"))


def comment_size_correlation(store: DataFrame) -> DataFrame:
    """Pearson correlation of comment length and absolute size change, per wiki and overall."""
    return (
        _edits(store, "wiki")
        .rollup("wiki")
        .agg(
            F.count("*").alias("edits"),
            F.round(
                F.corr(F.col("comment_len").cast("double"), C.magnitude(F.col("byte_delta")).cast("double")), 6
            ).alias("correlation"),
        )
        .select(F.coalesce("wiki", F.lit("ALL")).alias("wiki"), "edits", "correlation")
    )


def day_streaks(store: DataFrame, top: int | None = 20) -> DataFrame:
    """Longest run of consecutive active days per user; a window row is a day, not an edit."""
    days = (
        _edits(store, "user_name", "event_time")
        .select("user_name", F.to_date("event_time").alias("day"))
        .distinct()
    )
    island = F.date_sub("day", F.row_number().over(Window.partitionBy("user_name").orderBy("day")))
    streaks = (
        days.withColumn("island", island)
        .groupBy("user_name", "island")
        .agg(F.count("*").alias("days"))
        .groupBy("user_name")
        .agg(F.max("days").alias("longestStreak"))
    )
    return _ranked(streaks, top, F.desc("longestStreak"), "user_name")
