"""One named query per operator, over the given tables.

Each entry takes (spark, table folder) and returns a DataFrame. Timestamps leave as TIMESTAMP_NTZ and
dates as text, so that results compare across engines without a time zone.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from editengine import schema as S
from editengine.functions import columns as C
from editengine.operators import (
    bronze, edits, evaluate, features, gold, iforest, ingest, models, overview, serving, silver, sketches, trends,
)
from editengine.operators.percentiles import exact_percentile
from editengine.plans import registry, training
from editengine.session import prepare, shared_dir, written
from editengine.sources import events, layers, tables
from editengine.streaming import pipeline, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RECORD = (
    "id", "type", "wiki", "title", "title_url", "namespace", "user", "bot", "minor", "timestamp", "comment",
    "server_name", "ingestion_ts", "is_bot", "namespace_str", "byte_delta", "title_len",
)
SILVER = RECORD + (
    "eventTime", "ingestionTime", "latencyMs", "isAnon", "editSizeCategory", "commentLen", "wikiLang",
    "hourOfDay", "dayOfWeek",
)
# Parameters of the demonstration queries, shared with the checking SQL.
AS_OF = "2024-01-10 00:00:00"
CENTROIDS = ((0, 0, 6, 50, 0, 0), (3000, 3000, 6, 200, 0, 0), (-2500, 2500, 6, 20, 0, 0),
             (0, 500, 7, 100, 1, 0), (9000, 9000, 6, 300, 0, 1))
BIG_CHANGE = 2500
CUTOFF = 0.02


def presentable(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz").alias(f.name)
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string").alias(f.name)
        out.append(c)
    return df.select(*out)


def query(name: str):
    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return presentable(fn(prepare(spark), sf_dir))

        QUERIES[name] = run
        return fn

    return register


# --- Inputs ---

def raw(spark, d):
    return events.raw_events(events.read_events(spark, d))


def enriched(spark, d):
    return ingest.enrich(raw(spark, d))


def lines(spark, d):
    return events.raw_json(raw(spark, d))


def bronze_rows(spark, d):
    return enriched(spark, d).where(F.col("wiki").isNotNull())


def silver_rows(spark, d):
    return silver.to_silver(bronze_rows(spark, d))


def store_rows(spark, d):
    return serving.serving_rows(silver_rows(spark, d))


def silver_stream(spark, d):
    arriving = ingest.enrich(events.raw_events(events.stream_events(spark, d)))
    return silver.to_silver(arriving.where(F.col("wiki").isNotNull()))


def feature_rows(spark, d):
    return features.ml_features(silver_rows(spark, d))


def lagged_rows(spark, d):
    return features.lag_features(silver_rows(spark, d))


def scored_rows(spark, d):
    """Features with a fixed score: short comments look like bots."""
    score = F.lit(1.0) / (F.lit(1.0) + F.col("commentLen"))
    return feature_rows(spark, d).select(
        "id", F.col("isBot").alias("label"), score.alias("score"), (score >= CUTOFF).cast("int").alias("prediction")
    )


def clustered_rows(spark, d):
    return models.nearest_centroid(feature_rows(spark, d), S.CLUSTER_FEATURES, CENTROIDS)


# --- Sources ---

@query("read_raw_events")
def _(spark, d):
    path = shared_dir(spark, "feed")
    lines(spark, d).write.text(path)
    return tables.read_raw_events(tables.read_lines(spark, path)).select(
        "id", "wiki", "title", "timestamp", F.col("length.new").alias("newLength")
    )


@query("read_kafka_stream")
def _(spark, d):
    path = shared_dir(spark, "topic")
    sinks.write_messages(ingest.serialize(enriched(spark, d)), path)
    messages = tables.read_message_stream(spark, path, max_files=4)
    return sinks.run_to_table(bronze.to_bronze(messages), "bronze").select(*RECORD)


@query("read_silver")
def _(spark, d):
    path = shared_dir(spark, "silver")
    silver_rows(spark, d).write.parquet(path)
    return tables.silver_size(tables.read_silver(spark, path))


@query("read_silver_union")
def _(spark, d):
    root = shared_dir(spark, "silver-parts")
    older, newer = features.split_by_key(silver_rows(spark, d).select("id", "title", "comment"), test_share=0.5)
    older.drop("comment").write.parquet(f"{root}/older")
    newer.write.parquet(f"{root}/newer")
    return tables.read_silver_union(spark, f"{root}/older", f"{root}/newer").select("id", "title", "comment")


@query("scan_edit_store")
def _(spark, d):
    path = shared_dir(spark, "store")
    sinks.write_snapshot(store_rows(spark, d), path)
    return tables.scan_store(spark, path).select(*S.STORE_COLUMNS)


# --- Ingest ---

@query("ingest_filter_wiki")
def _(spark, d):
    return ingest.filter_wiki(raw(spark, d), "enwiki").select("id", "wiki")


@query("ingest_filter_types")
def _(spark, d):
    return ingest.filter_types(raw(spark, d), ["edit", "new"]).select("id", "type")


for _name, _column in {
    "namespace_label": "namespace_str", "byte_delta": "byte_delta", "title_len": "title_len", "is_bot_default": "is_bot",
}.items():
    query(_name)(lambda spark, d, c=_column: enriched(spark, d).select("id", c))


@query("ingestion_ts")
def _(spark, d):
    stamped = ingest.stamp_arrival(raw(spark, d).drop("ingestion_ts"))
    return stamped.agg(F.count("ingestion_ts").alias("rows"), F.count_distinct("ingestion_ts").alias("stamps"))


@query("event_key")
def _(spark, d):
    return raw(spark, d).select("id", C.event_key(F.col("wiki")).alias("key"))


@query("serialize_events")
def _(spark, d):
    messages = ingest.serialize(enriched(spark, d))
    back = F.from_json("value", S.EVENT_DDL).alias("e")
    return messages.select("key", back).select("key", *[f"e.{c}" for c in RECORD])


def extended_lines(spark, d):
    """Feed lines with fields outside the schema, a null and a nested object."""
    more = F.concat(
        F.lit('{"extra_field":'), F.get_json_object("value", "$.id"),
        F.lit(',"$schema":"/x/1","gone":null,"deep":{"a":[1,{"b":"}"}]},'), F.substring("value", 2, 1 << 20),
    )
    known = F.get_json_object("value", "$.id").isNotNull()
    return lines(spark, d).select(F.when(known, more).otherwise(F.col("value")).alias("value"))


def published(messages):
    field = lambda path: F.get_json_object("value", path)
    back = F.from_json("value", S.EVENT_DDL).alias("e")
    rows = messages.select(
        "key", back, field("$.extra_field").alias("extra"), field("$['$schema']").alias("other"), field("$.deep").alias("deep"),
        F.col("value").contains('"gone":null').alias("kept_null"),
    )
    return rows.select("key", *[f"e.{c}" for c in RECORD], "extra", "other", "deep", "kept_null")


@query("publish")
def _(spark, d):
    path = shared_dir(spark, "feed")
    extended_lines(spark, d).write.text(path)
    return published(ingest.publishable(tables.read_lines(spark, path)))


@query("publish_stream")
def _(spark, d):
    path = shared_dir(spark, "feed")
    extended_lines(spark, d).write.text(path)
    arriving = ingest.observed(tables.read_lines(spark, path, stream=True))
    return published(sinks.run_to_table(ingest.publishable(arriving), "published"))


@query("ingest_counters")
def _(spark, d):
    return ingest.counters(lines(spark, d), wiki="enwiki", types=["edit", "new"])


@query("stream_counters")
def _(spark, d):
    """The counters of a stream that is stopped and started again, out of the figures saved beside its checkpoint."""
    root, wiki, types = shared_dir(spark, "counted"), "enwiki", ["edit", "new"]
    for half in range(2):
        part = lines(spark, d).where(F.pmod(F.xxhash64("value"), F.lit(2)) == half)
        part.write.mode("append").text(f"{root}/feed")
        totals = sinks.StreamTotals(spark, f"{root}/totals")
        spark.streams.addListener(totals)
        try:
            arriving = ingest.observed(tables.read_lines(spark, f"{root}/feed", stream=True), "feed", wiki, types)
            running = sinks.write_parquet(
                ingest.publishable(arriving, wiki, types), f"{root}/published", f"{root}/checkpoint", available_now=True
            )
            running.awaitTermination()
            totals.wait(running)
        finally:
            spark.streams.removeListener(totals)
    found = totals.totals(running.id)
    names = ("published", "filtered_out", "parse_errors", "blank")
    return spark.createDataFrame([tuple(int(found.get(f"feed.{x}", 0)) for x in names)], ", ".join(f"{x} long" for x in names))


@query("key_ordered_partitions")
def _(spark, d):
    """With a flag: does the row come after the one before it in its partition?"""
    laid = ingest.key_ordered(raw(spark, d)).select(
        "key", "ingestion_ts", "id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")
    )
    own = F.struct("key", "ingestion_ts", "id")
    earlier = F.lag(own).over(Window.partitionBy("part").orderBy("place"))
    return laid.select("key", "ingestion_ts", "id", F.coalesce(earlier <= own, F.lit(True)).alias("in_order"))


# --- Bronze ---

@query("parse_to_bronze")
def _(spark, d):
    parsed = bronze.to_bronze(lines(spark, d))
    return parsed.select(
        "id", "type", "wiki", "title", "namespace", "user", "bot", "minor", "timestamp", "comment", "ingestion_ts",
        F.col("length.new").alias("newLength"),
    )


@query("bronze_rejects")
def _(spark, d):
    return bronze.reject_counts(lines(spark, d))


# --- Silver ---

for _name, _column in {
    "silver_event_time": "eventTime", "silver_ingestion_time": "ingestionTime", "silver_latency_ms": "latencyMs",
    "silver_is_anon": "isAnon", "silver_edit_size": "editSizeCategory", "silver_comment_len": "commentLen",
    "silver_hour": "hourOfDay", "silver_dow": "dayOfWeek", "silver_wiki_lang": "wikiLang", "silver_lang_code": "langCode",
}.items():
    query(_name)(lambda spark, d, c=_column: silver.add(bronze_rows(spark, d), c).select("id", c))


@query("silver_valid_time")
def _(spark, d):
    # Older events of a feed that carries its times relative to AS_OF - 8 days have times <= 0.
    shifted = raw(spark, d).withColumn(
        "timestamp", F.col("timestamp") - F.unix_seconds(F.lit(AS_OF).cast("timestamp")) + 8 * 86400
    )
    return silver.valid_time(shifted).select("id", "timestamp")


@query("silver_known_type")
def _(spark, d):
    return silver.known_type(raw(spark, d)).select("id", "type")


@query("silver")
def _(spark, d):
    return silver_rows(spark, d).select(*SILVER)


# --- Serving ---

@query("serving_rows")
def _(spark, d):
    return store_rows(spark, d)


@query("serving_rejects")
def _(spark, d):
    # New-page events whose time is in microseconds: no timestamp can hold it, so no store key exists.
    wrong = F.when(F.col("type") == "new", F.col("timestamp") * 1_000_000).otherwise(F.col("timestamp"))
    broken = bronze_rows(spark, d).withColumn("timestamp", wrong)
    return serving.serving_rejects(silver.to_silver(broken)).select("id", "type", "timestamp")


def redelivered(spark, d):
    """Store rows in which categorize events lost their id, with new and log events delivered twice."""
    first = store_rows(spark, d).withColumn(
        "event_id", F.when(F.col("type") == "categorize", F.lit(0)).otherwise(F.col("event_id"))
    )
    again = first.where(F.col("type").isin("new", "log")).withColumns(
        {"ingestion_ts": F.col("ingestion_ts") + 60_000, "comment": F.lit("again"), "comment_len": F.lit(5)}
    )
    return first.unionByName(again)


@query("upsert_latest")
def _(spark, d):
    return serving.upsert_latest(redelivered(spark, d))


@query("store_newest_first")
def _(spark, d):
    return serving.latest_per_wiki(store_rows(spark, d), 10).select(
        "wiki", "wiki_lang", "event_time", "event_id", "position"
    )


@query("retention_7d")
def _(spark, d):
    kept = serving.alive(store_rows(spark, d), F.lit(AS_OF).cast("timestamp"))
    return kept.select("event_id", "event_time", "ingestion_ts")


@query("write_parquet_stream")
def _(spark, d):
    return sinks.run_to_table(silver_stream(spark, d), "silver-stream").select(*SILVER)


@query("write_batch")
def _(spark, d):
    root = shared_dir(spark, "store-stream")
    running, _ = sinks.write_store(silver_stream(spark, d), f"{root}/store", f"{root}/checkpoint", available_now=True)
    running.awaitTermination()
    return tables.scan_store(spark, f"{root}/store").select(*S.STORE_COLUMNS)


@query("store_restart")
def _(spark, d):
    """Two streams with checkpoints of their own write one store: half of the events each."""
    root = shared_dir(spark, "store-restart")
    for turn in (0, 1):
        half = silver_stream(spark, d).where(F.col("id") % 2 == turn)
        running, _ = sinks.write_store(half, f"{root}/store", f"{root}/checkpoint-{turn}", available_now=True)
        running.awaitTermination()
    return tables.scan_store(spark, f"{root}/store").select(*S.STORE_COLUMNS)


@query("batch_summary")
def _(spark, d):
    return serving.batch_summary(silver_rows(spark, d))


@query("hourly_summary_stream")
def _(spark, d):
    counted = serving.hourly_stream(serving.serving_rows(silver_stream(spark, d)))
    return sinks.run_to_table(counted, "hourly")


@query("compact_store")
def _(spark, d):
    root = shared_dir(spark, "compaction")
    sinks.write_snapshot(store_rows(spark, d), f"{root}/earlier")
    redelivered(spark, d).write.parquet(f"{root}/store/batch_id=1")
    sinks.compact_store(spark, f"{root}/store", f"{root}/snapshot", F.lit(AS_OF).cast("timestamp"), f"{root}/earlier")
    return tables.scan_store(spark, f"{root}/snapshot").select(*S.STORE_COLUMNS)


@query("scan_keyed_store")
def _(spark, d):
    """A snapshot in buckets, with batches delivered since then merged over it while reading."""
    root = shared_dir(spark, "keyed")
    layers.write_keyed(store_rows(spark, d), f"{root}/snapshot", 8)
    redelivered(spark, d).withColumn("batch_id", F.lit(1)).write.parquet(f"{root}/batches")
    return layers.merged(layers.read_keyed(spark, f"{root}/snapshot"), spark.read.parquet(f"{root}/batches"), "batch_id")


def day_table(spark, d):
    """The store's rows in folders of their ingestion day, delivered in three parts."""
    table = layers.DayTable(spark, shared_dir(spark, "days"))
    rows = written(store_rows(spark, d), "store-rows")
    for k in range(3):
        table.append(rows.where(F.pmod("event_id", F.lit(3)) == k), F.to_date(F.timestamp_millis("ingestion_ts")))
    return table


@query("compact_layer")
def _(spark, d):
    table = day_table(spark, d)
    table.compact("9999-01-01")
    table.sweep(1)
    return table.read().select(*S.STORE_COLUMNS)


@query("expire_layer")
def _(spark, d):
    """Days beyond the time to live are forgotten as folders; only the border day is rewritten."""
    table, as_of = day_table(spark, d), F.lit(AS_OF).cast("timestamp")
    border = spark.range(1).select(F.to_date(F.timestamp_millis(F.unix_millis(as_of) - S.RETENTION_SECONDS * 1000)).cast("string")).first()[0]
    table.expire(F.col("ingestion_ts") > F.unix_millis(as_of) - F.lit(S.RETENTION_SECONDS * 1000), border)
    return table.read().select("event_id", "event_time", "ingestion_ts")


@query("hourly_summary")
def _(spark, d):
    return serving.hourly_summary(store_rows(spark, d))


# --- Gold ---

GOLD_NUMBERS = ("totalEdits", "botEdits", "anonEdits", "avgByteDelta", "avgCommentLen")
WINDOW = ("windowStart", "windowEnd", "wiki")


@query("gold_filter")
def _(spark, d):
    return gold.article_edits(silver_rows(spark, d)).select("id", "type", "namespace")


@query("gold_watermark")
def _(spark, d):
    counted = gold.flatten_window(gold.windowed(silver_stream(spark, d)))
    return sinks.run_to_table(counted.select(*WINDOW, "totalEdits"), "gold-watermark")


@query("gold_tumbling")
def _(spark, d):
    return gold.flatten_window(gold.windowed(silver_rows(spark, d))).select(*WINDOW, "totalEdits")


@query("gold")
def _(spark, d):
    return gold.to_gold(silver_rows(spark, d), exact=True)


@query("gold_unique_editors")
def _(spark, d):
    return gold.to_gold(silver_rows(spark, d), exact=True).select(*WINDOW, "uniqueEditors")


@query("gold_unique_editors_approx")
def _(spark, d):
    return gold.to_gold(silver_rows(spark, d)).select(*WINDOW, "uniqueEditors")


@query("gold_ratios")
def _(spark, d):
    rated = gold.flatten_window(gold.with_ratios(gold.windowed(silver_rows(spark, d))))
    return rated.select(*WINDOW, "botRatio", "anonRatio")


@query("gold_vandalism_flag")
def _(spark, d):
    return gold.to_gold(silver_rows(spark, d)).select(*WINDOW, "vandalismFlag")


@query("gold_flatten_window")
def _(spark, d):
    return gold.flatten_window(gold.windowed(silver_rows(spark, d))).select(*WINDOW)


def _without_sketch(df):
    return df.select(*WINDOW, *GOLD_NUMBERS, "botRatio", "anonRatio", "vandalismFlag")


@query("gold_stream")
def _(spark, d):
    return sinks.run_to_table(_without_sketch(gold.to_gold(silver_stream(spark, d))), "gold-stream")


@query("gold_late_rows")
def _(spark, d):
    """All events, then the same events again in a later run: every closed window stays as it was."""
    root = shared_dir(spark, "gold-late")
    rows = silver_rows(spark, d).select(*SILVER)
    for turn in (1, 2):
        rows.write.mode("append").parquet(f"{root}/silver")
        arriving = spark.readStream.schema(rows.schema).parquet(f"{root}/silver")
        late = _without_sketch(gold.to_gold(arriving))
        sinks.write_parquet(late, f"{root}/gold", f"{root}/checkpoint", available_now=True).awaitTermination()
    return spark.read.parquet(f"{root}/gold")


@query("gold_rollup_editors")
def _(spark, d):
    """Editors per hour and wiki from stored window sketches."""
    stored = written(sketches.editor_sketches(silver_rows(spark, d)), "editor-sketches")
    return sketches.rollup_editors(stored)


@query("gold_rollup_editors_stream")
def _(spark, d):
    """The same from the sketches of the windows that a stream has closed."""
    stored = sinks.run_to_table(sketches.editor_sketches(silver_stream(spark, d)), "gold-sketches")
    return sketches.rollup_editors(stored)


SHARES = {"median": 0.5, "p95": 0.95}


@query("q2_size_sketches")
def _(spark, d):
    """Median and 95th percentile of edit sizes per wiki from stored day sketches."""
    return sketches.merged_percentiles(written(sketches.size_sketches(store_rows(spark, d)), "size-sketches"), SHARES)


@query("stream_multi_sink")
def _(spark, d):
    root = shared_dir(spark, "pipeline")
    sinks.write_messages(ingest.serialize(enriched(spark, d)), f"{root}/topic")
    run = pipeline.start(tables.read_message_stream(spark, f"{root}/topic"), root, available_now=True)
    layers = {layer: spark.read.parquet(run.path(layer)) for layer in ("bronze", "silver", "gold")}
    layers["store"] = tables.scan_store(spark, run.path("store"))
    sizes = [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("layer"), "rows") for n, df in layers.items()]
    return sizes[0].union(sizes[1]).union(sizes[2]).union(sizes[3])


# --- Reports ---

_REPORT_NAMES = {
    "q1": "q1_edit_spikes", "q2": "q2_median_edit_size", "q3": "q3_multi_user_pages", "q4": "q4_repeated_edits",
    "q5": "q5_cross_language", "q6": "q6_edit_sessions", "q7": "q7_max_edits_per_day", "q8": "q8_high_impact",
    "q9": "q9_comment_bins", "q10": "q10_size_by_lang", "q11": "q11_collaboration", "q12": "q12_outlier_edits",
}
for _key, _name in _REPORT_NAMES.items():
    query(_name)(lambda spark, d, k=_key: registry.run_report(store_rows(spark, d), k))
    if _key != "q9":
        query(f"{_name}_all")(lambda spark, d, k=_key: registry.run_report(store_rows(spark, d), k, top=None))


@query("q6_sessions_stream")
def _(spark, d):
    arriving = serving.serving_rows(silver_stream(spark, d))
    return sinks.run_to_table(edits.session_stream(arriving), "sessions")


@query("query_registry")
def _(spark, d):
    return registry.report_sizes(written(store_rows(spark, d), "store-rows"))


@query("x1_negative_latency")
def _(spark, d):
    return edits.negative_latency(store_rows(spark, d))


@query("x2_dominant_editors")
def _(spark, d):
    return edits.dominant_editors(store_rows(spark, d))


@query("x2_dominant_editors_all")
def _(spark, d):
    return edits.dominant_editors(store_rows(spark, d), top=None)


@query("x3_time_profile")
def _(spark, d):
    return edits.time_profile(store_rows(spark, d))


@query("x4_comment_size_corr")
def _(spark, d):
    return edits.comment_size_correlation(store_rows(spark, d))


@query("x5_day_streak")
def _(spark, d):
    return edits.day_streaks(store_rows(spark, d))


@query("x5_day_streak_all")
def _(spark, d):
    return edits.day_streaks(store_rows(spark, d), top=None)


# --- Trends ---

for _name, _fn in {
    "top_pages": trends.top_pages, "hourly_edits": trends.hourly_edits, "top_wikis": trends.top_wikis,
    "size_distribution": trends.size_distribution, "bot_ratio_by_wiki": trends.bot_ratio_by_wiki,
}.items():
    query(_name)(lambda spark, d, f=_fn: f(silver_rows(spark, d)))
    if _name in ("top_pages", "top_wikis", "bot_ratio_by_wiki"):
        query(f"{_name}_all")(lambda spark, d, f=_fn: f(silver_rows(spark, d), n=None))


# --- Overview ---

@query("kpi_silver")
def _(spark, d):
    return overview.kpi_silver(silver_rows(spark, d).select(*SILVER))


@query("kpi_store")
def _(spark, d):
    return overview.kpi_store(store_rows(spark, d))


@query("schema_table")
def _(spark, d):
    return overview.schema_table(silver_rows(spark, d).select(*SILVER))


@query("sample_rows")
def _(spark, d):
    return overview.sample_rows(silver_rows(spark, d))


@query("sample_store_rows")
def _(spark, d):
    return overview.sample_rows(store_rows(spark, d), S.STORE_DISPLAY_COLUMNS, key="event_id")


@query("class_distribution")
def _(spark, d):
    return overview.class_distribution(feature_rows(spark, d))


@query("delta_histogram")
def _(spark, d):
    rows = feature_rows(spark, d)
    big = F.col("absDelta") > BIG_CHANGE
    normal = overview.delta_histogram(rows.where(~big), 50).withColumn("kind", F.lit("normal"))
    return normal.unionByName(overview.delta_histogram(rows.where(big), 20).withColumn("kind", F.lit("anomaly")))


@query("chart_top_n")
def _(spark, d):
    pages = trends.top_pages(silver_rows(spark, d), n=None)
    return overview.chart_top_n(pages, "title", [F.desc("editCount"), "title"], width=6)


@query("scatter_points")
def _(spark, d):
    flagged = feature_rows(spark, d).withColumn("anomaly", (F.col("absDelta") > BIG_CHANGE).cast("int"))
    return overview.scatter_points(flagged, columns=("id", "byte_delta", "commentLen", "anomaly"))


# --- Features ---

@query("ml_features")
def _(spark, d):
    return feature_rows(spark, d)


@query("feature_stats")
def _(spark, d):
    return features.feature_stats(feature_rows(spark, d))


@query("assemble_vector")
def _(spark, d):
    vector = vector_to_array(F.col("features"))
    packed = features.assemble(feature_rows(spark, d), S.BOT_FEATURES)
    return packed.select("id", *[vector[i].alias(f"f{i}") for i in range(len(S.BOT_FEATURES))])


def _rounded(df, columns):
    return df.select("id", *[F.round(c, 6).alias(c) for c in columns])


@query("standard_scale")
def _(spark, d):
    return _rounded(features.standard_scale(feature_rows(spark, d), S.BOT_FEATURES), S.BOT_FEATURES)


@query("standard_scale_population")
def _(spark, d):
    return _rounded(features.standard_scale(feature_rows(spark, d), S.BOT_FEATURES, sample=False), S.BOT_FEATURES)


@query("minmax_scale")
def _(spark, d):
    return _rounded(features.minmax_scale(feature_rows(spark, d), S.CLUSTER_FEATURES), S.CLUSTER_FEATURES)


@query("train_test_split")
def _(spark, d):
    train, test = features.split_by_key(feature_rows(spark, d))
    return train.select("id", F.lit("train").alias("side")).union(test.select("id", F.lit("test").alias("side")))


@query("minute_series")
def _(spark, d):
    return features.minute_series(silver_rows(spark, d))


@query("lag_features")
def _(spark, d):
    return lagged_rows(spark, d)


@query("lag_features_dense")
def _(spark, d):
    return features.lag_features_dense(silver_rows(spark, d))


# --- Models ---

def _bot_predictions(pipe_for, spark, d):
    train, test = features.split_by_key(feature_rows(spark, d))
    train = train.persist()
    try:
        model = pipe_for(train).fit(train)
    finally:
        train.unpersist()
    return models.with_probability(model.transform(test)).select("id", "isBot", "prediction", "botProbability")


@query("bot_rf")
def _(spark, d):
    return _bot_predictions(lambda train: models.bot_forest(), spark, d)


@query("bot_lr")
def _(spark, d):
    return _bot_predictions(lambda train: models.bot_logistic(train.count()), spark, d)


@query("bot_dt")
def _(spark, d):
    return _bot_predictions(lambda train: models.bot_tree(), spark, d)


@query("bot_model_selection")
def _(spark, d):
    chosen = models.select_bot_model(feature_rows(spark, d))
    return chosen.predictions().select("id", F.lit(chosen.best).alias("model"), "isBot", "prediction", "botProbability")


@query("edit_clusters")
def _(spark, d):
    rows = feature_rows(spark, d)
    return models.edit_clusters(rows, starts=3).transform(rows).select("id", "cluster")


@query("nearest_centroid")
def _(spark, d):
    return clustered_rows(spark, d).select("id", "cluster")


@query("cluster_profiles")
def _(spark, d):
    return models.cluster_profiles(clustered_rows(spark, d))


@query("isolation_forest")
def _(spark, d):
    return iforest.fit_predict(feature_rows(spark, d), S.CLUSTER_FEATURES)[1].select("id", "score", "anomaly", "outlier")


def _forecast_rows(lagged, by_time=False):
    """The test rows with their predictions; no rows where there is nothing to learn from or to test on."""
    forecast = models.volume_forecast(lagged, by_time=by_time)
    found = forecast.predictions if forecast else lagged.limit(0).withColumn("prediction", F.lit(0.0))
    return found.select("wiki", "windowStart", "editCount", "prediction", "hourOfDay")


@query("volume_forecast")
def _(spark, d):
    return _forecast_rows(lagged_rows(spark, d)).orderBy("windowStart", "wiki")


@query("volume_forecast_by_time")
def _(spark, d):
    return _forecast_rows(lagged_rows(spark, d), by_time=True)


@query("feature_importances")
def _(spark, d):
    train, _ = features.split_by_key(feature_rows(spark, d))
    return models.feature_importances(models.bot_forest().fit(train), S.BOT_FEATURES)


@query("prediction_sample")
def _(spark, d):
    train, test = features.split_by_key(feature_rows(spark, d))
    predicted = models.bot_tree().fit(train).transform(test)
    return predicted.orderBy("id").limit(10).select("user", "isBot", "prediction", "byte_delta", "commentLen")


@query("save_model")
def _(spark, d):
    train, test = features.split_by_key(feature_rows(spark, d))
    path = shared_dir(spark, "model")
    models.save_model(models.bot_tree().fit(train), path)
    return models.load_model(path).transform(test).select("id", "isBot", "prediction")


@query("load_model")
def _(spark, d):
    train, _ = features.split_by_key(feature_rows(spark, d))
    path = shared_dir(spark, "model")
    models.save_model(models.bot_tree().fit(train), path)
    return models.feature_importances(models.load_model(path), S.BOT_FEATURES)


# --- Evaluation ---

@query("roc_auc")
def _(spark, d):
    return evaluate.roc_auc(scored_rows(spark, d))


@query("roc_curve")
def _(spark, d):
    return evaluate.roc_curve(scored_rows(spark, d))


@query("confusion_matrix")
def _(spark, d):
    return evaluate.confusion_matrix(scored_rows(spark, d))


@query("classification_report")
def _(spark, d):
    return evaluate.classification_report(scored_rows(spark, d))


@query("silhouette")
def _(spark, d):
    rows = features.assemble(clustered_rows(spark, d), S.CLUSTER_FEATURES)
    return models.metrics_frame(spark, {("centroids", "silhouette"): evaluate.silhouette(rows)})


@query("regression_metrics")
def _(spark, d):
    mean = (F.col("editLag1") + F.col("editLag2") + F.col("editLag3")) / 3.0
    scored = lagged_rows(spark, d).withColumn("prediction", mean)
    m = evaluate.regression_metrics(scored, "editCount")
    return m.select(F.round("rmse", 6).alias("rmse"), F.round("r2", 6).alias("r2"), "rows")


@query("auc_comparison")
def _(spark, d):
    chosen = models.select_bot_model(feature_rows(spark, d))
    return models.metrics_frame(spark, {(name, "auc"): auc for name, auc in chosen.auc.items()})


@query("training_summary")
def _(spark, d):
    return training.train_all(silver_rows(spark, d)).summary


@query("save_metrics")
def _(spark, d):
    path = shared_dir(spark, "metrics")
    chosen = models.select_bot_model(feature_rows(spark, d))
    figures = models.metrics_frame(spark, {(n, "auc"): a for n, a in chosen.auc.items()})
    models.save_metrics(figures.unionByName(training.report_metrics(chosen)), path)
    return spark.read.parquet(path)


# --- Percentiles on a wide table ---

@query("percentile_quantity")
def _(spark, d):
    rows = spark.read.parquet(f"{d}/lineitem.parquet").select(
        "l_returnflag", F.col("l_extendedprice").cast("decimal(15,2)").alias("price")
    )
    found = exact_percentile(rows, "price", 0.95, ["l_returnflag"], "p95")
    return found.withColumn("p95", F.round("p95", 4))


# --- What must hold of trained models, whatever they learn: compared with SQL row by row ---

def _sane(df):
    good = F.col("prediction").isin(0.0, 1.0) & F.col("botProbability").between(0.0, 1.0)
    return df.select("id", "isBot", F.coalesce(good, F.lit(False)).alias("sane"))


for _name in ("bot_rf", "bot_lr", "bot_dt", "bot_model_selection"):
    query(f"{_name}_checked")(lambda spark, d, n=_name: _sane(QUERIES[n](spark, d)))


@query("edit_clusters_checked")
def _(spark, d):
    return QUERIES["edit_clusters"](spark, d).select("id", F.col("cluster").between(0, 4).alias("sane"))


@query("isolation_forest_checked")
def _(spark, d):
    flagged = QUERIES["isolation_forest"](spark, d)
    share = F.avg("anomaly")
    return flagged.agg(
        F.count("*").alias("rows"),
        (share.between(0.03, 0.06)).alias("share_as_asked"),
        F.bool_and(F.col("score").between(0.0, 1.0)).alias("scores_in_range"),
        F.bool_and(F.col("outlier") == F.when(F.col("anomaly") == 1, -1).otherwise(1)).alias("signs_agree"),
    )


@query("volume_forecast_checked")
def _(spark, d):
    found = QUERIES["volume_forecast"](spark, d)
    return found.select("wiki", "windowStart", "editCount", "hourOfDay", (~F.isnan("prediction")).alias("sane"))


def _importances(df):
    return df.agg(
        F.count("*").alias("features"), (F.abs(F.sum("importance") - 1) < 1e-6).alias("sum_to_one"),
        F.bool_and(F.col("importance") >= 0).alias("none_negative"),
    )


@query("feature_importances_checked")
def _(spark, d):
    return _importances(QUERIES["feature_importances"](spark, d))


@query("load_model_checked")
def _(spark, d):
    return _importances(QUERIES["load_model"](spark, d))


@query("prediction_sample_checked")
def _(spark, d):
    rows = QUERIES["prediction_sample"](spark, d)
    return rows.select("user", "isBot", "byte_delta", "commentLen", F.col("prediction").isin(0.0, 1.0).alias("sane"))


@query("save_model_checked")
def _(spark, d):
    """The saved tree predicts what the fitted one does."""
    train, test = features.split_by_key(feature_rows(spark, d))
    path = shared_dir(spark, "model")
    fitted = models.bot_tree().fit(train)
    models.save_model(fitted, path)
    one = fitted.transform(test).select("id", "isBot", F.col("prediction").alias("fitted"))
    two = models.load_model(path).transform(test).select("id", F.col("prediction").alias("loaded"))
    return one.join(two, "id").select("id", "isBot", (F.col("fitted") == F.col("loaded")).alias("sane"))


@query("silhouette_checked")
def _(spark, d):
    return QUERIES["silhouette"](spark, d).select(F.round("value", 6).alias("silhouette"))


def _named(df):
    """The figures' names, and that shares lie between 0 and 1."""
    share = F.col("metric").isin("auc", "best_auc", "precision", "recall", "f1")
    sane = F.col("text").isNotNull() | F.coalesce(F.when(share, F.col("value").between(0.0, 1.0)).otherwise(~F.isnan("value")), F.lit(False))
    return df.select("model", "metric", sane.alias("sane"))


@query("auc_comparison_checked")
def _(spark, d):
    return _named(QUERIES["auc_comparison"](spark, d))


@query("training_summary_checked")
def _(spark, d):
    return _named(QUERIES["training_summary"](spark, d))


@query("gold_unique_editors_approx_checked")
def _(spark, d):
    """Approximate editors of each window lie within 15 % of the exact ones."""
    near = QUERIES["gold_unique_editors_approx"](spark, d).withColumnRenamed("uniqueEditors", "near")
    both = QUERIES["gold_unique_editors"](spark, d).join(near, list(WINDOW))
    return both.select(*WINDOW, "uniqueEditors", (F.abs(F.col("near") - F.col("uniqueEditors")) <= F.greatest(F.lit(1.0), 0.15 * F.col("uniqueEditors"))).alias("sane"))


def _editors_near(found, exact):
    """Estimated editors of each hour lie within 5 % (or one) of the exact ones."""
    near = F.abs(F.col("near") - F.col("uniqueEditors")) <= F.greatest(F.lit(1.0), 0.05 * F.col("uniqueEditors"))
    both = found.withColumnRenamed("uniqueEditors", "near").join(exact, ["windowStart", "wiki"], "left")
    return both.select("windowStart", "wiki", "totalEdits", "uniqueEditors", F.coalesce(near, F.lit(False)).alias("sane"))


def _hourly_editors(article):
    hour = F.date_trunc("hour", "eventTime").alias("windowStart")
    return article.groupBy(hour, "wiki").agg(F.count_distinct("user").alias("uniqueEditors"))


@query("gold_rollup_editors_checked")
def _(spark, d):
    exact = _hourly_editors(gold.article_edits(silver_rows(spark, d)))
    return _editors_near(QUERIES["gold_rollup_editors"](spark, d), exact)


@query("gold_rollup_editors_stream_checked")
def _(spark, d):
    """Held against the exact editors of the windows that the watermark has closed."""
    article = gold.article_edits(silver_rows(spark, d))
    closing = article.agg(F.max("eventTime") - F.expr(f"interval {S.GOLD_WATERMARK}")).scalar()
    exact = _hourly_editors(article.where(F.window("eventTime", S.GOLD_WINDOW)["end"] <= closing))
    return _editors_near(QUERIES["gold_rollup_editors_stream"](spark, d), exact)


@query("q2_size_sketches_checked")
def _(spark, d):
    """The rank of each reported value, counted exactly, lies within 1 % of its share."""
    sizes = store_rows(spark, d).where("type = 'edit'").select("wiki", "byte_delta")
    ranked = sizes.join(QUERIES["q2_size_sketches"](spark, d), "wiki")
    def share(test):
        return F.avg(F.when(test, 1.0).otherwise(0.0))
    tests = [
        ((share(F.col("byte_delta") < F.col(n)) <= p + 0.01) & (share(F.col("byte_delta") <= F.col(n)) >= p - 0.01)).alias(f"{n}_near")
        for n, p in SHARES.items()
    ]
    return ranked.groupBy("wiki", "edits").agg(*tests)


# --- Floors that a constant or random predictor does not reach ---

AUC_FLOOR = 0.8


for _name in ("bot_rf", "bot_lr", "bot_dt", "bot_model_selection"):
    @query(f"{_name}_floor_checked")
    def _(spark, d, name=_name):
        area = evaluate.roc_auc(QUERIES[name](spark, d), "botProbability", "isBot")
        return area.select("positives", "negatives", (F.col("areaUnderROC") >= AUC_FLOOR).alias("above_floor"))


@query("edit_clusters_floor_checked")
def _(spark, d):
    """Five clusters leave at most half of the scaled features' spread; a random assignment leaves nearly all."""
    scaled = features.minmax_scale(feature_rows(spark, d), S.CLUSTER_FEATURES)
    found = scaled.join(QUERIES["edit_clusters"](spark, d), "id")

    def spread(rows, *keys):
        moments = rows.groupBy(*keys).agg(
            F.count("*").alias("rows"), sum(F.var_pop(c) for c in S.CLUSTER_FEATURES).alias("variance")
        )
        return moments.agg(
            F.sum("rows").alias("rows"), F.sum(F.col("rows") * F.col("variance")).alias("spread"), F.count("*").alias("clusters")
        )

    whole = spread(scaled).select(F.col("spread").alias("all"), F.col("rows").alias("allRows"))
    return spread(found, "cluster").join(F.broadcast(whole), F.col("rows") == F.col("allRows")).select(
        "rows", "clusters", (F.col("spread") <= 0.5 * F.col("all")).alias("tight")
    )


@query("isolation_forest_floor_checked")
def _(spark, d):
    """Planted rows far from all others, one in a hundred, are flagged, and few others are."""
    rows = feature_rows(spark, d).select("id", *[F.col(c).cast("double").alias(c) for c in S.CLUSTER_FEATURES])
    size = F.lit(1e6) + F.col("id") % 997 * 1000
    far = {"byte_delta": -size, "absDelta": size, "title_len": F.lit(5e3) + F.col("id") % 89, "commentLen": F.lit(5e3) + F.col("id") % 97}
    planted = rows.where(F.col("id") % 100 == 0).withColumns(far).withColumn("id", -F.col("id") - 1)
    flagged = iforest.fit_predict(rows.unionByName(planted), S.CLUSTER_FEATURES)[1]
    return flagged.agg(
        F.count_if(F.col("id") < 0).alias("planted"),
        (F.avg(F.when(F.col("id") < 0, F.col("anomaly"))) >= 0.99).alias("caught"),
        (F.avg(F.when(F.col("id") >= 0, F.col("anomaly"))) <= 0.05).alias("others_left"),
    )


def _beats_lags(spark, d, name):
    """The forecast's test rows, and whether its squared error is below that of the mean of three lags."""
    lagged = lagged_rows(spark, d)
    found = QUERIES[name](spark, d).select("wiki", "windowStart", "prediction").join(lagged, ["wiki", "windowStart"])
    mean = (F.col("editLag1") + F.col("editLag2") + F.col("editLag3")) / 3.0
    error, naive = (F.avg(F.pow(F.col("editCount") - c, F.lit(2.0))) for c in (F.col("prediction"), mean))
    return found.agg(F.count("*").alias("rows"), (error < naive).alias("beats_lags"))


@query("volume_forecast_floor_checked")
def _(spark, d):
    return _beats_lags(spark, d, "volume_forecast")


@query("volume_forecast_by_time_checked")
def _(spark, d):
    """Tested on the end of the time span alone, and on all of it.

    There is no floor for the error: of the smallest table's few minutes the forecast by time does not
    beat the mean of three lags.
    """
    lagged = lagged_rows(spark, d)
    found = QUERIES["volume_forecast_by_time"](spark, d)
    rows = found.count()
    tail = lagged.where(F.col("windowStart") >= found.agg(F.min("windowStart")).scalar()).count()
    share = rows / max(lagged.count(), 1)
    finite = (~F.isnan("prediction")) & (F.abs("prediction") < 1e9)
    return found.agg(F.bool_and(finite).alias("finite")).select(
        "finite", F.lit(tail == rows).alias("all_late"), F.lit(0.1 <= share <= 0.21).alias("a_fifth")
    )


@query("save_metrics_checked")
def _(spark, d):
    """The saved areas are those of the classifiers' own predictions, computed another way."""
    saved = QUERIES["save_metrics"](spark, d).where("metric = 'auc'")
    fitted = {"LogisticRegression": "bot_lr", "DecisionTree": "bot_dt", "RandomForest": "bot_rf"}
    own = [
        evaluate.roc_auc(QUERIES[n](spark, d), "botProbability", "isBot").select(F.lit(m).alias("model"), "areaUnderROC")
        for m, n in fitted.items()
    ]
    both = saved.join(own[0].union(own[1]).union(own[2]), "model", "left")
    return both.select("model", F.coalesce(F.abs(F.col("value") - F.col("areaUnderROC")) < 1e-9, F.lit(False)).alias("sane"))
