"""Streams: equal to batch, late rows, restarts, repeated delivery, the whole pipeline."""

from datetime import datetime

import time

import pytest
from pyspark.sql import functions as F

from editengine import schema as S
from editengine.operators import edits, gold, ingest, serving, silver
from editengine.plans import catalog
from editengine.sources import events, tables
from editengine.streaming import pipeline, sinks

COLUMNS = [*catalog.WINDOW, *catalog.GOLD_NUMBERS]


def edit_rows(spark, *times):
    rows = [(i, datetime.fromisoformat(f"2024-01-01T{t}"), "enwiki", "edit", 0, "u", False, False, 1, 1) for i, t in enumerate(times)]
    return spark.createDataFrame(
        rows, "id long, eventTime timestamp, wiki string, type string, namespace int, user string, bot boolean, "
        "isAnon boolean, byte_delta int, commentLen int",
    )


def run_gold(spark, root, schema):
    arriving = spark.readStream.schema(schema).parquet(f"{root}/silver")
    query = sinks.write_parquet(gold.to_gold(arriving), f"{root}/gold", f"{root}/ck", available_now=True)
    query.awaitTermination()
    return query


def windows(spark, root):
    return {(r["windowStart"].strftime("%H:%M"), r["totalEdits"]) for r in spark.read.parquet(f"{root}/gold").collect()}


def test_late_rows_and_restart(spark, tmp_path):
    root = str(tmp_path)
    first = edit_rows(spark, "00:01:00", "00:20:00")
    first.coalesce(1).write.parquet(f"{root}/silver")
    run_gold(spark, root, first.schema)
    assert windows(spark, root) == {("00:00", 1)}
    edit_rows(spark, "00:01:30", "00:19:30", "00:30:00").coalesce(1).write.mode("append").parquet(f"{root}/silver")
    late = sinks.LateRows()
    spark.streams.addListener(late)
    query = run_gold(spark, root, first.schema)
    assert windows(spark, root) == {("00:00", 1), ("00:15", 1), ("00:20", 1)}
    for _ in range(50):
        if late.dropped.get(str(query.id)):
            break
        time.sleep(0.2)
    spark.streams.removeListener(late)
    assert late.dropped[str(query.id)] == 1
    run_gold(spark, root, first.schema)  # nothing new: nothing is emitted twice
    assert spark.read.parquet(f"{root}/gold").count() == 3


def test_gold_stream_equals_batch_over_several_files(spark, small, tmp_path):
    rows = catalog.silver_rows(spark, small).select(*catalog.SILVER)
    # Files in time order, as a feed would deliver them.
    for i, (low, high) in enumerate(((0, 1), (1, 2), (2, 9))):
        day = F.datediff("eventTime", F.lit("2024-01-01"))
        rows.where((day >= low) & (day < high)).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    arriving = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    query = sinks.write_parquet(gold.to_gold(arriving), f"{tmp_path}/gold", f"{tmp_path}/ck", available_now=True)
    query.awaitTermination()
    last = rows.where("type = 'edit' and namespace = 0").agg(F.max("eventTime")).first()[0]
    batch = gold.to_gold(rows).where(F.col("windowEnd") <= F.lit(last) - F.expr("interval 1 minute")).select(*COLUMNS)
    streamed = spark.read.parquet(f"{tmp_path}/gold").select(*COLUMNS)
    assert streamed.count() == batch.count() > 400
    assert streamed.exceptAll(batch).count() == 0


def test_session_stream_equals_batch(spark, small):
    rows = serving.serving_rows(catalog.silver_stream(spark, small))
    streamed = sinks.run_to_table(edits.session_stream(rows), "sessions")
    store = catalog.store_rows(spark, small)
    last = store.where("type = 'edit'").agg(F.max("event_time")).first()[0]
    closed = edits.edit_sessions(store, None).where(
        F.col("sessionEnd") + F.expr("interval 30 minutes") <= F.lit(last) - F.expr("interval 1 minute")
    )
    columns = ["user_name", "sessionEdits", "sessionStart", "sessionEnd", "durationMin"]
    assert sorted(map(tuple, streamed.select(*columns).collect())) == sorted(map(tuple, closed.select(*columns).collect()))


def test_store_writer_is_idempotent(spark, small, tmp_path):
    batch = catalog.silver_rows(spark, small)
    target = sinks.StoreWriter(str(tmp_path))
    target(batch.where("id % 2 = 0"), 0)
    target(batch.where("id % 2 = 1"), 1)
    target(batch.where("id % 2 = 1"), 1)  # delivered again
    target(batch.limit(0), 2)
    assert sum(1 for _ in tmp_path.glob("stream=*/batch_id=*")) == 3
    assert target.summaries[1] == target.summaries[2]
    summary = serving.batch_summary(batch).first().asDict()
    assert {k: target.summaries[0][k] + target.summaries[1][k] for k in summary} == summary
    found = tables.scan_store(spark, str(tmp_path))
    wanted = catalog.store_rows(spark, small)
    assert found.select(*S.STORE_COLUMNS).exceptAll(wanted).count() == 0 and found.count() == wanted.count()


def test_later_batch_wins_over_arrival_time(spark, small, tmp_path):
    rows = catalog.store_rows(spark, small).limit(5)
    rows.withColumn("comment", F.lit("first")).write.parquet(f"{tmp_path}/s/batch_id=0")
    rows.withColumns({"comment": F.lit("second"), "ingestion_ts": F.lit(1).cast("long")}).write.parquet(f"{tmp_path}/s/batch_id=1")
    assert {r["comment"] for r in tables.scan_store(spark, f"{tmp_path}/s").collect()} == {"second"}


def test_batches_are_read_over_a_snapshot(spark, small, tmp_path):
    rows = catalog.store_rows(spark, small)
    sinks.write_snapshot(rows, f"{tmp_path}/snap")
    newer = rows.where("type = 'edit'").withColumns({"comment": F.lit("newer"), "ingestion_ts": F.lit(1).cast("long"), "written_ms": F.lit(5).cast("long")})
    newer.write.parquet(f"{tmp_path}/s/stream=a/batch_id=0")
    found = tables.scan_store(spark, f"{tmp_path}/s", snapshot=f"{tmp_path}/snap")
    assert found.count() == rows.count() and found.where("comment = 'newer'").count() == rows.where("type = 'edit'").count()
    sinks.compact_store(spark, f"{tmp_path}/s", f"{tmp_path}/next", earlier=f"{tmp_path}/snap")
    again = tables.scan_store(spark, f"{tmp_path}/next").select(*S.STORE_COLUMNS)
    assert again.exceptAll(found.select(*S.STORE_COLUMNS)).count() == 0 and again.count() == rows.count()


def test_compaction_deals_rows_out_once(spark, small):
    laid = serving.upsert_latest(serving.by_wiki_and_day(catalog.store_rows(spark, small)), also=("event_date", "salt"))
    assert laid._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1


def test_layer_tables_may_have_folders_per_day(spark, small, tmp_path):
    rows = catalog.silver_rows(spark, small).select("id", "wiki", F.to_date("eventTime").alias("event_date"))
    rows.write.parquet(f"{tmp_path}/in")
    arriving = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    sinks.write_parquet(arriving, f"{tmp_path}/out", f"{tmp_path}/ck", available_now=True, partition_by=("event_date",)).awaitTermination()
    day = spark.read.parquet(f"{tmp_path}/out").where("event_date = '2024-01-02'")
    assert "PartitionFilters: [isnotnull(event_date" in day._jdf.queryExecution().executedPlan().toString() and day.count() > 0


def test_snapshot_is_read_without_a_shuffle_and_prunes(spark, small, tmp_path):
    sinks.write_snapshot(catalog.store_rows(spark, small), f"{tmp_path}/snap")
    plan = tables.scan_store(spark, f"{tmp_path}/snap").where("wiki = 'enwiki'")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PartitionFilters: [isnotnull(wiki" in plan


def test_pipeline_layers(spark, small, tmp_path):
    root = str(tmp_path)
    sinks.write_messages(ingest.serialize(catalog.enriched(spark, small)), f"{root}/topic")
    source = tables.read_message_stream(spark, f"{root}/topic")
    run = pipeline.start(source, root, available_now=True)
    assert set(run.queries) == {"bronze", "silver", "gold", "store"}
    seen = [p.observedMetrics["ingest"].messages for p in run.queries["bronze"].recentProgress if "ingest" in p.observedMetrics]
    assert sum(seen) == 1000
    count = lambda layer: spark.read.parquet(run.path(layer)).count()
    assert count("silver") == tables.scan_store(spark, run.path("store")).count() == 979
    before = count("gold")
    pipeline.start(source, root, available_now=True)  # restart: nothing is read twice
    assert (count("silver"), count("gold")) == (979, before)


def test_pipeline_runs_continuously(spark, small, tmp_path):
    root = str(tmp_path)
    messages = ingest.serialize(catalog.enriched(spark, small))
    sinks.write_messages(messages, f"{root}/topic")
    run = pipeline.start(tables.read_message_stream(spark, f"{root}/topic"), root, every="1 second")
    try:
        for layer in ("bronze", "silver", "store"):
            run.queries[layer].processAllAvailable()
        assert tables.scan_store(spark, run.path("store")).count() == 979
    finally:
        run.stop()
    assert not any(q.isActive for q in run.queries.values())


def test_rate_limit(spark, small, tmp_path):
    ingest.serialize(catalog.enriched(spark, small)).repartition(4).write.parquet(f"{tmp_path}/topic")
    arriving = tables.read_message_stream(spark, f"{tmp_path}/topic", max_files=1)
    query = sinks.write_parquet(arriving, f"{tmp_path}/out", f"{tmp_path}/ck", available_now=True)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p.numInputRows]) == 4


def test_kafka_source_needs_its_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        tables.read_kafka_stream(spark, "localhost:9092", "edits")


def test_shared_dir_follows_the_setting(spark):
    from editengine.session import shared_dir

    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_silver_is_the_same_from_stream_and_json(spark, small):
    from editengine.operators import bronze

    columns = catalog.SILVER
    direct = catalog.silver_rows(spark, small).select(*columns)
    parsed = silver.to_silver(bronze.to_bronze(ingest.serialize(catalog.enriched(spark, small)))).select(*columns)
    assert direct.exceptAll(parsed).count() == 0 and direct.count() == parsed.count()
    assert events.stream_events(spark, small, max_files=1).isStreaming


def test_empty_store_and_expired_rows(spark, small, tmp_path):
    assert tables.scan_store(spark, f"{tmp_path}/none").columns == list(S.STORE_COLUMNS)
    rows = catalog.store_rows(spark, small).where("type = 'edit'").limit(4)
    rows.write.parquet(f"{tmp_path}/s/batch_id=0")
    newer = rows.withColumn("ingestion_ts", F.lit(0).cast("long"))
    newer.write.parquet(f"{tmp_path}/s/batch_id=1")
    # The newer version has expired; the older one stays replaced.
    assert tables.scan_store(spark, f"{tmp_path}/s", F.lit("2024-01-02").cast("timestamp")).count() == 0


def test_kafka_sink_needs_its_connector(spark):
    messages = spark.createDataFrame([("k", "v")], "key string, value string")
    with pytest.raises(Exception, match="kafka"):
        sinks.write_kafka(messages, "localhost:9092", "edits")
