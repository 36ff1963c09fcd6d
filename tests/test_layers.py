"""Boundary rows of ingest, bronze, silver, gold and serving."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from editengine import schema as S
from editengine.functions import columns as C
from editengine.operators import bronze, gold, ingest, serving, silver
from editengine.sources import tables


def values(df, column):
    return [r[column] for r in df.collect()]


def test_namespace_labels(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 2, 3, 4, 6, 10, 14, 5, None)], "namespace int")
    assert values(df.select(C.namespace_label(F.col("namespace")).alias("v")), "v") == [
        "article", "talk", "user", "user_talk", "wikipedia", "file", "template", "category", "ns_5", "ns_-1",
    ]


def test_edit_size_edges(spark):
    cases = {None: "unknown", 5001: "large_add", 5000: "small_add", 501: "small_add", 500: "tiny", 0: "tiny",
             -1: "small_del", -499: "small_del", -500: "large_del", -501: "large_del"}
    df = spark.createDataFrame([(k,) for k in cases], "byte_delta int")
    assert values(df.select(C.edit_size(F.col("byte_delta")).alias("v")), "v") == list(cases.values())


def test_anonymous_users(spark):
    cases = {"1.2.3.4": True, "999.999.999.999": True, "1.2.3": False, "2001:db8::1": False, "x1.2.3.4": False, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "user string")
    assert values(df.select(C.is_ipv4_text(F.col("user")).alias("v")), "v") == list(cases.values())


def test_wiki_language(spark):
    cases = {"enwiki": ("enwiki", "en"), "zh_min_nanwiki": ("zh", "zh"), "be_x_oldwiki": ("be", "be"), "": ("", "")}
    df = spark.createDataFrame([(k,) for k in cases], "wiki string")
    got = df.select(C.wiki_lang(F.col("wiki")), C.lang_code(F.col("wiki"))).collect()
    assert [tuple(r) for r in got] == list(cases.values())


def test_absurd_numbers_become_null(spark):
    df = spark.createDataFrame(
        [(2**62, 2**62, "enwiki", "edit"), (1704067200, 1704067200999, "enwiki", "edit")],
        "timestamp long, ingestion_ts long, wiki string, type string",
    ).withColumns({"user": F.lit("u"), "byte_delta": F.lit(-(2**31)), "comment": F.lit(None).cast("string")})
    first, second = silver.to_silver(df).collect()
    assert first["eventTime"] is None and first["latencyMs"] is None and first["hourOfDay"] is None
    assert second["ingestionTime"] == datetime(2024, 1, 1) and second["latencyMs"] == 999


def test_length_difference_overflow(spark):
    df = spark.createDataFrame([((-(2**31), 2**31 - 1),), ((None, 3),), (None,)], "length struct<old:int,new:int>")
    assert values(df.select(C.size_change(F.col("length")).alias("v")), "v") == [None, None, None]


JSON = [
    json.dumps({"wiki": "enwiki", "id": 1, "namespace": 0, "title": "A", "length": {"old": 1, "new": 4}}),
    '{"wiki": "enwiki", "id": 2, "name',
    "",
    "   ",
    "null",
    "[1]",
    '{"wiki": "enwiki", "id": "x", "namespace": 1}',
    '{"wiki": "enwiki", "id": 3, "length": {"old": "x", "new": 4}}',
    '{"wiki": "enwiki", "id": 4, "namespace": 3000000000}',
    '{"wiki": 7, "id": 5}',
    '{"wiki": "a", "wiki": "b", "id": 6}',
    '{"wiki": "enwiki", "id": 7} trailing',
    '{"id": 8}',
    None,
]


@pytest.fixture(scope="module")
def messages(spark):
    return spark.createDataFrame([(j,) for j in JSON], "value string")


def test_bronze_keeps_records_with_bad_fields(messages):
    rows = {r["id"]: r for r in bronze.to_bronze(messages).collect()}
    assert set(rows) == {1, None, 3, 4, 5, 6, 7}
    assert rows[None]["namespace"] == 1
    assert rows[3]["length"]["old"] is None and rows[3]["length"]["new"] == 4
    assert rows[4]["namespace"] is None
    assert rows[5]["wiki"] == "7" and rows[6]["wiki"] == "b"


def test_bronze_and_rejects_partition_the_input(messages):
    causes = values(bronze.rejects(messages), "cause")
    assert sorted(causes) == sorted(["malformed", "blank", "blank", "not_an_object", "not_an_object", "no_wiki", "blank"])
    assert bronze.to_bronze(messages).count() + len(causes) == len(JSON)


def test_bronze_reads_bytes(spark):
    df = spark.createDataFrame([(bytearray(JSON[0], "utf-8"),)], "value binary")
    assert values(bronze.to_bronze(df), "wiki") == ["enwiki"]


def test_raw_reader_and_counters_agree(messages):
    row = ingest.counters(messages, wiki="enwiki").first()
    kept = tables.read_raw_events(messages).count()
    # Trailing text is an error for the feed reader, and so is what is no object.
    assert row["parse_errors"] == 4 and row["blank"] == 3
    assert row["published"] + row["filtered_out"] == kept == len(JSON) - 7


def test_filters(spark):
    df = spark.createDataFrame([(1, "a", "edit"), (2, None, "log"), (3, "b", None)], "id int, wiki string, type string")
    assert values(ingest.filter_wiki(df), "id") == [1, 2, 3]
    assert values(ingest.filter_wiki(df, "a"), "id") == [1]
    assert values(ingest.filter_types(df, ["log", "edit"]), "id") == [1, 2]
    assert values(ingest.filter_types(df), "id") == [1, 2, 3]


def test_serialized_events_keep_text_and_fields(spark):
    df = spark.createDataFrame([("Zürich ☃", None, 3)], "title string, wiki string, extra int")
    row = ingest.serialize(df).first()
    assert row["key"] == "unknown" and "Zürich ☃" in row["value"] and json.loads(row["value"])["extra"] == 3


def test_key_order_with_one_dominant_wiki(spark):
    n = 30_000
    df = spark.range(n).select(
        F.col("id"), F.when(F.col("id") % 3 > 0, "big").otherwise(F.concat(F.lit("w"), F.col("id") % 50)).alias("wiki"),
        F.expr("(id * 7919) % 10007").alias("ingestion_ts"),
    )
    out = ingest.key_ordered(df, 8).select(
        F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("at"), "key", "ingestion_ts", "id"
    ).toPandas().sort_values("at")
    assert len(out) == n
    assert out.groupby("p").size().max() < n / 4  # the dominant wiki is spread
    for _, group in out.groupby("key"):
        order = list(zip(group["ingestion_ts"], group["id"]))
        assert order == sorted(order)


SILVER_DDL = (
    "wiki string, wikiLang string, eventTime timestamp, id long, ingestion_ts long, type string, title string, "
    "title_url string, namespace int, user string, bot boolean, minor boolean, isAnon boolean, byte_delta int, "
    "title_len int, commentLen int, comment string, hourOfDay int, dayOfWeek int, latencyMs long, "
    "editSizeCategory string, server_name string"
)
T0 = datetime(2024, 1, 1)


def test_serving_fills_nulls_and_empty_text(spark):
    empty = [None] * 22
    blank = ["" if part.endswith("string") else None for part in SILVER_DDL.split(", ")]
    empty[2] = blank[2] = T0
    timeless = [None] * 22
    df = spark.createDataFrame([empty, blank, timeless], SILVER_DDL)
    expected = ("unknown", "unknown", T0, 0, 0, "unknown", "", "", 0, "anonymous", False, False, False, 0, 0, 0, "", 0, 1,
                0, "unknown", "")
    assert [tuple(r) for r in serving.serving_rows(df).collect()] == [expected, expected]
    assert serving.serving_rejects(df).count() == 1


def store(spark, rows):
    """(wiki, event_id, seconds, ingestion_ts, comment) rows as store rows."""
    df = spark.createDataFrame(rows, "wiki string, event_id long, s long, ingestion_ts long, comment string")
    fixed = {c: F.lit(0) for c in S.STORE_COLUMNS}
    fixed |= {c: F.lit("x") for c in ("wiki_lang", "type", "title", "title_url", "user_name", "edit_size_cat", "server_name")}
    fixed |= {c: F.lit(False) for c in ("is_bot", "is_minor", "is_anon")}
    fixed |= {"event_time": F.timestamp_seconds("s")}
    fixed |= {c: F.col(c) for c in ("wiki", "event_id", "ingestion_ts", "comment")}
    return df.select(*[fixed[c].alias(c) for c in S.STORE_COLUMNS])


def test_upsert_keeps_the_last_write(spark):
    rows = store(spark, [("a", 1, 10, 100, "old"), ("a", 1, 10, 200, "new"), ("a", 0, 10, 5, "n1"), ("a", 0, 10, 6, "n2"),
                         ("b", 1, 10, 50, "other"), ("a", 1, 11, 1, "later")])
    assert sorted(values(serving.upsert_latest(rows), "comment")) == ["later", "n2", "new", "other"]


def test_upsert_limits_rows_before_the_shuffle(spark):
    plan = serving.upsert_latest(store(spark, [("a", 1, 1, 1, "c")]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_retention_edges(spark):
    week = S.RETENTION_SECONDS * 1000
    rows = store(spark, [("a", 1, 1, 0, "gone"), ("a", 2, 1, 1, "kept")])
    as_of = F.timestamp_millis(F.lit(week))
    assert values(serving.alive(rows, as_of), "comment") == ["kept"]


def test_newest_first_spreads_and_orders(spark):
    rows = store(spark, [("big", i, i // 2, i, "c") for i in range(4000)] + [("a", i, i, i, "c") for i in range(100)])
    out = serving.newest_first(rows, 4).select(F.spark_partition_id().alias("p"), "wiki", "event_time", "event_id").toPandas()
    assert out["p"].nunique() == 4
    for _, group in out.groupby("wiki"):
        assert list(group["event_id"]) == sorted(group["event_id"], reverse=True)


def test_vandalism_edges(spark):
    df = spark.createDataFrame(
        [(10, 3), (10, 4), (5, 5), (6, 6), (6, None)], "totalEdits long, anonEdits long"
    ).withColumn("botEdits", F.lit(0))
    flags = values(gold.with_vandalism_flag(gold.with_ratios(df)), "vandalismFlag")
    assert flags == [False, True, False, True, None]


def test_gold_null_sums_and_window_edges(spark):
    df = spark.createDataFrame(
        [("a", datetime(2024, 1, 1, 0, 4, 59), None), ("a", datetime(2024, 1, 1, 0, 5), True)],
        "wiki string, eventTime timestamp, bot boolean",
    ).withColumns({
        "type": F.lit("edit"), "namespace": F.lit(0), "isAnon": F.lit(None).cast("boolean"),
        "byte_delta": F.lit(None).cast("int"), "user": F.lit("u"), "commentLen": F.lit(1),
    })
    rows = gold.to_gold(df, exact=True).orderBy("windowStart").collect()
    assert [r["windowStart"].minute for r in rows] == [0, 5]
    assert rows[0]["botEdits"] is None and rows[0]["botRatio"] is None and rows[1]["botEdits"] == 1
    assert rows[0]["vandalismFlag"] is None or rows[0]["vandalismFlag"] is False


def test_approximate_editors_are_close(spark, small):
    from editengine.plans import catalog

    rows = catalog.silver_rows(spark, small)
    exact = gold.to_gold(rows, window="1 day", exact=True).select("windowStart", "wiki", F.col("uniqueEditors").alias("e"))
    near = gold.to_gold(rows, window="1 day").select("windowStart", "wiki", "uniqueEditors")
    for r in exact.join(near, ["windowStart", "wiki"]).collect():
        assert abs(r["e"] - r["uniqueEditors"]) <= max(1, 0.15 * r["e"])


def test_union_reader_fills_missing_columns(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "id int, x string").write.parquet(f"{tmp_path}/one")
    spark.createDataFrame([(2, 5)], "id int, y int").write.parquet(f"{tmp_path}/two")
    out = tables.read_silver_union(spark, f"{tmp_path}/one", f"{tmp_path}/two").orderBy("id").select("id", "x", "y").collect()
    assert [tuple(r) for r in out] == [(1, "a", None), (2, None, 5)]


def test_silver_size_warns(spark):
    assert tables.silver_size(spark.range(499)).first().asDict() == {"rows": 499, "few": True}
    assert tables.silver_size(spark.range(500)).first()["few"] is False
