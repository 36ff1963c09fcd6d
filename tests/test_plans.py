"""Properties of plans that decide how a query scales."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from editengine.plans.oracle import oracle
from editengine.operators import edits, features, gold, serving
from editengine.operators.bronze import to_bronze
from editengine.plans import catalog


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(autouse=True)
def whole_schemas(spark):
    """Plans print their read schema in full."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture(scope="module")
def tables_dir(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("layers"))
    catalog.silver_rows(spark, "/root/testdata/sf0.001").write.parquet(f"{root}/silver")
    catalog.store_rows(spark, "/root/testdata/sf0.001").write.parquet(f"{root}/store")
    return root


def read_schema(text):
    return set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<(.*?)>", text).group(1)))


def test_filters_and_columns_reach_the_scan(spark, tables_dir):
    silver = spark.read.parquet(f"{tables_dir}/silver")
    text = plan(gold.to_gold(silver))
    assert "EqualTo(type,edit)" in text and "EqualTo(namespace,0)" in text
    assert read_schema(text) == {"type", "namespace", "eventTime", "wiki", "bot", "isAnon", "byte_delta", "user", "commentLen"}
    store = spark.read.parquet(f"{tables_dir}/store")
    assert read_schema(plan(edits.repeated_edits(store))) == {"type", "user_name", "title"}
    assert "GreaterThan(ingestion_ts" in plan(serving.alive(store, F.lit("2024-01-10").cast("timestamp")))


BATCH = [n for n in oracle() if not any(w in n for w in (
    "stream", "write", "read_", "compact", "late", "watermark", "scan", "registry", "store_restart", "publish", "roc_", "_checked"))]


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(entry.queries()[name](spark, "/root/testdata/sf0.001"))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas", "FlatMapGroups"):
        assert operator not in text


@pytest.mark.parametrize("report", ["q1_edit_spikes", "q4_repeated_edits", "q7_max_edits_per_day", "q11_collaboration"])
def test_reports_take_the_top_without_a_full_sort(spark, report):
    text = plan(entry.queries()[report](spark, "/root/testdata/sf0.001"))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_aggregates_combine_before_the_shuffle(spark, tables_dir):
    store = spark.read.parquet(f"{tables_dir}/store")
    for df in (edits.repeated_edits(store), edits.edit_sessions(store), edits.median_edit_size(store), serving.hourly_summary(store)):
        assert re.search(r"Exchange hashpartitioning.*\n.*HashAggregate\(keys=.*partial_count", plan(df))


def test_percentile_reads_its_input_once(spark, tables_dir):
    df = edits.median_edit_size(spark.read.parquet(f"{tables_dir}/store"))
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_messages_are_parsed_once(spark):
    df = to_bronze(spark.createDataFrame([("{}",)], "value string"))
    assert plan(df).count("from_json") <= 2 and "Filter isnotnull(from_json" not in plan(df)


def test_stages_stay_within_the_jit_limit(spark, tables_dir):
    """Wide projections over stored tables compile to methods that the JIT accepts."""
    from editengine.operators.silver import to_silver

    silver = spark.read.parquet(f"{tables_dir}/silver")
    for df in (to_silver(silver.select(*catalog.RECORD)), serving.serving_rows(silver), features.ml_features(silver)):
        text = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
        assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", text))) < 8000
