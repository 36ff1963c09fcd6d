"""Dense lags over silences of more than a week, against their SQL."""

from datetime import timedelta
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from check_oracle import SMALL, compare, connect
from pyspark.sql import functions as F

import __spark_entry__ as entry
from editengine.operators import features
from editengine.plans.oracle import oracle


@pytest.fixture
def gaps(tmp_path):
    """The small tables with 200 events, thirds of them nine and ten days apart."""
    for path in Path(SMALL).iterdir():
        (tmp_path / path.name).symlink_to(path)
    table = pq.read_table(f"{SMALL}/events.parquet").slice(0, 200)
    days = [0, 90, 190]  # the adapter divides by ten
    moved = [t + timedelta(days=days[3 * k // 200]) for k, t in enumerate(table["ts"].to_pylist())]
    at = table.schema.get_field_index("ts")
    table = table.set_column(at, table.schema.field("ts"), pa.array(moved, table.schema.field("ts").type))
    (tmp_path / "events.parquet").unlink()
    pq.write_table(table, tmp_path / "events.parquet")
    return str(tmp_path)


def test_gaps_of_over_a_week_match_sql(spark, gaps):
    df = entry.queries()["lag_features_dense"](spark, gaps)
    assert compare(df, connect(gaps), oracle()["lag_features_dense"]) == ""
    assert df.count() > 30 * 1440


def test_a_gap_of_twenty_years_is_laid_out_exactly(spark):
    rows = [("w", "2004-01-01 00:00:00", 2), ("w", "2024-01-01 00:01:00", 1), ("v", "2024-01-01 00:00:00", 7)]
    series = spark.createDataFrame(rows, "wiki string, at string, editCount long").select(
        "wiki", F.col("at").cast("timestamp").alias("windowStart"), "editCount", F.lit(0.5).alias("avgDelta"),
        F.lit(0).cast("long").alias("botEdits"), F.lit(0).cast("long").alias("anonEdits"), F.lit(0).alias("hourOfDay"), F.lit(1).alias("dayOfWeek"))
    dense = features.whole_minutes(series).where("wiki = 'w'")
    got = dense.agg(F.count("*"), F.count_distinct("windowStart"), F.sum("editCount"), F.max(F.unix_seconds("windowStart")) - F.min(F.unix_seconds("windowStart"))).first()
    minutes = 7305 * 1440 + 1
    assert tuple(got) == (minutes + 1, minutes + 1, 3, 60 * minutes)


def test_lags_need_no_window_over_minutes(spark):
    """Closed-form lags equal lags over the minutes laid out, around gaps of every small size."""
    rows, at = [], 0
    for k, gap in enumerate([1, 1, 2, 3, 4, 1, 5, 2, 1, 1, 3000, 1, 2]):
        at += gap
        rows += [("w", at, k + 1, k / 4, k % 3), ("v", 7 * at, 2, 0.5, 1)] + ([("u", at, 1, 1.0, 0)] if k == 4 else [])
    series = spark.createDataFrame(rows, "wiki string, at long, editCount long, avgDelta double, botEdits long").select(
        "wiki", F.timestamp_seconds(F.col("at") * 60).alias("windowStart"), "editCount", "avgDelta", "botEdits", F.lit(0).cast("long").alias("anonEdits"))
    got, want = features.whole_lags(series), features.add_lags(features.whole_minutes(series))
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(tuple(r) for r in got.select(*want.columns).collect()) == sorted(tuple(r) for r in want.collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("Window")  # the tree is printed from the top: windows lie below


def test_a_far_event_is_dealt_over_tasks(spark):
    rows = [("w", "2004-01-01 00:00:00"), ("w", "2024-01-01 00:01:00")]
    series = spark.createDataFrame(rows, "wiki string, at string").select(
        "wiki", F.col("at").cast("timestamp").alias("windowStart"), F.lit(1).cast("long").alias("editCount"), F.lit(0.5).alias("avgDelta"),
        F.lit(0).cast("long").alias("botEdits"), F.lit(0).cast("long").alias("anonEdits"))
    tasks = features.whole_lags(series).groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 1 and max(r["count"] for r in tasks) < 0.8 * sum(r["count"] for r in tasks)
