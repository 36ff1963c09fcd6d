"""Day tables behind a pointer, and keyed snapshots in buckets."""

import pytest
from check_oracle import SMALL, compare, connect
from pyspark.sql import functions as F

import __spark_entry__ as entry
from editengine.plans import catalog
from editengine.plans.oracle import oracle
from editengine.sources import layers


@pytest.fixture
def table(spark, tmp_path):
    made = layers.DayTable(spark, f"{tmp_path}/t")
    for turn in range(3):
        rows = spark.range(300).selectExpr("id", f"{turn} AS turn", "date_add(date'2024-01-01', int(id % 5)) AS at")
        made.append(rows, F.col("at"))
    return made


def files(df):
    return sorted(df.inputFiles())


def counts(df):
    return {(str(r["day"]), r["turn"]): r["count"] for r in df.groupBy("day", "turn").count().collect()}


def test_compaction_keeps_rows_and_leaves_fewer_files(table):
    before, old = counts(table.read()), table.read()
    many = len(files(old))
    assert table.compact() == [f"2024-01-0{k}" for k in range(1, 5)]
    assert counts(table.read()) == before == {(f"2024-01-0{k}", t): 60 for k in range(1, 6) for t in range(3)}
    assert len(files(table.read(["2024-01-02"]))) == 1 and len(files(table.read())) < many
    assert len(table.folders()["2024-01-05"]) == 3  # the last day is open
    assert counts(old) == before  # who reads the list before sees what it lists
    assert table.sweep(1) == 12 and counts(table.read()) == before
    assert table.compact() and counts(table.read()) == before


def test_a_large_day_is_spread_over_files(table):
    table.compact("2024-01-02", rows_per_file=50)
    assert len(files(table.read(["2024-01-01"]))) > 1 and table.read(["2024-01-01"]).count() == 180


def test_compaction_leaves_no_day_to_the_writer(table, monkeypatch):
    """A write that makes the day folders itself sorts each task's rows in memory."""
    before = counts(table.read())
    monkeypatch.setattr("pyspark.sql.DataFrameWriter.partitionBy", lambda *_: pytest.fail("rows are sorted by day"))
    assert table.compact("2024-01-03", rows_per_file=50) == ["2024-01-01", "2024-01-02"]
    assert counts(table.read()) == before and len(table.folders()["2024-01-01"]) == 1


def test_days_prune_and_expiry_rewrites_the_border_day_alone(table):
    plan = table.read().where("day >= '2024-01-04'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "Exchange" not in plan
    before = table.folders()
    table.expire(F.col("turn") > 0, "2024-01-03")
    after = table.folders()
    assert sorted(after) == ["2024-01-03", "2024-01-04", "2024-01-05"]
    assert all(after[d] == before[d] for d in ("2024-01-04", "2024-01-05")) and after["2024-01-03"] != before["2024-01-03"]
    assert table.read(["2024-01-03"]).count() == 120 and table.read().count() == 480
    table.expire(F.lit(False), "2024-01-05")
    assert table.read() is None


def test_rows_without_a_day_stay(spark, tmp_path):
    made = layers.DayTable(spark, f"{tmp_path}/t")
    assert made.read() is None and made.compact() == []
    made.append(spark.range(4).selectExpr("id", "if(id < 2, null, date'2024-01-01') AS at"), F.col("at"))
    made.expire(F.lit(True), "2024-06-01")
    assert sorted(r["id"] for r in made.read().collect()) == [0, 1]


def test_of_two_writers_the_later_one_is_refused(spark, tmp_path):
    one = layers.DayTable(spark, f"{tmp_path}/t")
    one.append(spark.range(3).withColumn("at", F.to_date(F.lit("2024-01-01"))), F.col("at"))
    with pytest.raises(RuntimeError):
        one._swap(0, {})
    assert one.read().count() == 3


def test_a_snapshot_is_merged_without_being_shuffled(spark, tmp_path):
    rows = catalog.store_rows(spark, SMALL)
    layers.write_keyed(rows, f"{tmp_path}/snapshot", 6)
    newer = rows.where("type = 'edit'").withColumns({"comment": F.lit("newer"), "batch_id": F.lit(1)})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        merged = layers.merged(layers.read_keyed(spark, f"{tmp_path}/snapshot"), newer, "batch_id")
        plan = merged._jdf.queryExecution().sparkPlan().toString()
        ran = merged._jdf.queryExecution().executedPlan().toString()
        side = ran[ran.index("LeftAnti"):]
        snapshot = side[: side.index("keyed_")]
        assert "Exchange" not in snapshot and "Bucketed: true" in ran and "LeftAnti" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert merged.count() == rows.count() and merged.where("comment = 'newer'").count() == rows.where("type = 'edit'").count()
    layers.compact_keyed(spark, f"{tmp_path}/snapshot", newer, f"{tmp_path}/next", "batch_id", buckets=6)
    again = layers.read_keyed(spark, f"{tmp_path}/next")
    assert sorted(map(str, again.collect())) == sorted(map(str, merged.collect()))
    assert layers.read_keyed(spark, f"{tmp_path}/none") is None


@pytest.mark.parametrize("name", ["scan_keyed_store", "compact_layer", "expire_layer", "lag_features_dense"])
def test_new_queries_match_sql(spark, name):
    assert compare(entry.queries()[name](spark, SMALL), connect(SMALL), oracle()[name]) == ""
