"""Reports against brute force on small skewed frames, and their boundary rows."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from editengine import schema as S
from editengine.operators import edits, evaluate, overview, trends
from editengine.operators.percentiles import exact_percentile
from editengine.plans import registry

T0 = datetime(2024, 1, 1)
DEFAULT = {
    "wiki": "enwiki", "wiki_lang": "enwiki", "event_time": T0, "event_id": 0, "type": "edit", "title": "P", "user_name": "u",
    "is_bot": False, "is_anon": False, "byte_delta": 0, "comment_len": 0, "hour_of_day": 0, "latency_ms": 0,
    "edit_size_cat": "tiny",
}
DDL = (
    "wiki string, wiki_lang string, event_time timestamp, event_id long, type string, title string, user_name string, "
    "is_bot boolean, is_anon boolean, byte_delta int, comment_len int, hour_of_day int, latency_ms long, edit_size_cat string"
)


def store(spark, rows):
    full = [tuple({**DEFAULT, "event_id": i, **r}.values()) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, DDL)


def pairs(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def test_spikes_are_strictly_above_twice_the_mean(spark):
    def pages(counts):
        return store(spark, [{"title": f"t{i}"} for i, n in enumerate(counts) for _ in range(n)])

    assert pairs(edits.edit_spikes(pages([1, 1, 4])), "title", "editCount") == []
    assert pairs(edits.edit_spikes(pages([1, 1, 1, 9])), "title", "editCount") == [("t3", 9)]


def test_sessions_split_on_more_than_thirty_minutes(spark):
    def at(user, *seconds):
        return [{"user_name": user, "event_time": T0 + timedelta(seconds=s)} for s in seconds]

    rows = store(spark, at("a", 0, 0, 1799, 3599, 5400) + at("b", 10) + at("c", 1, 1801, 3602))
    got = pairs(edits.edit_sessions(rows, None).orderBy("user_name", "sessionId"), "user_name", "sessionId", "sessionEdits", "durationMin")
    assert got == [("a", 1, 4, 3599 / 60), ("a", 2, 1, 0.0), ("b", 1, 1, 0.0), ("c", 1, 2, 30.0), ("c", 2, 1, 0.0)]


def sessions_by_hand(frame, gap=1800):
    out = []
    for user, g in frame.sort_values("event_time").groupby("user_name"):
        fresh = ~(g["event_time"].diff() <= pd.Timedelta(seconds=gap))
        for number, s in g.groupby(fresh.cumsum()):
            out.append((user, int(number), len(s), s["event_time"].min().to_pydatetime(), s["event_time"].max().to_pydatetime()))
    return sorted(out)


def test_sessions_match_brute_force_under_skew(spark):
    rng = np.random.default_rng(1)
    n = 4000
    users = [str(u) for u in np.where(rng.random(n) < 0.4, "hot", rng.integers(0, 200, n).astype(str))]
    seconds = rng.integers(-200_000, 400_000, n)
    frame = pd.DataFrame({"user_name": users, "event_time": [T0 + timedelta(seconds=int(s)) for s in seconds]})
    rows = [{"user_name": u, "event_time": t.to_pydatetime()} for u, t in zip(frame["user_name"], frame["event_time"])]
    got = edits.edit_sessions(store(spark, rows), None)
    mine = sorted(pairs(got, "user_name", "sessionId", "sessionEdits", "sessionStart", "sessionEnd"))
    assert mine == sessions_by_hand(frame)
    assert sum(r[2] for r in mine) == n


def test_session_window_is_per_slot_not_per_edit(spark):
    """A user with a third of all edits reaches the ordered window as one row per half hour."""
    rows = store(spark, [{"user_name": "hot", "event_time": T0 + timedelta(seconds=i)} for i in range(3600)])
    plan = edits.edit_sessions(rows)._jdf.queryExecution().executedPlan().toString()
    window, first = plan.index("Window ["), plan.rindex("partial_count")
    assert window < first  # the plan is printed from the result down: aggregation comes before the window


@pytest.mark.parametrize("share", [0.0, 0.5, 0.95, 1.0])
def test_percentile_matches_numpy(spark, share):
    rng = np.random.default_rng(2)
    groups = {
        "hot": np.where(rng.random(3000) < 0.5, 7, rng.integers(-(2**31), 2**31, 3000)),
        "one": np.array([5]), "two": np.array([-70000, 70001]), "edge": np.array([65535, 65536, -65536, -65537, 0]),
    }
    rows = [(g, int(v)) for g, vs in groups.items() for v in vs] + [("hot", None), (None, 3), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, v int")
    got = {r["g"]: r["percentile"] for r in exact_percentile(df, "v", share, ["g"]).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        assert got[g] == pytest.approx(np.percentile(vs.astype("float64"), share * 100), rel=1e-12, abs=1e-9)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-(2**31), 2**31 - 1), min_size=1, max_size=30), st.floats(0, 1))
def test_percentile_property(spark, numbers, share):
    df = spark.createDataFrame([(v,) for v in numbers], "v int")
    got = exact_percentile(df, "v", share).first()["percentile"]
    assert got == pytest.approx(np.percentile(np.array(numbers, "float64"), share * 100), rel=1e-9, abs=1e-6)


def test_percentile_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v int")
    assert exact_percentile(df, "v", 0.5).collect() == []
    assert edits.outlier_edits(store(spark, [{"type": "log"}])).collect() == []


def test_outliers_handle_the_smallest_int(spark):
    rows = store(spark, [{"byte_delta": 1}] * 30 + [{"byte_delta": -(2**31)}])
    assert pairs(edits.outlier_edits(rows), "byte_delta") == [(-(2**31),)]


def test_outliers_by_brute_force(spark):
    rng = np.random.default_rng(3)
    deltas = [int(v) for v in rng.normal(0, 1000, 500)]
    got = pairs(edits.outlier_edits(store(spark, [{"byte_delta": v} for v in deltas]), None), "byte_delta")
    cut = np.percentile(np.abs(deltas), 95)
    assert sorted(r[0] for r in got) == sorted(v for v in deltas if abs(v) > cut)


def test_comment_bin_edges(spark):
    lengths = [0, 1, 10, 11, 30, 31, 60, 61, 100, 101, 500, 501]
    got = pairs(edits.comment_bins(store(spark, [{"comment_len": n} for n in lengths])), "commentBin", "count")
    assert got == [("0-10", 2), ("10-30", 2), ("30-60", 2), ("60-100", 2), ("100+", 2)]


def test_half_even_rounding(spark):
    rows = [{"byte_delta": v, "user_name": "a"} for v in (0,) * 7 + (1,)] + [{"byte_delta": v, "user_name": "b"} for v in (0,) * 5 + (1,) * 3]
    got = dict(pairs(edits.high_impact(store(spark, rows)), "user_name", "avgAbsDelta"))
    assert got == {"a": 0.12, "b": 0.38}


def test_high_impact_leaves_bots_and_single_edits_out(spark):
    rows = store(spark, [{"user_name": "bot", "is_bot": True}] * 3 + [{"user_name": "one"}] + [{"user_name": "two"}] * 2)
    assert pairs(edits.high_impact(rows), "user_name") == [("two",)]


def test_pivot_has_fixed_columns_and_whole_counts(spark):
    rows = store(spark, [{"wiki_lang": "a", "edit_size_cat": "tiny"}] * 3 + [{"wiki_lang": "b", "edit_size_cat": "unknown"}])
    got = edits.size_by_language(rows)
    assert got.columns == ["wiki_lang", *S.SIZE_CATEGORIES]
    assert [sum(r[1:]) for r in got.collect()] == [3, 1]


def test_thresholds(spark):
    rows = [{"title": "three", "user_name": f"u{i}"} for i in range(3)] + [{"title": "two", "user_name": f"u{i}"} for i in range(2)]
    df = store(spark, rows)
    assert pairs(edits.collaboration(df), "title", "uniqueEditors") == [("three", 3)]
    assert pairs(edits.multi_user_pages(df), "title", "uniqueUsers", "totalEdits") == [("three", 3, 3)]
    assert pairs(edits.repeated_edits(store(spark, rows * 3)), "editCount")[0] == (3,)
    assert edits.repeated_edits(store(spark, rows * 2)).count() == 0
    languages = store(spark, [{"wiki_lang": "a", "type": "log"}, {"wiki_lang": "b"}])
    assert pairs(edits.cross_language(languages), "user_name", "languageCount") == [("u", 2)]


def test_ties_are_broken_by_key(spark):
    rows = store(spark, [{"title": f"t{i:02d}", "user_name": u} for i in range(40) for u in "abc"])
    assert pairs(edits.collaboration(rows), "title") == [(f"t{i:02d}",) for i in range(20)]


def test_dominant_editor_and_streaks(spark):
    rows = store(spark, [{"user_name": u} for u in "bbaac"] + [{"title": "Q", "user_name": "z"}] * 2)
    assert pairs(edits.dominant_editors(rows), "title", "user_name", "userEdits", "totalEdits", "share") == [("P", "a", 2, 5, 0.4)]
    days = store(spark, [{"event_time": T0 + timedelta(days=d)} for d in (0, 1, 2, 5, 6, 6, 30, 31, 32, 33)])
    assert pairs(edits.day_streaks(days), "longestStreak") == [(4,)]


def test_registry_lists_and_runs_all(spark):
    rows = store(spark, [{"user_name": f"u{i % 4}", "title": f"t{i % 3}", "byte_delta": i} for i in range(60)])
    assert list(registry.REPORTS) == [f"q{i}" for i in range(1, 13)]
    results = registry.run_all(rows)
    for key, report in registry.REPORTS.items():
        for column in (report.x, report.y):
            assert column is None or column in results[key].columns
    assert registry.report_sizes(rows).count() == 12


def test_reports_of_no_rows_are_empty(spark):
    empty = store(spark, [{}]).limit(0)
    for df in registry.run_all(empty).values():
        assert df.collect() == []


def labelled(spark, scores, labels):
    return spark.createDataFrame(list(zip(map(float, scores), map(int, labels))), "score double, label int")


def test_auc_counts_pairs(spark):
    rng = np.random.default_rng(4)
    # A third of all scores lies within one tiny range: several levels of the running totals are in use.
    scores = np.where(rng.random(600) < 0.3, 1e-9 * rng.integers(0, 50, 600), rng.integers(0, 40, 600) / 8)
    labels = (rng.random(600) < 0.3 + 0.05 * scores).astype(int)
    pos, neg = scores[labels == 1], scores[labels == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    df = labelled(spark, scores, labels)
    auc = evaluate.roc_auc(df).first()["areaUnderROC"]
    assert auc == pytest.approx(wins / (len(pos) * len(neg)), abs=1e-12)
    flipped = evaluate.roc_auc(df.withColumn("score", -F.col("score"))).first()["areaUnderROC"]
    assert auc + flipped == pytest.approx(1.0, abs=1e-12)


def test_curve_ends_and_rises(spark):
    df = labelled(spark, [0.1, 0.4, 0.4, 0.9], [0, 1, 0, 1])
    points = evaluate.roc_curve(df).orderBy("tpr", "fpr").collect()
    assert [(r["threshold"], r["fpr"], r["tpr"]) for r in points] == [
        (None, 0.0, 0.0), (0.9, 0.0, 0.5), (0.4, 0.5, 1.0), (0.1, 1.0, 1.0)]


def test_auc_of_one_class_is_null(spark):
    assert evaluate.roc_auc(labelled(spark, [1, 2], [1, 1])).first()["areaUnderROC"] is None


def test_report_of_an_absent_class_is_zero(spark):
    df = labelled(spark, [0, 0, 0], [0, 0, 0]).withColumn("prediction", F.lit(0))
    rows = {r["line"]: r for r in evaluate.classification_report(df).collect()}
    assert rows["Bot"]["precision"] == 0.0 and rows["Bot"]["support"] == 0
    assert rows["accuracy"]["f1"] == 1.0 and rows["macro avg"]["recall"] == 0.5


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(5)
    data = [int(v) for v in rng.normal(0, 2500, 2000)]
    df = spark.createDataFrame([(v,) for v in data], "byte_delta int")
    rows = overview.delta_histogram(df, 50).orderBy("bin").collect()
    density, edges = np.histogram(np.clip(data, -3000, 3000), bins=50, density=True)
    assert [r["density"] for r in rows] == pytest.approx(list(density))
    assert [r["binStart"] for r in rows] == pytest.approx(list(edges[:-1]))
    flat = overview.delta_histogram(spark.createDataFrame([(9000,)] * 3, "byte_delta int"), 4).orderBy("bin").collect()
    assert [r["edits"] for r in flat] == list(np.histogram([3000] * 3, bins=4)[0])


def test_class_distribution_reports_absent_classes(spark):
    df = spark.createDataFrame([(1,), (1,)], "isBot int")
    assert pairs(overview.class_distribution(df), "isBot", "edits") == [(0, 0), (1, 2)]


def test_sample_and_labels(spark):
    df = spark.range(80).select(F.lit("x" * 60).alias("title"), "id")
    assert overview.sample_rows(df).columns == ["title"] and overview.sample_rows(df).count() == 50
    top = overview.chart_top_n(df, "title", ["id"], width=45).collect()
    assert len(top) == 15 and len(top[0]["title"]) == 45


def test_trends_add_up(spark, small):
    from editengine.plans import catalog

    silver = catalog.silver_rows(spark, small)
    hours = trends.hourly_edits(silver).agg(F.sum("editCount")).first()[0]
    sizes = trends.size_distribution(silver).agg(F.sum("editCount")).first()[0]
    assert hours == sizes == trends.top_pages(silver, None).agg(F.sum("editCount")).first()[0] == 450
