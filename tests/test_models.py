"""Features and models: floors, not values, where fitting is random."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from editengine import schema as S
from editengine.operators import evaluate, features, iforest, models
from editengine.plans import catalog

MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def rows(spark):
    out = catalog.feature_rows(spark, MIDDLE).persist()
    yield out
    out.unpersist()


@pytest.fixture(scope="module")
def selection(rows):
    return models.select_bot_model(rows)


def test_split_is_stable_and_complete(rows):
    train, test = features.split_by_key(rows)
    again, _ = features.split_by_key(rows.repartition(7))
    assert train.count() + test.count() == rows.count()
    assert 0.17 < test.count() / rows.count() < 0.23
    assert train.select("id").exceptAll(again.select("id")).count() == 0


def test_bot_models_learn(selection):
    assert selection.auc["RandomForest"] > 0.9 and selection.auc["DecisionTree"] > 0.8 and selection.auc["LogisticRegression"] > 0.6
    assert selection.auc[selection.best] == max(selection.auc.values())


def test_exact_auc_agrees_with_the_evaluator(selection):
    for name, auc in selection.auc.items():
        exact = evaluate.roc_auc(selection.predictions(name), "botProbability", "isBot").first()["areaUnderROC"]
        assert exact == pytest.approx(auc, abs=1e-9)


def test_save_and_load(selection, tmp_path):
    model = selection.models["DecisionTree"]
    models.save_model(model, f"{tmp_path}/m")
    models.save_model(model, f"{tmp_path}/m")  # overwrites
    again = models.load_model(f"{tmp_path}/m").transform(selection.test)
    assert again.select("id", "prediction").exceptAll(model.transform(selection.test).select("id", "prediction")).count() == 0


def test_importances(selection):
    rows = models.feature_importances(selection.models["RandomForest"], S.BOT_FEATURES).collect()
    assert sum(r["importance"] for r in rows) == pytest.approx(1.0)
    assert [r["importance"] for r in rows] == sorted((r["importance"] for r in rows), reverse=True)
    with pytest.raises(TypeError):
        models.feature_importances(selection.models["LogisticRegression"], S.BOT_FEATURES)


def test_clusters(rows):
    model = models.edit_clusters(rows, starts=2)
    clustered = model.transform(rows)
    profile = models.cluster_profiles(clustered)
    assert profile.count() == 5
    assert profile.agg(F.sum("count")).first()[0] == rows.count()
    assert evaluate.silhouette(clustered) > 0.3
    centers = [c.tolist() for c in model.stages[-1].clusterCenters()]
    scaled = features.minmax_scale(rows, S.CLUSTER_FEATURES)
    mine = models.nearest_centroid(scaled, S.CLUSTER_FEATURES, centers).select("id", F.col("cluster").alias("mine"))
    assert mine.join(clustered.select("id", "cluster"), "id").where("mine <> cluster").count() == 0


def _points(rows):
    scaled = features.minmax_scale(rows, S.CLUSTER_FEATURES)
    return scaled.select(F.array(*[F.col(c).cast("double") for c in S.CLUSTER_FEATURES]).alias("point"))


def test_starts_move_together_as_each_would_alone(rows):
    """All starts against a plain loop over the same seeds: centroids, costs, one scan for each round."""
    points = _points(rows).persist()
    table = np.array(points.toPandas()["point"].tolist())
    found = models.multi_start(points, 5, 4, rounds=6, still=0.0)
    assert found.scans <= 7
    for start, seeds in enumerate(models._seeds(points, 5, 4)):
        now = np.array(seeds)
        for _ in range(6):
            near = ((table[:, None, :] - now) ** 2).sum(axis=2).argmin(axis=1)
            now = np.array([table[near == c].mean(axis=0) if (near == c).any() else now[c] for c in range(5)])
        cost = ((table[:, None, :] - now) ** 2).sum(axis=2).min(axis=1).sum()
        assert np.allclose(found.centroids[start], now, atol=1e-9)
        assert found.costs[start] == pytest.approx(cost, rel=1e-9)
    points.unpersist()


def test_ten_starts_cost_no_more_than_ten_fits(rows):
    points = _points(rows).persist()
    vectors = points.select(array_to_vector("point").alias("features")).persist()
    separate = min(KMeans(k=5, seed=models.SEED + s, maxIter=20).fit(vectors).summary.trainingCost for s in range(10))
    together = models.multi_start(points, 5, 10)
    assert min(together.costs) <= 1.01 * separate
    centers = [c.tolist() for c in models.edit_clusters(rows, starts=10).stages[-1].clusterCenters()]
    best = together.centroids[min(range(10), key=together.costs.__getitem__)]
    assert np.allclose(sorted(centers), sorted(best), atol=1e-9)
    points.unpersist()
    vectors.unpersist()


def test_fewer_different_points_than_clusters(spark):
    points = spark.createDataFrame([([0.0, 1.0],), ([0.0, 1.0],), ([2.0, 0.0],)], "point array<double>")
    found = models.multi_start(points, 5, 3)
    assert found.costs == [0.0, 0.0, 0.0] and all(len(c) == 2 for c in found.centroids)


def test_isolation_forest_finds_planted_outliers(spark):
    n = 4000
    base = spark.range(n).select("id", (F.randn(1)).alias("a"), (F.randn(2)).alias("b"))
    planted = spark.range(n, n + 40).select("id", F.lit(9.0).alias("a"), (F.lit(-9.0) - F.col("id") % 5).alias("b"))
    df = base.union(planted).persist()
    forest = iforest.fit(df, ["a", "b"])
    out = forest.predict(df).persist()
    assert out.where(F.col("id") >= n).agg(F.min("anomaly")).first()[0] == 1
    share = out.agg(F.avg("anomaly")).first()[0]
    assert 0.04 < share < 0.055
    low, high = out.agg(F.min("score"), F.max("score")).first()
    assert 0 < low < high < 1
    again = iforest.fit(df.repartition(5), ["a", "b"])
    assert np.array_equal(forest.cut, again.cut)  # the same trees on another partitioning


def test_isolation_forest_samples_are_bounded(spark):
    df = spark.range(50_000).select("id", F.rand(3).alias("a"))
    sizes = [r["count"] for r in iforest._samples(df, ["a"], "id", 20, 64, 1).groupBy("tree").count().collect()]
    assert len(sizes) == 20 and max(sizes) == 64 and min(sizes) >= 60
    few = iforest.fit(spark.range(3).select("id", F.col("id").alias("a")), ["a"], trees=5)
    assert few.feature.shape[0] == 5


def test_forecast(spark):
    lagged = catalog.lagged_rows(spark, "/root/testdata/sf0.001")
    forecast = models.volume_forecast(lagged)
    assert forecast.rmse > 0
    assert models.regression_score(forecast.predictions) == pytest.approx(forecast.rmse)
    assert models.regression_score(forecast.predictions, "r2") == pytest.approx(forecast.r2)
    assert not forecast.predictions.first()["few"]
    assert models.volume_forecast(lagged.orderBy("wiki", "windowStart").limit(60)).predictions.first()["few"]
    assert models.volume_forecast(lagged.limit(0)) is None


@pytest.mark.parametrize("by_time", [False, True])
def test_forecast_deals_its_rows_evenly(spark, by_time):
    """Rows of one wiki, which the lags leave in one task, are fitted in all; predictions read neither window nor events."""
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        counts = (F.hash("id") % 7 + 7).cast("long")
        series = spark.range(2000).select(
            F.lit("w").alias("wiki"), F.timestamp_seconds(F.col("id") * 60).alias("windowStart"), counts.alias("editCount"),
            (F.col("id") % 11).cast("double").alias("avgDelta"), (F.col("id") % 3).alias("botEdits"), F.lit(0).alias("anonEdits"),
        ).withColumns({"hourOfDay": F.hour("windowStart"), "dayOfWeek": F.dayofweek("windowStart")})
        lagged = features.add_lags(series)
        assert lagged.groupBy(F.spark_partition_id()).count().count() == 1
        found = models.volume_forecast(lagged, by_time=by_time).predictions
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) > 1 and max(sizes) < 2 * sum(sizes) / len(sizes)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "Exchange" not in plan and "Range" not in plan
        late = found.agg(F.count("*").alias("n"), F.min("windowStart").alias("t")).first()
        assert not by_time or (late["n"], late["t"].minute) == (399, 1601 % 60)
    finally:
        spark.conf.unset(coalesce)


def test_cut_in_time_does_not_depend_on_tasks(spark):
    """Three rows a minute over 56 days, one in the last minute: a sketch of them changes with their tasks."""
    rows = spark.range(240_001).select(F.timestamp_seconds(1_700_000_000 + F.floor(F.col("id") / 3) * 60).alias("windowStart"))
    wanted = -(-240_001 * 4 // 5)
    for dealt in (rows.repartition(3), rows.repartition(16), rows.coalesce(1)):
        assert models._upto_share(dealt, wanted) == 1_700_000_000 + (wanted - 1) // 3 * 60
    assert models._upto_share(rows, 1) == 1_700_000_000
    assert models._upto_share(rows, 240_001) == 1_700_000_000 + 80_000 * 60


def test_scalers_handle_constants(spark):
    df = spark.createDataFrame([(1, 5, 1.0), (2, 5, 3.0)], "id int, k int, v double")
    assert [r["k"] for r in features.minmax_scale(df, ["k"]).collect()] == [0.5, 0.5]
    assert [r["k"] for r in features.minmax_scale(df, ["k"], constant=0.0).collect()] == [0.0, 0.0]
    assert [r["k"] for r in features.standard_scale(df, ["k"]).collect()] == [0.0, 0.0]
    assert [r["v"] for r in features.standard_scale(df, ["v"], sample=False).collect()] == [-1.0, 1.0]


def test_scaling_matches_spark_ml(rows):
    from pyspark.ml.feature import MinMaxScaler, StandardScaler
    from pyspark.ml.functions import vector_to_array

    columns = list(S.CLUSTER_FEATURES)
    packed = features.assemble(rows, columns, "raw")
    for scaler, mine in (
        (StandardScaler(withMean=True, withStd=True), features.standard_scale(rows, columns)),
        (MinMaxScaler(), features.minmax_scale(rows, columns)),
    ):
        theirs = scaler.setInputCol("raw").setOutputCol("v").fit(packed).transform(packed)
        theirs = theirs.select("id", vector_to_array("v").alias("v"))
        both = theirs.join(mine.select("id", *columns), "id").limit(500).collect()
        for r in both:
            assert [r[c] for c in columns] == pytest.approx(r["v"], abs=1e-9)


def test_metrics_are_saved_in_long_form(spark, tmp_path):
    frame = models.metrics_frame(spark, {("a", "auc"): 0.5, ("a", "best"): "x", ("b", "n"): 3})
    models.save_metrics(frame, f"{tmp_path}/m")
    assert {tuple(r) for r in spark.read.parquet(f"{tmp_path}/m").collect()} == {
        ("a", "auc", 0.5, None), ("a", "best", None, "x"), ("b", "n", 3.0, None)}


def test_split_keeps_rows_without_a_key(spark):
    df = spark.createDataFrame([(None, k) for k in range(200)] + [(k, k) for k in range(200)], "id long, v int")
    train, test = features.split_by_key(df)
    assert train.count() + test.count() == 400 and train.unionAll(test).exceptAll(df).count() == 0
    assert test.where("id is null").count() > 0 and train.where("id is null").count() > 0


def test_roc_with_one_extreme_score(spark):
    rows = spark.range(30_000).select((F.rand(1) + F.col("id") % 3).alias("score"), (F.rand(2) < 0.3).cast("int").alias("label"))
    far = rows.union(spark.createDataFrame([(1e12, 1)], "score double, label int")).persist()
    counts = evaluate._score_counts(far, "score", "label")
    sizes = [r["count"] for r in counts.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 1 or max(sizes) <= 3 * sum(sizes) / len(sizes)
    ranked = spark.sql("select 1").sparkSession.createDataFrame(far.toPandas())
    local = ranked.toPandas().sort_values("score")
    pos, neg = local["label"].sum(), (1 - local["label"]).sum()
    wins = (local["label"] * (1 - local["label"]).cumsum()).sum()
    got = evaluate.roc_auc(far).first()
    assert got["areaUnderROC"] == pytest.approx(wins / (pos * neg)) and got["positives"] == pos


def test_training_job_saves_everything(spark, tmp_path):
    from editengine.plans import training

    spark.conf.set("spark.sql.shuffle.partitions", "4")
    silver = catalog.silver_rows(spark, "/root/testdata/sf0.001")
    done = training.train_all(silver, str(tmp_path))
    assert models.load_model(f"{tmp_path}/bot_classifier").stages and models.load_model(f"{tmp_path}/volume_forecast").stages
    saved = spark.read.parquet(f"{tmp_path}/metrics")
    assert saved.where("metric = 'auc'").count() == 3 and saved.where("model like 'cluster %'").count() == 25
    assert spark.read.parquet(f"{tmp_path}/trends/top_pages").count() == 15
    forest = iforest.IsolationForest.load(spark, f"{tmp_path}/isolation_forest")
    rows = features.ml_features(silver)
    one, two = (f.predict(rows).orderBy("id").select("score", "anomaly").collect() for f in (forest, done.forest))
    assert one == two
    # New rows are scaled as the forest's own were: a part of the rows gets the scores it had among all.
    part = forest.predict(rows.where("id % 7 = 0")).select("id", "score").exceptAll(done.forest.predict(rows).select("id", "score"))
    assert part.count() == 0


def test_models_of_no_rows(spark, rows, tmp_path):
    forest, flagged = iforest.fit_predict(rows.limit(0), S.CLUSTER_FEATURES)
    assert flagged.count() == 0 and {"score", "anomaly", "outlier"} <= set(flagged.columns)
    forest.save(spark, f"{tmp_path}/forest")
    loaded = iforest.IsolationForest.load(spark, f"{tmp_path}/forest")
    assert loaded.predict(rows).agg(F.max("anomaly"), F.min("outlier")).first()[:] == (0, 1)
    lagged = catalog.lagged_rows(spark, "/root/testdata/sf0.001").limit(0)
    for by_time in (False, True):
        empty = catalog._forecast_rows(lagged, by_time)
        assert empty.columns == ["wiki", "windowStart", "editCount", "prediction", "hourOfDay"] and empty.count() == 0
    with pytest.raises(ValueError):
        iforest.fit(spark.createDataFrame([(1, None)], "id long, a double"), ["a"])


def test_rows_are_summed_up_by_their_closest_centroid(spark):
    """Ties go to the first centroid, of starts of different sizes; rows pass no column expression (300 steps a row)."""
    points = [[float(a), float(b)] for a in range(60) for b in range(70)]
    df = spark.createDataFrame([(p,) for p in points], "point array<double>").repartition(7)
    centroids = {0: [[0.0, 0.0], [10.0, 0.0], [10.0, 0.0]], 3: [[30.0, 30.0], [0.0, 69.0]]}
    summed = models._sums(df, centroids)
    plan = summed._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan
    got = {(r["start"], r["cluster"]): (r["n"], r["cost"], r["total"]) for r in summed.collect()}
    want = {}
    for start, own in centroids.items():
        for p in points:
            costs = [sum((x - c) ** 2 for x, c in zip(p, centre)) for centre in own]
            n, cost, total = want.get((start, costs.index(min(costs))), (0, 0.0, [0.0, 0.0]))
            want[start, costs.index(min(costs))] = n + 1, cost + min(costs), [t + x for t, x in zip(total, p)]
    assert got == want and (0, 2) not in got
