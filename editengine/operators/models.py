"""Spark ML jobs: bot classification, clustering, volume forecasting."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import MinMaxScaler, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from editengine import schema as S
from editengine.operators import evaluate
from editengine.operators.features import split_by_key
from editengine.session import written

SEED = 42
# Rows of the sample from which clusterings choose the centroids they begin with; every round reads all rows.
SEED_ROWS = 10_000


def _scaled(columns: Sequence[str], scaler) -> list:
    return [
        VectorAssembler(inputCols=list(columns), outputCol="featuresRaw", handleInvalid="skip"),
        scaler.setInputCol("featuresRaw").setOutputCol("features"),
    ]


def _bot_pipeline(classifier) -> Pipeline:
    return Pipeline(stages=[*_scaled(S.BOT_FEATURES, StandardScaler(withMean=True, withStd=True)), classifier])


def bot_forest() -> Pipeline:
    return _bot_pipeline(
        RandomForestClassifier(featuresCol="features", labelCol="isBot", numTrees=50, maxDepth=6, seed=SEED)
    )


def bot_logistic(train_rows: int, c: float = 1.0) -> Pipeline:
    """L2 with strength 1/c on the summed loss, hence 1/(c n) on Spark's mean loss."""
    return _bot_pipeline(
        LogisticRegression(
            featuresCol="features", labelCol="isBot", maxIter=500, regParam=1.0 / (c * max(train_rows, 1)),
            standardization=False,
        )
    )


def bot_tree() -> Pipeline:
    return _bot_pipeline(DecisionTreeClassifier(featuresCol="features", labelCol="isBot", maxDepth=6, seed=SEED))


def with_probability(predictions: DataFrame) -> DataFrame:
    """The positive class's probability as a plain column."""
    return predictions.withColumn("botProbability", vector_to_array("probability")[1])


def bot_auc(predictions: DataFrame) -> float:
    """Area under ROC by probability, over all distinct scores.

    The evaluator's default column holds a decision tree's leaf counts, whose order is not that of
    the probabilities.
    """
    return BinaryClassificationEvaluator(
        rawPredictionCol="probability", labelCol="isBot", metricName="areaUnderROC", numBins=0
    ).evaluate(predictions)


@dataclass
class BotSelection:
    models: dict[str, PipelineModel]
    auc: dict[str, float]
    best: str
    test: DataFrame

    def predictions(self, name: str | None = None) -> DataFrame:
        return with_probability(self.models[name or self.best].transform(self.test))


def select_bot_model(features: DataFrame) -> BotSelection:
    """Fit the three classifiers on one split and keep the largest area under ROC."""
    train, test = split_by_key(features)
    train = train.persist()
    try:
        pipelines = {
            "LogisticRegression": bot_logistic(train.count()),
            "DecisionTree": bot_tree(),
            "RandomForest": bot_forest(),
        }
        models = {name: p.fit(train) for name, p in pipelines.items()}
    finally:
        train.unpersist()
    auc = {name: bot_auc(m.transform(test)) for name, m in models.items()}
    return BotSelection(models, auc, max(auc, key=auc.get), test)


def _sums(points: DataFrame, centroids: dict[int, Sequence[Sequence[float]]]) -> DataFrame:
    """``start``, ``cluster``, ``n``, ``cost``, ``total``: the rows closest to each centroid of each start, the first
    on ties, summed up by the map tasks in Arrow batches."""
    starts, width = sorted(centroids), len(next(iter(centroids.values()))[0])
    ends = np.cumsum([0, *(len(centroids[s]) for s in starts)]).tolist()
    table = np.array([c for s in starts for c in centroids[s]], dtype=float)

    def run(batches):
        n, cost, total = np.zeros(len(table), dtype=np.int64), np.zeros(len(table)), np.zeros((len(table), width))
        for batch in batches:
            whole = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            for begin in range(0, len(whole), 2048):  # the distances of so many rows stay in the cache
                rows = whole[begin : begin + 2048]
                far = np.zeros((len(table), len(rows)))
                for i in range(width):
                    far += (rows[:, i] - table[:, i, None]) ** 2
                for first, last in zip(ends[:-1], ends[1:]):
                    own = far[first:last].argmin(axis=0)
                    least = far[first:last][own, np.arange(len(rows))]
                    n[first:last] += np.bincount(own, minlength=last - first)
                    cost[first:last] += np.bincount(own, weights=least, minlength=last - first)
                    for i in range(width):
                        total[first:last, i] += np.bincount(own, weights=rows[:, i], minlength=last - first)
        start = np.repeat(np.array(starts, dtype=np.int32), np.diff(ends))
        cluster = np.concatenate([np.arange(last - first, dtype=np.int32) for first, last in zip(ends[:-1], ends[1:])])
        at = np.flatnonzero(n)
        columns = [start[at], cluster[at], n[at], cost[at], *total[at].T]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=names)

    names = ["start", "cluster", "n", "cost", *(f"t{i}" for i in range(width))]
    schema = "start int, cluster int, n long, cost double, " + ", ".join(f"t{i} double" for i in range(width))
    return points.select("point").mapInArrow(run, schema).groupBy("start", "cluster").agg(
        F.sum("n").alias("n"), F.sum("cost").alias("cost"), F.array(*[F.sum(f"t{i}") for i in range(width)]).alias("total")
    )


def _seeds(points: DataFrame, k: int, starts: int) -> list[list[list[float]]]:
    """The centroids that each start begins with: points of a sample of ``SEED_ROWS`` rows, those far from the chosen
    ones likelier."""
    sample = points.orderBy(F.xxhash64("point", F.lit(SEED))).limit(SEED_ROWS).toPandas()["point"]
    sample = np.unique(np.array(sample.tolist(), dtype=float), axis=0)
    out = []
    for start in range(starts):
        rng = np.random.default_rng(SEED + start)
        chosen = [sample[rng.integers(len(sample))]]
        while len(chosen) < min(k, len(sample)):
            far = np.min([((sample - c) ** 2).sum(axis=1) for c in chosen], axis=0)
            chosen.append(sample[rng.choice(len(sample), p=far / far.sum())])
        out.append([c.tolist() for c in chosen])
    return out


@dataclass
class Starts:
    """The centroids of every start, what each costs over all rows, and how often the rows were read for them."""

    centroids: list[list[list[float]]]
    costs: list[float]
    scans: int


def multi_start(points: DataFrame, k: int, starts: int, rounds: int = 20, still: float = 1e-4) -> Starts:
    """k-means from several starts over the arrays ``point``; each round is one aggregate that serves them all.

    Rows are summed up by (start, cluster) inside the map tasks, so a task sends ``starts * k`` rows whatever it
    reads. A start stays where it is when no centroid moves further than ``still``. A centroid without rows
    stays. The last scan gives the costs of the final centroids.
    """
    now, moving = _seeds(points, k, starts), set(range(starts))
    for done in range(rounds + 1):
        last = not moving or done == rounds  # costs are those of all starts
        sums = _sums(points, {s: now[s] for s in (range(starts) if last else moving)}).collect()  # a row for each centroid
        costs = [sum(r["cost"] for r in sums if r["start"] == s) for s in range(starts)]
        if last:
            return Starts(now, costs, done + 1)
        moved: dict[int, float] = {}
        for r in sums:
            if r["start"] in moving:
                after = [x / r["n"] for x in r["total"]]
                before = now[r["start"]][r["cluster"]]
                moved[r["start"]] = max(moved.get(r["start"], 0.0), sum((x - y) ** 2 for x, y in zip(after, before)))
                now[r["start"]][r["cluster"]] = after
        moving = {s for s in moving if moved.get(s, 0.0) > still**2}
    raise AssertionError("the last round returns")


def edit_clusters(features: DataFrame, k: int = 5, starts: int = 1) -> PipelineModel:
    """KMeans on min-max scaled features; of several starts, moved together, the one with the least cost."""
    scaling = Pipeline(stages=_scaled(S.CLUSTER_FEATURES, MinMaxScaler())).fit(features)
    scaled = scaling.transform(features).select("features").persist()
    kmeans = KMeans(k=k, featuresCol="features", predictionCol="cluster", seed=SEED, maxIter=20)
    try:
        if starts == 1:
            return PipelineModel(stages=[*scaling.stages, kmeans.fit(scaled)])
        tried = multi_start(scaled.select(vector_to_array("features").alias("point")), k, starts)
        best = tried.centroids[min(range(starts), key=tried.costs.__getitem__)]
        # A model of exactly these centroids: they are the only rows, and each stays its own cluster.
        rows = features.sparkSession.createDataFrame([(Vectors.dense(c),) for c in best], ["features"])
        final = kmeans.copy({kmeans.initMode: "random", kmeans.maxIter: 1, kmeans.k: max(2, len(best))}).fit(rows)
    finally:
        scaled.unpersist()
    return PipelineModel(stages=[*scaling.stages, final])


def nearest_centroid(
    df: DataFrame, columns: Sequence[str], centroids: Sequence[Sequence[float]], output: str = "cluster"
) -> DataFrame:
    """Index of the closest centroid (the first on ties), as plain expressions."""

    def squared(centroid) -> Column:
        parts = [F.pow(F.col(c) - F.lit(float(v)), F.lit(2.0)) for c, v in zip(columns, centroid)]
        return sum(parts[1:], parts[0])

    distances = F.array(*[squared(c) for c in centroids])
    return df.withColumn(output, (F.array_position(distances, F.array_min(distances)) - 1).cast("int"))


def cluster_profiles(clustered: DataFrame, places: int | None = None) -> DataFrame:
    averages = {"avgDelta": "byte_delta", "avgComment": "commentLen", "anonRatio": "isAnon", "minorRatio": "isMinor"}

    def mean(c):
        return F.avg(c) if places is None else F.round(F.avg(c), places)

    return (
        clustered.groupBy("cluster")
        .agg(F.count("*").alias("count"), *[mean(c).alias(n) for n, c in averages.items()])
        .orderBy("cluster")
    )


@dataclass
class Forecast:
    model: PipelineModel
    predictions: DataFrame
    rmse: float
    r2: float


def _upto_share(series: DataFrame, wanted: int) -> int:
    """The first second that at least ``wanted`` rows lie at or before, whatever task holds them.

    Found among the days, then among the minutes of that day, so that no window sees more than those.
    """
    second = F.unix_seconds("windowStart")
    before = 0
    for step in (86_400, 1):
        counts = series.groupBy(F.floor(second / step).alias("at")).agg(F.count("*").alias("n"))
        upto = F.sum("n").over(Window.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)) + before
        found = counts.withColumn("upto", upto).where(F.col("upto") >= wanted).orderBy("at").first()
        series, before = series.where(F.floor(second / step) == found["at"]), found["upto"] - found["n"]
    return found["at"]


def volume_forecast(lagged: DataFrame, by_time: bool = False, min_rows: int = S.MIN_LAGGED_ROWS) -> Forecast | None:
    """Gradient-boosted forecast of a minute's events; ``few`` says that there were under ``min_rows`` rows.

    ``None`` only where no row is left to learn from, or none to test on.

    The default split is random by (wiki, minute); ``by_time`` tests on the last fifth of the time
    span, so that nothing later than a test row is learnt from.
    """
    # One row per wiki and minute. The lags leave them in a task for each wiki; every tree level reads them, so they are
    # dealt evenly. They are written, so that the predictions, which are read later, do not begin at the events again.
    lagged = written(lagged.repartition("wiki", "windowStart").sortWithinPartitions("wiki", "windowStart"), "lagged")
    rows = lagged.count()
    if not rows:
        return None
    if by_time:
        late = F.unix_seconds("windowStart") > F.lit(_upto_share(lagged, math.ceil(0.8 * rows)))
        train, test = lagged.where(~late), lagged.where(late)
    else:
        keyed = lagged.withColumn("_key", F.concat_ws("|", "wiki", F.unix_seconds("windowStart")))
        train, test = (side.drop("_key") for side in split_by_key(keyed, "_key"))
    if train.isEmpty() or test.isEmpty():
        return None
    model = Pipeline(
        stages=[
            VectorAssembler(inputCols=list(S.FORECAST_FEATURES), outputCol="features", handleInvalid="skip"),
            GBTRegressor(featuresCol="features", labelCol="editCount", maxIter=30, maxDepth=4, seed=SEED),
        ]
    ).fit(train)
    predictions = model.transform(test)
    row = evaluate.regression_metrics(predictions, "editCount").first()
    return Forecast(model, predictions.withColumn("few", F.lit(rows < min_rows)), row["rmse"], row["r2"])


def regression_score(predictions: DataFrame, metric: str = "rmse", label: str = "editCount") -> float:
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName=metric).evaluate(predictions)


def feature_importances(model: PipelineModel, columns: Sequence[str]) -> DataFrame:
    """(feature, importance) in descending order; tree models only."""
    last = model.stages[-1]
    if not hasattr(last, "featureImportances"):
        raise TypeError(f"{type(last).__name__} has no feature importances")
    values = last.featureImportances.toArray().tolist()
    spark = SparkSession.active()
    return spark.createDataFrame(list(zip(columns, values)), "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def metrics_frame(spark: SparkSession, metrics: dict[tuple[str, str], float | int | str]) -> DataFrame:
    """Long form (model, metric, value, text); numbers go to ``value``, names to ``text``."""
    rows = [
        (model, metric, None, value) if isinstance(value, str) else (model, metric, float(value), None)
        for (model, metric), value in metrics.items()
    ]
    return spark.createDataFrame(rows, "model string, metric string, value double, text string")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("overwrite").parquet(path)
