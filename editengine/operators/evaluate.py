"""Evaluation metrics as distributed aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from editengine.session import written



def _score_counts(scored: DataFrame, score: str, label: str) -> DataFrame:
    """Positives and negatives per distinct score, with the totals above each score and of all.

    Distinct scores are dealt into ranges by their order, not by their value, so that one far score
    does not crowd the others into a task. Each range sums up for itself; what stands above a range is
    the sum of the few range totals before it. The dealt counts are written, so that both sums see one
    dealing, and the input is read once.
    """
    counts = (
        scored.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    )
    dealt = written(counts.repartitionByRange(F.desc("score")).withColumn("range", F.spark_partition_id()), "scores")
    earlier = (Window.unboundedPreceding, -1)
    own = Window.partitionBy("range").orderBy(F.desc("score")).rowsBetween(*earlier)
    ranges = dealt.groupBy("range").agg(F.sum("pos").alias("posIn"), F.sum("neg").alias("negIn"))
    before, every = Window.orderBy("range").rowsBetween(*earlier), Window.partitionBy()  # one row per range
    totals = ranges.select(
        "range",
        *[F.coalesce(F.sum(f"{c}In").over(before), F.lit(0)).alias(f"{c}Before") for c in ("pos", "neg")],
        *[F.sum(f"{c}In").over(every).alias(f"{c}All") for c in ("pos", "neg")],
    )
    summed = dealt.withColumns({f"{c}Own": F.coalesce(F.sum(c).over(own), F.lit(0)) for c in ("pos", "neg")})
    return summed.join(totals, "range").select(
        "score", "pos", "neg", "posAll", "negAll",
        (F.col("posBefore") + F.col("posOwn")).alias("posAbove"),
        (F.col("negBefore") + F.col("negOwn")).alias("negAbove"),
    )


def roc_auc(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Exact area under the ROC curve: trapezoids over the distinct scores; one row."""
    area = F.sum(F.col("neg").cast("double") * (2.0 * F.col("posAbove") + F.col("pos")))
    return _score_counts(scored, score, label).agg(
        F.try_divide(area, 2.0 * F.sum("pos") * F.sum("neg")).alias("areaUnderROC"),
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
    )


def roc_curve(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, after the starting point with a null threshold."""
    points = _score_counts(scored, score, label).select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("negAbove") + F.col("neg"), F.col("negAll")).alias("fpr"),
        F.try_divide(F.col("posAbove") + F.col("pos"), F.col("posAll")).alias("tpr"),
    )
    start = scored.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return start.unionByName(points)


def confusion_matrix(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per actual and predicted class, all four cells present."""
    cells = [(a, p) for a in (0, 1) for p in (0, 1)]
    counted = scored.agg(
        *[F.count_if((F.col(label) == a) & (F.col(prediction) == p)).alias(f"c{a}{p}") for a, p in cells]
    )
    rows = [
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(f"c{a}{p}").alias("rows"))
        for a, p in cells
    ]
    return counted.select(F.inline(F.array(*rows)))


def classification_report(
    scored: DataFrame, label: str = "label", prediction: str = "prediction", names: tuple[str, str] = ("Human", "Bot")
) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages.

    An undefined ratio is 0. The accuracy line carries the accuracy in all three ratio columns.
    """
    c = confusion_matrix(scored, label, prediction).agg(
        *[
            F.sum(F.when((F.col("actual") == a) & (F.col("predicted") == p), F.col("rows"))).cast("double").alias(f"c{a}{p}")
            for a in (0, 1)
            for p in (0, 1)
        ]
    )

    def ratio(up, down):
        return F.coalesce(F.try_divide(up, down), F.lit(0.0))

    one = {}
    for k in (0, 1):
        hit, missed, wrong = F.col(f"c{k}{k}"), F.col(f"c{k}{1 - k}"), F.col(f"c{1 - k}{k}")
        precision, recall = ratio(hit, hit + wrong), ratio(hit, hit + missed)
        f1 = ratio(2.0 * hit, 2.0 * hit + wrong + missed)
        one[k] = (precision, recall, f1, hit + missed)
    total = one[0][3] + one[1][3]
    accuracy = ratio(F.col("c00") + F.col("c11"), total)
    macro = [(one[0][i] + one[1][i]) / 2.0 for i in range(3)]
    weighted = [ratio(one[0][i] * one[0][3] + one[1][i] * one[1][3], total) for i in range(3)]

    def line(position, name, values, support):
        fields = dict(zip(("precision", "recall", "f1"), values))
        return F.struct(
            F.lit(position).alias("position"),
            F.lit(name).alias("line"),
            *[v.alias(n) for n, v in fields.items()],
            support.cast("long").alias("support"),
        )

    lines = [
        line(0, names[0], one[0][:3], one[0][3]),
        line(1, names[1], one[1][:3], one[1][3]),
        line(2, "accuracy", [accuracy] * 3, total),
        line(3, "macro avg", macro, total),
        line(4, "weighted avg", weighted, total),
    ]
    return c.select(F.inline(F.array(*lines)))


def regression_metrics(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """RMSE and R2; the spread around the mean is a second combinable aggregate, not a big sum of squares."""
    y = F.col(label).cast("double")
    error = y - F.col(prediction).cast("double")
    return scored.agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1.0 - F.try_divide(F.sum(error * error), F.var_pop(y) * F.count(y))).alias("r2"),
        F.count("*").alias("rows"),
    )


def silhouette(clustered: DataFrame, features: str = "features", cluster: str = "cluster") -> float:
    """Mean silhouette over all rows with squared Euclidean distance (per-cluster sums, no pairs)."""
    from pyspark.ml.evaluation import ClusteringEvaluator

    return ClusteringEvaluator(predictionCol=cluster, featuresCol=features).evaluate(clustered)
