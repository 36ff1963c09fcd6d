"""The training job: fit, evaluate and save every model of the silver table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editengine import schema as S
from editengine.operators import evaluate, features, iforest, models, trends


@dataclass
class Training:
    selection: models.BotSelection
    clusters: PipelineModel
    forest: iforest.IsolationForest
    forecast: models.Forecast | None
    summary: DataFrame


def report_metrics(selection: models.BotSelection) -> DataFrame:
    """The best classifier's report in the long form of the metrics table."""
    columns = [F.col("isBot").alias("label"), F.col("prediction").cast("int").alias("prediction")]
    report = evaluate.classification_report(selection.predictions().select(*columns))
    entries = [
        F.struct(F.concat_ws(" ", "line", F.lit(m)).alias("metric"), F.col(m).cast("double").alias("value"))
        for m in ("precision", "recall", "f1", "support")
    ]
    return report.select(F.explode(F.array(*entries)).alias("m")).select(
        F.lit(selection.best).alias("model"), "m.metric", "m.value", F.lit(None).cast("string").alias("text")
    )


def cluster_metrics(clustered: DataFrame) -> DataFrame:
    profile = models.cluster_profiles(clustered, places=2)
    entries = [
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in profile.columns if m != "cluster"
    ]
    return profile.select("cluster", F.explode(F.array(*entries)).alias("m")).select(
        F.concat(F.lit("cluster "), "cluster").alias("model"), "m.metric", "m.value", F.lit(None).cast("string").alias("text")
    )


def train_all(silver: DataFrame, out: str | None = None) -> Training:
    """Fit the classifiers, clusters, isolation forest and forecast; with ``out`` save models and metrics."""
    spark = silver.sparkSession
    rows = features.ml_features(silver).persist()
    try:
        selection = models.select_bot_model(rows)
        clusters = models.edit_clusters(rows, starts=10)
        clustered = clusters.transform(rows)
        forest, flagged = iforest.fit_predict(rows, S.CLUSTER_FEATURES)
        anomalies = flagged.agg(F.sum("anomaly")).first()[0]
        forecast = models.volume_forecast(features.lag_features(silver))
        top = trends.top_pages(silver, 1).first()
        figures = {(name, "auc"): auc for name, auc in selection.auc.items()}
        figures |= {
            ("bot", "best_name"): selection.best,
            ("bot", "best_auc"): selection.auc[selection.best],
            ("clusters", "silhouette"): evaluate.silhouette(clustered),
            ("isolation_forest", "anomalies"): anomalies,
            ("trends", "top_page"): top["title"] if top else "N/A",
        }
        if forecast:
            figures |= {("volume", "rmse"): forecast.rmse, ("volume", "r2"): forecast.r2}
        summary = models.metrics_frame(spark, figures)
        if out:
            models.save_model(selection.models[selection.best], f"{out}/bot_classifier")
            models.save_model(clusters, f"{out}/edit_clusters")
            forest.save(spark, f"{out}/isolation_forest")
            if forecast:
                models.save_model(forecast.model, f"{out}/volume_forecast")
            metrics = summary.unionByName(report_metrics(selection)).unionByName(cluster_metrics(clustered))
            models.save_metrics(metrics, f"{out}/metrics")
            for name, table in {
                "top_pages": trends.top_pages(silver), "hourly_edits": trends.hourly_edits(silver),
                "top_wikis": trends.top_wikis(silver), "size_distribution": trends.size_distribution(silver),
                "bot_ratio_by_wiki": trends.bot_ratio_by_wiki(silver),
            }.items():
                table.write.mode("overwrite").parquet(f"{out}/trends/{name}")
    finally:
        rows.unpersist()
    return Training(selection, clusters, forest, forecast, summary)
