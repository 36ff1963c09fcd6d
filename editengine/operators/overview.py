"""Key figures and chart data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editengine import schema as S
from editengine.functions import columns as C


def kpi_silver(silver: DataFrame) -> DataFrame:
    return silver.agg(
        F.count("*").alias("totalRows"),
        F.count_if(F.col("type") == "edit").alias("edits"),
        F.lit(len(silver.columns)).cast("long").alias("columnCount"),
        F.count_distinct("wiki").alias("wikis"),
    )


def kpi_store(store: DataFrame) -> DataFrame:
    """Row, edit, wiki, user and page counts in one scan; repeated values are dropped before the shuffle."""
    return store.agg(
        F.count("*").alias("totalRows"),
        F.count_if(F.col("type") == "edit").alias("edits"),
        F.count_distinct("wiki").alias("wikis"),
        F.count_distinct("user_name").alias("users"),
        F.count_distinct("title").alias("pages"),
    )


def schema_table(df: DataFrame) -> DataFrame:
    """Column name, type and number of values present."""
    flat = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    counted = df.agg(*[F.count(F.col(f"`{n}`")).alias(n) for n, _ in flat])
    rows = F.array(
        *[F.struct(F.lit(n).alias("column"), F.lit(t).alias("type"), F.col(f"`{n}`").alias("present")) for n, t in flat]
    )
    return counted.select(F.inline(rows))


def sample_rows(df: DataFrame, columns: Sequence[str] = S.DISPLAY_COLUMNS, key: str = "id", n: int = 50) -> DataFrame:
    """The first ``n`` rows by key, with those display columns that exist."""
    return df.orderBy(key).limit(n).select(*[c for c in columns if c in df.columns])


def class_distribution(features: DataFrame) -> DataFrame:
    """Edits per class; a class without edits is reported as 0."""
    counted = features.agg(*[F.count_if(F.col("isBot") == k).alias(f"c{k}") for k in (0, 1)])
    rows = F.array(*[F.struct(F.lit(k).alias("isBot"), F.col(f"c{k}").alias("edits")) for k in (0, 1)])
    return counted.select(F.inline(rows))


def delta_histogram(df: DataFrame, bins: int = 50, bound: int = 3000, value: str = "byte_delta") -> DataFrame:
    """Density histogram of the clipped value over its own range; empty bins are listed as 0."""
    values = df.where(F.col(value).isNotNull()).select(C.clipped(F.col(value), bound).cast("double").alias("v"))
    low, high = F.min("v"), F.max("v")
    flat = low == high
    span = values.agg(
        F.struct(
            F.when(flat, low - 0.5).otherwise(low).alias("low"),
            F.when(flat, high + 0.5).otherwise(high).alias("high"),
            F.count("*").alias("n"),
        ).alias("s")
    ).scalar()
    width = (span.getField("high") - span.getField("low")) / bins
    counted = (
        values.groupBy(
            F.least(F.lit(bins - 1), F.floor((F.col("v") - span.getField("low")) / width)).cast("int").alias("bin")
        )
        .agg(F.count("*").alias("edits"))
    )
    ticks = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    edits = F.coalesce("edits", F.lit(0))
    return ticks.join(counted, "bin", "left").select(
        "bin",
        (span.getField("low") + F.col("bin") * width).alias("binStart"),
        edits.alias("edits"),
        (edits / (span.getField("n") * width)).alias("density"),
    )


def chart_top_n(df: DataFrame, label: str, order: Sequence, width: int = 40, n: int = 15) -> DataFrame:
    """The chart's first rows, with the label cut to fit."""
    return df.orderBy(*order).limit(n).withColumn(label, F.substring(label, 1, width))


def scatter_points(
    scored: DataFrame, share: float | None = None, columns: Sequence[str] = ("byte_delta", "commentLen", "anomaly")
) -> DataFrame:
    """Points to draw: all of them, or a repeatable share by id."""
    points = scored if share is None else scored.where(C.hash_share(C.row_key(scored, "id"), share))
    return points.select(*columns)
