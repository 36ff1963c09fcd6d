"""Trends over article edits (silver dialect)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editengine.operators.gold import article_edits


def _base(silver: DataFrame) -> DataFrame:
    return article_edits(silver).select(
        "title",
        "wikiLang",
        "hourOfDay",
        "editSizeCategory",
        F.coalesce("byte_delta", F.lit(0)).alias("byte_delta"),
        F.coalesce(F.col("bot").cast("int"), F.lit(0)).alias("isBot"),
    )


def top_pages(silver: DataFrame, n: int | None = 15) -> DataFrame:
    pages = (
        _base(silver)
        .where(F.col("title").isNotNull())
        .groupBy("title")
        .agg(
            F.count("*").alias("editCount"),
            F.sum("byte_delta").alias("totalDelta"),
            F.sum("isBot").alias("botEdits"),
        )
        .orderBy(F.desc("editCount"), "title")
    )
    return _first(pages, n)


def hourly_edits(silver: DataFrame) -> DataFrame:
    return (
        _base(silver)
        .where(F.col("hourOfDay").isNotNull())
        .groupBy("hourOfDay")
        .agg(F.count("*").alias("editCount"))
        .orderBy("hourOfDay")
    )


def _by_language(silver: DataFrame, total: str) -> DataFrame:
    return (
        _base(silver)
        .where(F.col("wikiLang").isNotNull())
        .groupBy("wikiLang")
        .agg(F.count("title").alias(total), F.sum("isBot").alias("botEdits"))
    )


def _first(rows: DataFrame, n: int | None) -> DataFrame:
    return rows if n is None else rows.limit(n)


def top_wikis(silver: DataFrame, n: int | None = 10) -> DataFrame:
    return _first(_by_language(silver, "editCount").orderBy(F.desc("editCount"), "wikiLang"), n)


def size_distribution(silver: DataFrame) -> DataFrame:
    return (
        _base(silver)
        .where(F.col("editSizeCategory").isNotNull())
        .groupBy("editSizeCategory")
        .agg(F.count("*").alias("editCount"))
        .orderBy(F.desc("editCount"), "editSizeCategory")
    )


def bot_ratio_by_wiki(silver: DataFrame, n: int | None = 10) -> DataFrame:
    ratio = F.try_divide("botEdits", "totalEdits")
    return _first(_by_language(silver, "totalEdits").withColumn("botRatio", ratio).orderBy(F.desc("botRatio"), "wikiLang"), n)
