"""Bronze: typed, flat events out of JSON messages, and what is left behind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editengine.schema import EVENT_DDL


def _parsed() -> Column:
    return F.from_json(F.col("value").cast("string"), EVENT_DDL)


def to_bronze(messages: DataFrame) -> DataFrame:
    """Events with a wiki; a field of the wrong type becomes null, its record stays.

    The record is flattened by a generator: a filter does not move below it, so every message is
    parsed once and not once more for the filter.
    """
    return messages.select(F.inline(F.array(_parsed()))).where(F.col("wiki").isNotNull())


def rejects(messages: DataFrame) -> DataFrame:
    """The messages that ``to_bronze`` leaves out, each with a cause."""
    text = F.col("value").cast("string")
    cause = (
        F.when(text.isNull() | (F.trim(text) == ""), "blank")
        .when(F.try_parse_json(text).isNull(), "malformed")
        .when(~F.ltrim(text).startswith("{"), "not_an_object")
        .otherwise("no_wiki")
    )
    wiki = _parsed().getField("wiki")
    return messages.where(wiki.isNull()).select(text.alias("value"), cause.alias("cause"))


def reject_counts(messages: DataFrame) -> DataFrame:
    return rejects(messages).groupBy("cause").agg(F.count("*").alias("records"))
