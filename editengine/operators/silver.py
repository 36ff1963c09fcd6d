"""Silver: nine derived columns, and the rows that are usable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editengine.functions import columns as C
from editengine.schema import EVENT_TYPES


def derived_columns() -> dict[str, Column]:
    """All but the calendar columns, which read ``eventTime``."""
    return {
        "eventTime": C.second_to_timestamp(F.col("timestamp")),
        "ingestionTime": C.milli_to_timestamp(F.col("ingestion_ts")),
        "latencyMs": C.latency(F.col("ingestion_ts"), F.col("timestamp")),
        "isAnon": C.is_ipv4_text(F.col("user")),
        "editSizeCategory": C.edit_size(F.col("byte_delta")),
        "commentLen": C.text_length(F.col("comment")),
        "wikiLang": C.wiki_lang(F.col("wiki")),
    }


def calendar_columns(time: Column) -> dict[str, Column]:
    return {"hourOfDay": F.hour(time), "dayOfWeek": F.dayofweek(time)}


def add(events: DataFrame, *names: str) -> DataFrame:
    """Some of the derived columns alone; ``langCode`` is available here too."""
    derived = derived_columns()
    available = {
        **derived, **calendar_columns(derived["eventTime"]), "langCode": C.lang_code(F.col("wiki"))
    }
    return events.withColumns({n: available[n] for n in names})


def valid_time(events: DataFrame) -> DataFrame:
    return events.where(F.col("timestamp") > 0)


def known_type(events: DataFrame) -> DataFrame:
    return events.where(F.col("type").isin(*EVENT_TYPES))


def to_silver(bronze: DataFrame) -> DataFrame:
    """Filter first, derive afterwards. Batch or stream.

    The calendar columns are a step of their own so that the event time is computed once for all
    three, which also keeps the generated method small enough for the JIT compiler.
    """
    usable = known_type(valid_time(bronze)).withColumns(derived_columns())
    return usable.withColumns(calendar_columns(F.col("eventTime")))
