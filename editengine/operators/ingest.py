"""Ingest: filter raw events, enrich them, and shape them as keyed messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editengine import schema as S
from editengine.functions import columns as C


def filter_wiki(raw: DataFrame, wiki: str | None = None) -> DataFrame:
    return raw if wiki is None else raw.where(F.col("wiki") == wiki)


def filter_types(raw: DataFrame, types: Sequence[str] | None = None) -> DataFrame:
    return raw if not types else raw.where(F.col("type").isin(*types))


def stamp_arrival(raw: DataFrame) -> DataFrame:
    """``ingestion_ts``: epoch milliseconds of this batch's start, the same in every time zone."""
    return raw.withColumn("ingestion_ts", F.unix_millis(F.current_timestamp()))


def enrich(raw: DataFrame) -> DataFrame:
    """Add the derived fields; stamp the arrival only where the input carries none."""
    if "ingestion_ts" not in raw.columns:
        raw = stamp_arrival(raw)
    return raw.withColumns(
        {
            "is_bot": C.flag_or_false(F.col("bot")),
            "namespace_str": C.namespace_label(F.col("namespace")),
            "byte_delta": C.size_change(F.col("length")),
            "title_len": C.text_length(F.col("title")),
        }
    )


def serialize(events: DataFrame) -> DataFrame:
    """``(key, value)`` messages: wiki name and the whole record as JSON."""
    return events.select(
        C.event_key(F.col("wiki")).alias("key"), F.to_json(F.struct(*events.columns)).alias("value")
    )


def key_ordered(events: DataFrame, partitions: int | None = None) -> DataFrame:
    """Events laid out so that each wiki's events are adjacent and in arrival order.

    Ranges over (key, arrival, id) keep the order of a key across neighbouring partitions, so a wiki
    with a large part of all events is spread over many tasks instead of filling one. The order holds
    for tables; tasks that publish to a broker run side by side, so there the contract is in the message:
    consumers order a key by ``ingestion_ts``, then ``id``.
    """
    keyed = events.withColumn("key", C.event_key(F.col("wiki")))
    order = ["key", "ingestion_ts", "id"]
    ranged = keyed.repartitionByRange(partitions, *order) if partitions else keyed.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


def parse_lines(lines: DataFrame) -> DataFrame:
    """Raw records of JSON ``value`` lines, with the line and its outcome alongside; only objects are records."""
    value = F.col("value")
    outcome = (
        F.when(value.isNull() | (F.trim(value) == ""), "blank")
        .when(F.try_parse_json(value).isNull() | ~F.ltrim(value).startswith("{"), "error")
        .otherwise("record")
    )
    record = F.from_json(value, f"{S.RAW_DDL}, ingestion_ts long")
    # A generator: what is built on the record reads it, and does not parse it again.
    return lines.select(F.inline(F.array(F.struct(value.alias("value"), outcome.alias("outcome"), record.alias("e")))))


def _kept(wiki: str | None, types: Sequence[str] | None):
    kept = F.lit(True)
    if wiki is not None:
        kept = kept & F.col("e.wiki").eqNullSafe(wiki)
    if types:
        kept = kept & F.coalesce(F.col("e.type").isin(*types), F.lit(False))
    return kept


def publishable(lines: DataFrame, wiki: str | None = None, types: Sequence[str] | None = None) -> DataFrame:
    """``(key, value)`` messages of the feed's records, batch or stream, each as it came with the derived fields added.

    The record's own text is kept, so fields outside the schema, nulls and nested objects survive. The
    derived fields come last; a reader takes the last of two fields of one name.
    """
    records = parse_lines(lines).where((F.col("outcome") == "record") & _kept(wiki, types))
    stamped = F.coalesce(F.col("e.ingestion_ts"), F.unix_millis(F.current_timestamp()))
    derived = F.to_json(F.struct(
        stamped.alias("ingestion_ts"),
        C.flag_or_false(F.col("e.bot")).alias("is_bot"),
        C.namespace_label(F.col("e.namespace")).alias("namespace_str"),
        C.size_change(F.col("e.length")).alias("byte_delta"),
        C.text_length(F.col("e.title")).alias("title_len"),
    ))
    body = F.regexp_replace("value", r"\s*\}\s*$", "")
    comma = F.when(body.endswith("{"), "").otherwise(",")
    return records.select(C.event_key(F.col("e.wiki")).alias("key"), F.concat(body, comma, F.substring(derived, 2, 1 << 20)).alias("value"))


def counters(
    lines: DataFrame, wiki: str | None = None, types: Sequence[str] | None = None
) -> DataFrame:
    """One row: published, filtered out, unparsable and blank lines, in a single pass."""
    return parse_lines(lines).agg(*_counted(wiki, types))


def _counted(wiki: str | None, types: Sequence[str] | None) -> list:
    kept, record = _kept(wiki, types), F.col("outcome") == "record"
    return [
        F.count_if(record & kept).alias("published"),
        F.count_if(record & ~kept).alias("filtered_out"),
        F.count_if(F.col("outcome") == "error").alias("parse_errors"),
        F.count_if(F.col("outcome") == "blank").alias("blank"),
    ]


def observed(lines: DataFrame, name: str = "feed", wiki: str | None = None, types: Sequence[str] | None = None) -> DataFrame:
    """The lines of a stream, counted as they pass; the figures come with every progress report, from which rates follow."""
    return parse_lines(lines).observe(name, *_counted(wiki, types)).select("value")
