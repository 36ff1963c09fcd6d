"""Scalar rules of the ingest, silver and serving layers, as column expressions.

All of them run inside whole-stage code generation. Arithmetic on feed values uses the ``try_``
forms: one absurd number in a record gives null for that field and does not end the job.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editengine import schema as S

# Largest whole second that still fits a microsecond timestamp.
_MAX_SECOND = 9_223_372_036_854


def namespace_label(namespace: Column) -> Column:
    known = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in S.NAMESPACE_LABELS.items()))
    number = F.coalesce(namespace, F.lit(-1))
    return F.coalesce(F.try_element_at(known, number), F.concat(F.lit("ns_"), number.cast("string")))


def size_change(length: Column) -> Column:
    return F.try_subtract(length.getField("new"), length.getField("old"))


def text_length(text: Column) -> Column:
    return F.length(F.coalesce(text, F.lit("")))


def flag_or_false(flag: Column) -> Column:
    return F.coalesce(flag, F.lit(False))


def flag_total(name: str) -> Column:
    """How many rows have the flag set; null where no row knows it."""
    return F.sum(F.col(name).cast("int"))


def event_key(wiki: Column) -> Column:
    return F.coalesce(wiki, F.lit("unknown"))


def second_to_timestamp(second: Column) -> Column:
    return F.timestamp_seconds(F.when(second.between(-_MAX_SECOND, _MAX_SECOND), second))


def milli_to_timestamp(milli: Column) -> Column:
    """Whole seconds, truncated toward zero."""
    return second_to_timestamp((milli / 1000).cast("long"))


def latency(ingestion_ts: Column, timestamp: Column) -> Column:
    return F.try_subtract(ingestion_ts, F.try_multiply(timestamp, F.lit(1000).cast("long")))


def is_ipv4_text(user: Column) -> Column:
    return user.rlike(S.IPV4_TEXT)


def edit_size(delta: Column) -> Column:
    tests = {
        "is null": delta.isNull(), "> 5000": delta > 5000, "> 500": delta > 500, ">= 0": delta >= 0,
        "> -500": delta > -500, "is not null": delta.isNotNull(),
    }
    label = F.lit(None).cast("string")
    for condition, name in reversed(S.SIZE_RULES):
        label = F.when(tests[condition], name).otherwise(label)
    return label


def wiki_lang(wiki: Column) -> Column:
    """Leading lower-case letters: ``enwiki`` stays whole, ``zh_min_nanwiki`` gives ``zh``."""
    return F.regexp_extract(wiki, S.WIKI_LANG, 1)


def lang_code(wiki: Column) -> Column:
    """The language part alone: ``enwiki`` gives ``en``."""
    return F.regexp_extract(wiki, S.LANG_CODE, 1)


def text_or(text: Column, default: str) -> Column:
    """``default`` where the text is null or empty."""
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(default))


def round_half_even(value: Column, places: int = 2) -> Column:
    scale = float(10**places)
    return F.rint(value * scale) / scale


def magnitude(delta: Column) -> Column:
    return F.abs(delta.cast("long"))


def clipped(value: Column, bound: int) -> Column:
    return F.greatest(F.lit(-bound), F.least(F.lit(bound), value))


def comment_bin(length: Column) -> Column:
    """Ordinal of the half-open bin, null outside all bins."""
    ordinal = F.lit(None).cast("int")
    for i, (low, high, _) in enumerate(S.COMMENT_BINS):
        ordinal = F.when((length > low) & (length <= high), i).otherwise(ordinal)
    return ordinal


def comment_bin_label(ordinal: Column) -> Column:
    return F.element_at(F.array(*[F.lit(label) for *_, label in S.COMMENT_BINS]), ordinal + 1)


def row_key(df: DataFrame, key: str) -> Column:
    """The key as text; a row without one is told apart by its content, so it is never lost."""
    return F.coalesce(F.col(key).cast("string"), F.concat(F.lit("row "), F.xxhash64(*df.columns).cast("string")))


def hash_share(key: Column, share: float, seed: int = 42) -> Column:
    """True for about ``share`` of the keys; the same keys on every run and partitioning."""
    cut = format(min(int(share * 16**8), 16**8 - 1), "08x")
    return F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), 1, 8) < cut
