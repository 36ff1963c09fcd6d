"""Exact interpolated percentiles whose working set per task is bounded.

The built-in exact percentile keeps every distinct value of a group in one task. Here values are
counted first (combined on the map side), the counts are summed into slabs of 2**16 neighbouring
values, and only the slab holding the wanted rank is looked into. Slabs are summed into blocks of 2**16
neighbouring slabs, and those once more, so a long column has four levels of at most 2**16 entries each:
no window below sees more than 65,536 rows, however large a group is. Decimals are counted as the whole
numbers of their last place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _whole(df: DataFrame, value: str) -> tuple[Column, tuple[int, ...], float]:
    """The value as a whole number, the shifts of its levels, and what to divide the result by."""
    kind = df.schema[value].dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        return F.col(value).cast("int"), (16, 0), 1.0
    if isinstance(kind, T.LongType):
        return F.col(value), (48, 32, 16, 0), 1.0
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        unit = 10**kind.scale
        return (F.col(value).cast(f"decimal(38,{kind.scale})") * F.lit(unit)).cast("long"), (48, 32, 16, 0), float(unit)
    raise TypeError(f"{value} is {kind.simpleString()}; cast it to a whole number or a decimal of up to 18 digits")


def exact_percentile(
    df: DataFrame, value: str, share: float, by: Sequence[str] = (), name: str = "percentile"
) -> DataFrame:
    """``share`` percentile of an integral or decimal column per ``by`` group, linear between neighbours.

    Null values and null groups are left out. Without ``by`` the result has one row.
    """
    by = list(by)
    number, shifts, unit = _whole(df, value)
    usable = df.where(F.col(value).isNotNull())
    for c in by:
        usable = usable.where(F.col(c).isNotNull())
    keys = by or ["_all"]
    if not by:
        usable = usable.withColumn("_all", F.lit(0))

    # coalesce marks the value as never null, so the joins below add no null filter to one side only
    # and both sides read the same exchange.
    known = F.coalesce(number, F.lit(0))
    counts = usable.groupBy(*keys, known.alias("_v")).agg(F.count("*").alias("_n"))
    upto = (Window.unboundedPreceding, 0)
    held, place = ["_pos", "_lo", "_hi"], F.shiftright("_v", shifts[0])
    groups = Window.partitionBy(*keys)
    level = (
        counts.groupBy(*keys, place.alias("_at"))
        .agg(F.sum("_n").alias("_in"))
        .withColumn("_upto", F.sum("_in").over(groups.orderBy("_at").rowsBetween(*upto)))
        .withColumn("_pos", (F.sum("_in").over(groups) - 1) * F.lit(float(share)))
        .withColumns({"_lo": F.floor("_pos"), "_hi": F.ceil("_pos")})
    )
    wanted = "(_lo >= _upto - _in and _lo < _upto) or (_hi >= _upto - _in and _hi < _upto)"
    for above, shift in zip(shifts, shifts[1:]):
        opened = level.where(wanted).select(*keys, F.col("_at").alias("_up"), (F.col("_upto") - F.col("_in")).alias("_before"), *held)
        inside = Window.partitionBy(*keys, "_up").orderBy("_at").rowsBetween(*upto)
        level = (
            counts.withColumn("_up", F.shiftright("_v", above))
            .join(opened, [*keys, "_up"])
            .groupBy(*keys, "_up", "_before", *held, F.shiftright("_v", shift).alias("_at"))
            .agg(F.sum("_n").alias("_in"))
            .withColumn("_upto", F.col("_before") + F.sum("_in").over(inside))
        )
    found = level.groupBy(*keys).agg(
        F.max(F.expr("if(_lo >= _upto - _in and _lo < _upto, _at, null)")).alias("_low"),
        F.max(F.expr("if(_hi >= _upto - _in and _hi < _upto, _at, null)")).alias("_high"),
        F.max(F.col("_pos") - F.col("_lo")).alias("_part"),
    )
    low, high = F.col("_low").cast("double") / unit, F.col("_high").cast("double") / unit
    return found.select(*by, (low + (high - low) * F.col("_part")).alias(name))
