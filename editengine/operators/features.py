"""Feature frames, scaling, splitting, and per-minute series with lags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from editengine import schema as S
from editengine.functions import columns as C
from editengine.operators.gold import article_edits


def ml_features(silver: DataFrame) -> DataFrame:
    """Article edits with a known bot flag, nulls filled, flags as ints; ``id`` is kept for splitting."""
    filled = {n: F.coalesce(F.col(n), F.lit(0)) for n in S.ZERO_FILLED_FEATURES}
    filled["dayOfWeek"] = F.coalesce("dayOfWeek", F.lit(1))
    return (
        article_edits(silver)
        .where(F.col("bot").isNotNull())
        .select(
            "id", "wiki", "user", "bot",
            F.col("isAnon").cast("int").alias("isAnon"),
            filled["byte_delta"].alias("byte_delta"),
            filled["title_len"].alias("title_len"),
            filled["commentLen"].alias("commentLen"),
            "minor",
            filled["hourOfDay"].alias("hourOfDay"),
            filled["dayOfWeek"].alias("dayOfWeek"),
            "editSizeCategory", "wikiLang",
            filled["latencyMs"].alias("latencyMs"),
            F.col("bot").cast("int").alias("isBot"),
            F.col("minor").cast("int").alias("isMinor"),
            C.magnitude(filled["byte_delta"]).alias("absDelta"),
        )
    )


def feature_stats(features: DataFrame) -> DataFrame:
    """One row of descriptive figures, in one pass."""
    bots = F.count_if(F.col("isBot") == 1)
    return features.agg(
        F.count("*").alias("totalEdits"),
        F.sum("byte_delta").alias("totalBytes"),
        bots.alias("botEdits"),
        (bots * 100.0 / F.greatest(F.count("*"), F.lit(1))).alias("botPercent"),
        F.max("byte_delta").alias("maxDelta"),
        F.min("byte_delta").alias("minDelta"),
    )


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """Add the feature vector; rows with a null among the columns are skipped."""
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="skip").transform(df)


def _column_stats(df: DataFrame, columns: Sequence[str], *stats):
    """One struct per column out of a single one-row aggregate, as a scalar subquery."""
    row = F.struct(*[F.struct(*[fn(c).alias(n) for n, fn in stats]).alias(c) for c in columns])
    return df.agg(row.alias("s")).scalar()


def standard_scale(df: DataFrame, columns: Sequence[str], sample: bool = True) -> DataFrame:
    """Mean 0 and deviation 1 per column; ``sample`` picks the sample deviation over the population's."""
    deviation = F.stddev_samp if sample else F.stddev_pop
    stats = _column_stats(df, columns, ("mean", F.avg), ("sd", deviation))

    def scaled(c):
        s = stats.getField(c)
        return F.when(s.getField("sd") > 0, (F.col(c) - s.getField("mean")) / s.getField("sd")).otherwise(0.0)

    return df.withColumns({c: scaled(c) for c in columns})


def minmax_scale(df: DataFrame, columns: Sequence[str], constant: float = 0.5) -> DataFrame:
    """Each column to [0, 1]; a constant column becomes ``constant``."""
    stats = _column_stats(df, columns, ("low", F.min), ("high", F.max))

    def scaled(c):
        s = stats.getField(c)
        span = s.getField("high") - s.getField("low")
        return F.when(span > 0, (F.col(c) - s.getField("low")) / span).otherwise(F.lit(constant))

    return df.withColumns({c: scaled(c) for c in columns})


def split_by_key(df: DataFrame, key: str = "id", test_share: float = 0.2, seed: int = 42):
    """(train, test): a row's side depends on its key alone, not on partitioning; without a key, on its content."""
    test = C.hash_share(C.row_key(df, key), test_share, seed)
    return df.where(~test), df.where(test)


def minute_series(silver: DataFrame) -> DataFrame:
    """Per wiki and minute: events of the main namespace, mean size change, bot and anonymous counts."""
    return (
        silver.where(F.col("namespace") == 0)
        .groupBy("wiki", F.window("eventTime", "1 minute").alias("span"))
        .agg(
            F.count("*").alias("editCount"),
            F.coalesce(F.avg("byte_delta"), F.lit(0.0)).alias("avgDelta"),
            F.coalesce(C.flag_total("bot"), F.lit(0)).alias("botEdits"),
            F.coalesce(C.flag_total("isAnon"), F.lit(0)).alias("anonEdits"),
        )
        .select("wiki", F.col("span.start").alias("windowStart"), "editCount", "avgDelta", "botEdits", "anonEdits")
        .withColumns({"hourOfDay": F.hour("windowStart"), "dayOfWeek": F.dayofweek("windowStart")})
    )


def add_lags(series: DataFrame, by: Sequence[str] = ("wiki",)) -> DataFrame:
    """Earlier rows of the same wiki beside each row; a window row is a minute, not an event."""
    order = Window.partitionBy(*by).orderBy("windowStart")
    lagged = series.withColumns(
        {
            **{f"editLag{k}": F.lag("editCount", k).over(order) for k in (1, 2, 3)},
            "deltaLag1": F.lag("avgDelta").over(order),
            "botLag1": F.lag("botEdits").over(order),
        }
    )
    return lagged.dropna()


def lag_features(silver: DataFrame) -> DataFrame:
    return add_lags(minute_series(silver))


def _laid_out(series: DataFrame, own: dict) -> DataFrame:
    """Every row once for each minute up to the next row of its wiki, with columns by the ``offset`` in minutes.

    Minutes are laid out in steps of a thousand days, a day and a minute, so that arrays stay short; the steps of
    a long gap are dealt over all tasks before its minutes are.
    """
    order = Window.partitionBy("wiki").orderBy("windowStart")  # of rows with events, not of minutes
    start = F.unix_seconds("windowStart")
    # The last row of a wiki lays out itself alone.
    length = F.coalesce(((F.unix_seconds(F.lead("windowStart").over(order)) - start) / 60).cast("long"), F.lit(1).cast("long"))
    laid, end = series.withColumn("length", length), F.col("length") - 1
    laid = laid.withColumn("era", F.explode(F.sequence(F.lit(0).cast("long"), end, F.lit(1_440_000).cast("long"))))
    tasks = int(series.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = laid.repartition(tasks, "wiki", "windowStart", "era")
    laid = laid.withColumn("day", F.explode(F.sequence("era", F.least(end, F.col("era") + 1_439_999), F.lit(1_440).cast("long"))))
    laid = laid.withColumn("offset", F.explode(F.sequence("day", F.least(end, F.col("day") + 1_439))))
    at = F.timestamp_seconds(start + F.col("offset") * 60).alias("windowStart")
    filled = laid.select("wiki", at, *[c.alias(n) for n, c in own.items()])
    return filled.withColumns({"hourOfDay": F.hour("windowStart"), "dayOfWeek": F.dayofweek("windowStart")})


def _at_offset(values: dict[int, object], zero):
    """The value for an ``offset`` among the given ones, ``zero`` for larger ones."""
    out = F.lit(zero)
    for offset, value in values.items():
        out = F.when(F.col("offset") == offset, value).otherwise(out)
    return out


ZEROS = {"editCount": 0, "avgDelta": 0.0, "botEdits": 0, "anonEdits": 0}


def whole_minutes(series: DataFrame) -> DataFrame:
    """The series with every missing minute between a wiki's first and last one as 0, however long the gap."""
    return _laid_out(series, {n: _at_offset({0: F.col(n)}, zero) for n, zero in ZEROS.items()})


def whole_lags(series: DataFrame) -> DataFrame:
    """``add_lags`` of ``whole_minutes``, without a window over minutes.

    The minute k after a row has as its lag n a zero if k > n, the row itself if k = n, else what stood n - k
    minutes before the row: one of the three rows before it, a zero if none is that old, or nothing before the
    wiki's first one. So lags follow from rows with events, before any gap is laid out.
    """
    order = Window.partitionBy("wiki").orderBy("windowStart")
    first = F.min("windowStart").over(order)
    seconds = F.unix_seconds("windowStart")

    def ago(name: str, minutes: int, zero):
        """What stood so many minutes before a row."""
        out = F.when(seconds - F.unix_seconds(first) >= 60 * minutes, F.lit(zero))
        for k in range(minutes, 0, -1):
            out = F.when(seconds - F.unix_seconds(F.lag("windowStart", k).over(order)) == 60 * minutes, F.lag(name, k).over(order)).otherwise(out)
        return out

    wanted = [("editCount", 1), ("editCount", 2), ("editCount", 3), ("avgDelta", 1), ("botEdits", 1)]
    known = series.withColumns({f"{n}_{k}": ago(n, k, ZEROS[n]) for n, k in wanted})
    own = {n: _at_offset({0: F.col(n)}, zero) for n, zero in ZEROS.items()}

    def lag(name: str, n: int):
        return _at_offset({**{k: F.col(f"{name}_{n - k}") for k in range(n)}, n: F.col(name)}, ZEROS[name])

    lags = {**{f"editLag{n}": lag("editCount", n) for n in (1, 2, 3)}, "deltaLag1": lag("avgDelta", 1), "botLag1": lag("botEdits", 1)}
    filled = _laid_out(known, {**own, **lags})
    columns = ["wiki", "windowStart", *ZEROS, "hourOfDay", "dayOfWeek", *lags]
    return filled.select(*columns).dropna()


def lag_features_dense(silver: DataFrame) -> DataFrame:
    return whole_lags(minute_series(silver))
