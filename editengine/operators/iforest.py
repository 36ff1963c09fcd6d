"""Isolation forest, which Spark ML does not have.

Each tree grows on its own small random sample, so growing is one small task per tree; scoring
needs only the trees (bounded by trees x sample size) and runs over all rows in Arrow batches.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from editengine.session import written

# Workers get these functions with the task, so the package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_ARRAYS = ("feature", "cut", "low", "high", "path")
_NODES = "tree int, node int, feature int, cut double, low int, high int, depth int, rows int"


def _average_path(n):
    """Mean length of an unsuccessful search among n points in a random search tree."""
    n = np.asarray(n, dtype="float64")
    harmonic = np.log(np.maximum(n - 1, 1)) + np.euler_gamma
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def _grow(x: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    """Nodes of one tree as (node, feature, cut, low, high, depth, rows); feature -1 marks a leaf."""
    nodes = [None]
    todo = [(0, np.arange(len(x)), 0)]
    while todo:
        node, rows, depth = todo.pop()
        part = x[rows]
        spread = np.flatnonzero(part.max(axis=0) > part.min(axis=0)) if len(rows) > 1 else []
        if depth >= limit or len(spread) == 0:
            nodes[node] = (node, -1, 0.0, -1, -1, depth, len(rows))
            continue
        feature = int(rng.choice(spread))
        values = part[:, feature]
        cut = rng.uniform(values.min(), values.max())
        below = values <= cut
        low, high = len(nodes), len(nodes) + 1
        nodes += [None, None]
        nodes[node] = (node, feature, float(cut), low, high, depth, len(rows))
        todo += [(low, rows[below], depth + 1), (high, rows[~below], depth + 1)]
    return nodes


def _scaled(x: np.ndarray, base: np.ndarray, span: np.ndarray) -> np.ndarray:
    """Each column to [0, 1] as when the forest was fitted; a column that was constant then becomes 0.5."""
    return np.where(span > 0, (x - base) / np.where(span > 0, span, 1.0), 0.5)


def _samples(df: DataFrame, columns: Sequence[str], key: str, trees: int, size: int, seed: int) -> DataFrame:
    """About ``size`` rows for each tree, drawn independently per tree.

    A first hash keeps a pool whose size does not depend on the input; only the pool is looked at
    once per tree. The rows of a tree are then cut to ``size`` by hash order.
    """
    total = df.count()
    if total == 0:
        raise ValueError("isolation forest needs at least one row")
    per_tree = min(1.0, 1.5 * size / total)
    pooled = min(1.0, per_tree * trees)
    unit = 2.0**53

    def uniform(*salt):
        return F.shiftrightunsigned(F.xxhash64(F.col(key), *salt), 11) / unit

    pool = df.select(key, *[F.col(c).cast("double").alias(c) for c in columns]).where(uniform(F.lit(seed)) < pooled)
    drawn = (
        pool.select("*", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
        .withColumn("draw", uniform(F.lit(seed + 1), F.col("tree")))
        .where(F.col("draw") < per_tree / pooled)
    )
    first = Window.partitionBy("tree").orderBy("draw", key)
    return drawn.withColumn("place", F.row_number().over(first)).where(F.col("place") <= size)


@dataclass
class IsolationForest:
    """``base`` and ``span`` are the columns' smallest values and ranges where the forest was fitted."""

    columns: list[str]
    base: np.ndarray
    span: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    low: np.ndarray
    high: np.ndarray
    path: np.ndarray
    norm: float
    levels: int
    threshold: float | None = None

    def save(self, spark: SparkSession, path: str) -> None:
        """One row per tree node, with the forest's own figures alongside."""
        tree, node = np.indices(self.feature.shape).reshape(2, -1)
        nodes = pd.DataFrame({"tree": tree, "node": node, **{n: getattr(self, n).ravel() for n in _ARRAYS}})
        (
            spark.createDataFrame(nodes)
            .withColumns({
                "columns": F.array(*[F.lit(c) for c in self.columns]), "norm": F.lit(self.norm),
                "base": F.array(*[F.lit(float(v)) for v in self.base]), "span": F.array(*[F.lit(float(v)) for v in self.span]),
                "levels": F.lit(self.levels), "threshold": F.lit(self.threshold),
            })
            .write.mode("overwrite").parquet(path)
        )

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> IsolationForest:
        nodes = spark.read.parquet(path).toPandas().sort_values(["tree", "node"])  # trees x nodes rows
        shape = (nodes["tree"].nunique(), nodes["node"].nunique())
        arrays = {n: nodes[n].to_numpy().reshape(shape) for n in _ARRAYS}
        first = nodes.iloc[0]
        return cls(
            list(first["columns"]), np.array(first["base"], dtype="float64"), np.array(first["span"], dtype="float64"), **arrays, norm=float(first["norm"]), levels=int(first["levels"]),
            threshold=float(first["threshold"]),
        )

    def score(self, df: DataFrame, output: str = "score") -> DataFrame:
        """Add the anomaly score in (0, 1); higher is more isolated."""
        shared = df.sparkSession.sparkContext.broadcast(
            (self.base, self.span, self.feature, self.cut, self.low, self.high, self.path, self.norm, self.levels)
        )

        @F.pandas_udf("double")
        def isolation(rows: pd.DataFrame) -> pd.Series:
            base, span, feature, cut, low, high, path, norm, levels = shared.value
            x = _scaled(rows.to_numpy("float64"), base, span)
            n, (trees, nodes) = len(x), feature.shape
            out = np.empty(n)
            for begin in range(0, n, 2048):  # all trees at once, for as many rows as stay in the cache
                part = np.ascontiguousarray(x[begin : begin + 2048])
                row = (np.arange(len(part)) * part.shape[1])[:, None]
                root = (np.arange(trees) * nodes)[None, :]
                at = np.broadcast_to(root, (len(part), trees)).copy()
                for _ in range(levels):
                    f = feature.ravel()[at]
                    below = part.ravel()[row + np.maximum(f, 0)] <= cut.ravel()[at]
                    step = root + np.where(below, low.ravel()[at], high.ravel()[at])
                    at = np.where(f < 0, at, step)
                out[begin : begin + 2048] = path.ravel()[at].mean(axis=1)
            return pd.Series(2.0 ** (-out / norm))

        return df.withColumn(output, isolation(F.struct(*[F.col(c).cast("double").alias(c) for c in self.columns])))

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``score``, ``anomaly`` (0/1) and ``outlier`` (1 normal, -1 anomaly)."""
        return self.flag(self.score(df))

    def flag(self, scored: DataFrame) -> DataFrame:
        flagged = F.col("score") > F.lit(self.threshold)
        return scored.withColumns(
            {"anomaly": flagged.cast("int"), "outlier": F.when(flagged, -1).otherwise(1)}
        )


def fit(
    df: DataFrame,
    columns: Sequence[str],
    key: str = "id",
    trees: int = 100,
    sample_size: int = 256,
    contamination: float = 0.05,
    seed: int = 42,
    accuracy: int = 100_000,
) -> IsolationForest:
    return fit_predict(df, columns, key, trees, sample_size, contamination, seed, accuracy)[0]


def fit_predict(
    df: DataFrame,
    columns: Sequence[str],
    key: str = "id",
    trees: int = 100,
    sample_size: int = 256,
    contamination: float = 0.05,
    seed: int = 42,
    accuracy: int = 100_000,
) -> tuple[IsolationForest, DataFrame]:
    """The forest, and ``key`` and ``columns`` of the rows it was fitted on with their predictions.

    The rows' key and columns are written once; growing, scoring and the threshold read them there, and
    each row is scored once. Columns are scaled to their ranges, which stay with the forest. Of an empty
    frame the forest is a single leaf, which calls nothing an outlier.
    """
    columns = list(columns)
    kept = written(df.select(key, *[F.col(c).cast("double").alias(c) for c in columns]), "forest-rows")
    ranges = kept.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("low", F.min), ("high", F.max))]).first()
    if any(ranges[f"low_{c}"] is None for c in columns):
        if not kept.isEmpty():
            raise ValueError("isolation forest needs a value in every column")
        leaf = np.full((1, 1), -1, dtype="int32")
        bare = np.zeros((1, 1))
        forest = IsolationForest(
            columns, np.zeros(len(columns)), np.ones(len(columns)), leaf, bare, leaf, leaf, bare, norm=1.0, levels=0, threshold=1.0
        )
        return forest, forest.flag(kept.withColumn("score", F.lit(1.0)))
    base = np.array([ranges[f"low_{c}"] for c in columns])
    span = np.array([ranges[f"high_{c}"] for c in columns]) - base

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        tree = int(rows["tree"].iloc[0])
        limit = max(1, math.ceil(math.log2(max(len(rows), 2))))
        nodes = _grow(_scaled(rows[columns].to_numpy("float64"), base, span), np.random.default_rng([seed, tree]), limit)
        return pd.DataFrame(
            [(tree, *n) for n in nodes],
            columns=["tree", "node", "feature", "cut", "low", "high", "depth", "rows"],
        )

    samples = _samples(kept, columns, key, trees, sample_size, seed)
    grown = samples.groupBy("tree").applyInPandas(grow, _NODES).toPandas()  # at most trees * 2 * sample_size rows
    names = {t: i for i, t in enumerate(sorted(grown["tree"].unique()))}
    shape = (len(names), int(grown["node"].max()) + 1)
    feature, low, high = (np.full(shape, -1, dtype="int32") for _ in range(3))
    cut, path = np.zeros(shape), np.zeros(shape)
    at = (grown["tree"].map(names).to_numpy(), grown["node"].to_numpy())
    feature[at], low[at], high[at], cut[at] = (grown[c].to_numpy() for c in ("feature", "low", "high", "cut"))
    path[at] = grown["depth"].to_numpy() + _average_path(grown["rows"].to_numpy())
    roots = grown[grown["node"] == 0]["rows"]
    forest = IsolationForest(
        columns, base, span, feature, cut, low, high, path,
        norm=float(max(_average_path(roots.max()), 1e-9)),
        levels=int(grown["depth"].max()),
    )
    scored = written(forest.score(kept), "forest-scores")
    forest.threshold = scored.agg(F.percentile_approx("score", 1.0 - contamination, accuracy).alias("t")).first()["t"]
    return forest, forest.flag(scored)
