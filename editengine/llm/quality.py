"""Quality of texts by a sparse ensemble of rules.

Boosted trees over statistics of the text propose conjunctions of thresholds, one for each path from a
root; a logistic regression with an L1 penalty keeps few of them. What is left, some dozens of weighted
rules, becomes a Spark column expression over the statistics.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

# The bound of the sample of labelled rows.
ROWS = 12_000
TREES, DEPTH, BINS, LEAST, RATE, SEED = 30, 3, 32, 20, 0.3, 5
PENALTIES = (0.02, 0.01, 0.005, 0.002, 0.001)
SLICE = 1_000_000
STATS = (
    "log_bytes", "log_words", "word_bytes", "lower", "upper", "digits", "marks", "symbols", "high", "lines_per_word",
    "short_words", "long_words", "distinct_words", "top_word", "repeated_lines", "line_words", "symbol_words", "capital_words",
)


def _kinds() -> np.ndarray:
    """0 other, 1 lower, 2 upper, 3 digit, 4 closing mark, 5 symbol, 6 part of a longer character, 7 white space."""
    table = np.full(256, 6, dtype=np.uint8)
    table[:128] = 5
    table[:32] = 0
    for kind, chars in ((1, range(97, 123)), (2, range(65, 91)), (3, range(48, 58)), (4, b".,;:?'\"()-"), (7, b" \t\n\x0b\x0c\r")):
        table[list(chars)] = kind
    return table


KINDS = _kinds()


def statistics(texts: list[str]) -> np.ndarray:
    """A row of ``STATS`` for each text; an empty text has zeros."""
    data, ends = common.joined([x.encode() + b"\n" for x in texts])
    kinds, starts = KINDS[data], ends[:-1]
    per = lambda flags: np.add.reduceat(flags.astype(np.int64), starts)
    count = [per(kinds == k) for k in range(8)]
    size = np.diff(ends) - 1
    space = kinds == 7
    first = ~space & np.r_[True, space[:-1]]
    at = np.flatnonzero(first)
    last = np.flatnonzero(~space & np.r_[space[1:], True])
    length = last - at + 1
    begins = np.searchsorted(at, ends)
    words = np.diff(begins)
    safe, some = np.maximum(words, 1), np.maximum(size, 1)
    per_word = lambda flags: np.diff(np.r_[0, np.cumsum(flags)][begins]) / safe
    repeated, distinct, top = np.zeros(len(texts)), np.zeros(len(texts)), np.zeros(len(texts))
    for k, text in enumerate(texts):
        own = text.split()
        if own:
            distinct[k] = len(set(own)) / len(own)
            top[k] = max(map(len, own)) / 100
        lines = [x for x in text.split("\n") if x]
        repeated[k] = 1 - len(set(lines)) / len(lines) if lines else 0
    lines = per(data == 10)
    symbol = np.r_[0, np.cumsum(kinds == 5)]
    columns = [
        np.log1p(size), np.log1p(words), (size - count[7] + 1) / safe, *(count[k] / some for k in (1, 2, 3, 4, 5, 6)), lines / safe,
        per_word(length <= 3), per_word(length >= 15), distinct, top, repeated, words / np.maximum(lines, 1),
        per_word(symbol[last + 1] > symbol[at]), per_word(kinds[at] == 2),
    ]
    return np.where(size[:, None] > 0, np.stack(columns, axis=1), 0.0)


def with_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of each whole text."""
    schema = "doc_id long, " + ", ".join(f"{x} double" for x in STATS)
    return common.by_slice(common.id_text(docs), lambda part, texts: (part.column(0), *map(pa.array, np.ascontiguousarray(statistics(texts).T))), schema, chars=SLICE)


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, above, threshold) that must all hold


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    return np.all([(x[:, f] > t) if above else (x[:, f] <= t) for f, above, t in rule], axis=0)


def grow(x: np.ndarray, y: np.ndarray, seed: int = SEED) -> list[Rule]:
    """The paths of boosted trees, each fitted to the errors that those before it leave."""
    rng = np.random.default_rng(seed)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    margin = np.full(len(y), np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    rules: dict[Rule, None] = {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        slope, weight = y - p, np.maximum(p * (1 - p), 1e-6)
        nodes = [((), rng.random(len(y)) < 0.7)]
        everywhere = np.ones(len(y), dtype=bool)
        parts = [everywhere]
        for _ in range(DEPTH):
            below, inside_all = [], []
            for (path, own), part in zip(nodes, parts, strict=True):
                best = (1e-6, None)
                for f in rng.permutation(x.shape[1])[: max(4, 2 * x.shape[1] // 3)]:
                    if not len(edges[f]):
                        continue
                    n = len(edges[f]) + 1
                    g, h, c = (np.cumsum(np.bincount(binned[own, f], weights=v[own], minlength=n))[:-1] for v in (slope, weight, np.ones(len(y))))
                    total = slope[own].sum(), weight[own].sum(), own.sum()
                    gain = g**2 / (h + 1) + (total[0] - g) ** 2 / (total[1] - h + 1) - total[0] ** 2 / (total[1] + 1)
                    gain[(c < LEAST) | (total[2] - c < LEAST)] = -1
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (gain[k], (int(f), k))
                if best[1] is None:
                    continue
                f, k = best[1]
                for above in (False, True):
                    side = (binned[:, f] > k) if above else (binned[:, f] <= k)
                    longer = path + ((f, above, float(edges[f][k])),)
                    rules[tuple(sorted(longer))] = None
                    below.append((longer, own & side))
                    inside_all.append(part & side)
            if below:
                nodes, parts = below, inside_all
        for (_, own), part in zip(nodes, parts, strict=True):
            if own.any():
                margin[part] += RATE * np.clip(slope[own].sum() / (weight[own].sum() + 1), -4, 4)
    return list(rules)


def lasso(z: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 200) -> tuple[np.ndarray, float]:
    """Logistic regression with an L1 penalty, by accelerated proximal steps."""
    n, m = z.shape
    step = 4 * n / (np.linalg.norm(z, 2) ** 2 + n)
    w = v = np.zeros(m)
    b = c = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    t = 1.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-(z @ v + c))) - y
        moved = v - step * (z.T @ error) / n
        w2, b2 = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0), c - step * error.mean()
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = w2 + (t - 1) / t2 * (w2 - w), b2 + (t - 1) / t2 * (b2 - b)
        w, b, t = w2, b2, t2
    return w, b


class Model:
    def __init__(self, bias: float, rules: list[tuple[Rule, float]]):
        self.bias, self.rules = bias, rules

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.bias)
        for rule, weight in self.rules:
            margin += weight * holds(rule, x)
        return 1 / (1 + np.exp(-margin))

    def column(self) -> Column:
        """The score as an expression over the columns ``STATS``."""
        margin = F.lit(self.bias)
        for rule, weight in self.rules:
            every = None
            for f, above, t in rule:
                one = F.col(STATS[f]) > F.lit(t) if above else F.col(STATS[f]) <= F.lit(t)
                every = one if every is None else every & one
            margin = margin + F.when(every, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def train(x: np.ndarray, y: np.ndarray, seed: int = SEED) -> Model:
    """The penalty is chosen on a quarter of the rows. Without both labels, the score is their share."""
    share = float(y.mean()) if len(y) else 0.5
    if len(y) < 8 or share in (0.0, 1.0):
        return Model(float(np.log((share * len(y) + 0.5) / ((1 - share) * len(y) + 0.5))), [])
    test = np.random.default_rng(seed).random(len(y)) < 0.25
    rules = grow(x[~test], y[~test], seed)
    if not rules:
        return Model(float(np.log(share / (1 - share))), [])
    z = np.stack([holds(r, x) for r in rules], axis=1).astype(float)
    spread = np.maximum(z[~test].std(axis=0), 1e-3)
    loss, best = np.inf, PENALTIES[0]
    for penalty in PENALTIES:
        w, b = lasso(z[~test] / spread, y[~test], penalty)
        p = np.clip(1 / (1 + np.exp(-(z[test] / spread @ w + b))), 1e-9, 1 - 1e-9)
        now = -(y[test] * np.log(p) + (1 - y[test]) * np.log(1 - p)).mean() + 1e-4 * np.count_nonzero(w) / len(w)
        if now < loss:
            loss, best = now, penalty
    w, b = lasso(z / spread, y, best)
    return Model(b, [(rules[k], float(w[k] / spread[k])) for k in np.flatnonzero(w)])


def fit(docs: DataFrame, labels: DataFrame, rows: int = ROWS, seed: int = SEED) -> Model:
    """Learn ``quality`` (0 or 1) from at most ``rows`` labelled documents, chosen by the hash of their id."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("doc_id IS NOT NULL AND quality IN (0, 1)")
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = common.id_text(docs).join(F.broadcast(known.select("doc_id")), "doc_id", "left_semi")  # at most ``rows`` ids
    found = with_statistics(texts).join(F.broadcast(known), "doc_id").dropDuplicates(["doc_id"]).orderBy("doc_id").collect()
    x = np.array([[r[s] for s in STATS] for r in found], dtype=float).reshape(-1, len(STATS))
    return train(x, np.array([r["quality"] for r in found], dtype=float), seed)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, the statistics, ``score``: one row per row of ``docs``.

    Null and empty texts have statistics of zero and the score that follows. Repeated rows and rows
    without an id are scored like any other.
    """
    return with_statistics(docs).withColumn("score", model.column())
