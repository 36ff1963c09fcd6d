"""Whitening of embeddings from a covariance by polarisation.

Entries become integers. Two kinds of exact sums are taken over all vectors: the squares of every dimension's
values, and the squares of the sums of every two dimensions; 2ab = (a + b)^2 - a^2 - b^2 turns the second kind into
all cross-covariances. Values are centred on the whole number nearest to their mean, which keeps squares small;
what the centre is off by is put right exactly on whole numbers at the end.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
# Vectors handled at a time; entries from here on count as not finite.
AT_ONCE, BEYOND = 1024, 2.0**30


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``v``: rows with a vector without null, non-finite or huge entries."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda c: F.coalesce(F.abs(c) < BEYOND, F.lit(False)))  # not so for NaN either
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(fine & (F.size("v") > 0))


def _whole(batches):
    """(rows, whole-number entries) of at most ``AT_ONCE`` vectors of one length."""
    for batch in batches:
        for start in range(0, batch.num_rows, AT_ONCE):
            part = batch.slice(start, AT_ONCE)
            sizes = np.diff(part.column(1).offsets.to_numpy())
            for d in np.unique(sizes).tolist():
                own = part if (sizes == d).all() else part.filter(pa.array(sizes == d))
                yield own, np.floor(own.column(1).flatten().to_numpy().reshape(-1, d) * SCALE).astype(np.int64) + SHIFT


def _summed(rows: DataFrame, of, label: str) -> dict[int, dict]:
    """{vector length: {key: exact sum}}; ``of(length, entries)`` gives whole numbers for the keys of a part."""

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for _, x in _whole(batches):
            own = of(x.shape[1], x)
            sums[x.shape[1]] = sums.get(x.shape[1], 0) + own
        for d, values in sums.items():
            total = [Decimal(int(v)) for v in values]
            yield pa.RecordBatch.from_arrays([pa.array([d] * len(total), pa.int64()), pa.array(range(len(total)), pa.int64()), pa.array(total, pa.decimal128(38, 0))], names=["d", "key", "total"])

    found = rows.mapInArrow(run, "d long, key long, total decimal(38,0)").groupBy("d", "key").agg(F.sum("total").alias("total"))
    out: dict[int, dict] = {}
    for r in common.cut(found, label).collect():  # a number for each pair of dimensions
        out.setdefault(r["d"], {})[r["key"]] = int(r["total"])
    return out


def _first(d: int, x: np.ndarray) -> np.ndarray:
    return np.r_[len(x), x.sum(axis=0)].astype(object)


def squares(z: np.ndarray) -> np.ndarray:
    """Exact sums of the squares of every dimension and of every sum of two, in the order of ``triangle``."""
    n, d = z.shape
    most = 2 * int(np.abs(z).max(initial=0))
    rows = max(1, min(n, 2**62 // max(1, most * most)))
    out = np.zeros(d * (d + 1) // 2, dtype=object)
    for start in range(0, n, rows):
        part = z[start : start + rows]
        part = part.astype(object) if most >= 2**31 else part
        found = [(part**2).sum(axis=0)]
        found += [((part[:, i : i + 1] + part[:, i + 1 :]) ** 2).sum(axis=0) for i in range(d - 1)]
        out = out + np.concatenate(found).astype(object)
    return out


def triangle(d: int) -> tuple[np.ndarray, np.ndarray]:
    """The dimensions that ``squares`` adds: each one alone, then all pairs."""
    i, j = np.triu_indices(d, 1)
    return np.r_[np.arange(d), i], np.r_[np.arange(d), j]


class Fit:
    """Mean, covariance and components of the vectors of one length."""

    def __init__(self, d: int, n: int, sums: list[int], squared: list[int], centre: np.ndarray):
        self.n, self.centre = n, centre
        self.rest = [s - n * int(m) for s, m in zip(sums, centre, strict=True)]  # n times what the centre is off by
        power = [0] * d  # n^2 times the variances
        both = np.zeros((d, d))
        for i, j, q in zip(*(x.tolist() for x in triangle(d)), squared, strict=True):
            if i == j:
                power[i] = n * q - self.rest[i] ** 2
                both[i, i] = power[i] / n**2
            else:  # all variances came first
                twice = n * q - (self.rest[i] + self.rest[j]) ** 2 - power[i] - power[j]
                both[i, j] = both[j, i] = twice / (2 * n**2)
        self.covariance = both
        values, vectors = np.linalg.eigh(both)
        order = np.argsort(-values, kind="stable")[:COMPONENTS]
        self.trace = sum(power) / n**2
        self.values, vectors = values[order], vectors[:, order]
        top = np.abs(vectors).argmax(axis=0)
        self.vectors = vectors * np.sign(vectors[top, np.arange(len(order))])
        self.real = self.values > max(self.trace, 0) * 1e-13
        self.explained = np.maximum(self.values, 0) / self.trace if self.trace else np.zeros(len(order))

    def whitened(self, z: np.ndarray) -> np.ndarray:
        off = np.array([r / self.n for r in self.rest])
        return ((z - off) @ self.vectors) / np.sqrt(np.where(self.real, self.values, np.nan))

    def deviations(self, z: np.ndarray) -> list[int | None]:
        """Exact sums of (n * x - S)^2; None beyond a long."""
        most = self.n * int(np.abs(z).max(initial=0)) + max(map(abs, self.rest))
        if most * most * z.shape[1] < 2**63:
            return ((self.n * z - np.array(self.rest, dtype=np.int64)) ** 2).sum(axis=1).tolist()
        found = ((self.n * z.astype(object) - np.array(self.rest, dtype=object)) ** 2).sum(axis=1)
        return [x if x < 2**63 else None for x in found.tolist()]


def fit(rows: DataFrame) -> dict[int, Fit]:
    """Of usable rows, by vector length."""
    sums = _summed(rows, _first, "sums")
    centres = {d: np.array([(2 * s[k + 1] + s[0]) // (2 * s[0]) for k in range(d)], dtype=np.int64) for d, s in sums.items()}
    squared = _summed(rows, lambda d, x: squares(x - centres[d]), "squares")
    return {d: Fit(d, s[0], [s[k + 1] for k in range(d)], [squared[d][k] for k in range(len(squared[d]))], centres[d]) for d, s in sums.items()}


def _identity_errors(wide: DataFrame, fits: dict[int, Fit]) -> dict[int, float | None]:
    """By vector length how far the covariance of the whitened values is off the identity, over components with
    a variance; centred before multiplying, in tasks."""
    means: dict[int, np.ndarray] = {}
    placed = wide.select("d", F.posexplode("w").alias("k", "value"))
    for r in placed.groupBy("d", "k").agg(F.avg("value").alias("mean")).collect():  # eight for each length
        means.setdefault(r["d"], np.zeros(len(fits[r["d"]].values)))[r["k"]] = r["mean"] or 0.0

    def run(batches):
        for batch in batches:
            sizes = batch.column(0).to_numpy()
            for d in np.unique(sizes).tolist():
                own = batch.column(1).filter(pa.array(sizes == d)).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(means[d]))
                total = ((own - means[d]).T @ (own - means[d])).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(total), d)), pa.array(np.arange(len(total))), pa.array(total)], names=["d", "key", "total"])

    sums = wide.select("d", "w").mapInArrow(run, "d long, key long, total double").groupBy("d", "key").agg(F.sum("total").alias("total"))
    out: dict[int, float | None] = {d: None for d in fits}
    by: dict[int, dict] = {}
    for r in sums.collect():
        by.setdefault(r["d"], {})[r["key"]] = r["total"]
    for d, found in by.items():
        real = fits[d].real
        size = len(real)
        got = np.array([found[k] for k in range(size * size)]).reshape(size, size)[np.ix_(real, real)] / fits[d].n
        out[d] = float(np.abs(got - np.eye(len(got))).max()) if len(got) else None
    return out


def whiten(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    Rows with a null or empty vector, or one with a null, non-finite or huge entry (2^30 and more), are left out.
    Vectors of each length are fitted by themselves. Rows that repeat an id, or have none, are each listed. Of equal
    eigenvalues the order is the solver's, the same for all rows. A component without variance has null ``whitened``
    and does not count for ``identity_error``, which is null if there is no other. ``deviation`` is null beyond
    a long. An empty table gives no row.
    """
    rows = usable(vectors)
    fits = fit(rows)
    sent = rows.sparkSession.sparkContext.broadcast(fits)

    def run(batches):
        for own, x in _whole(batches):
            fitted = sent.value[x.shape[1]]
            z = x - fitted.centre
            w = fitted.whitened(z)
            ends = np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]
            values = pa.array(w.ravel())  # NaN where a component has no variance
            yield pa.RecordBatch.from_arrays(
                [own.column(0), pa.array(np.full(len(w), x.shape[1])), pa.array(fitted.deviations(z), pa.int64()), pa.ListArray.from_arrays(ends, values)],
                names=["vec_id", "d", "deviation", "w"])

    wide = common.cut(rows.mapInArrow(run, "vec_id long, d long, deviation long, w array<double>"), "whitened")
    errors = _identity_errors(wide, fits)
    figures = [(d, k, f.n, float(f.explained[k]), errors[d]) for d, f in fits.items() for k in range(len(f.values))]
    table = rows.sparkSession.createDataFrame(figures, "d long, k int, n long, explained double, identity_error double")
    out = wide.select("vec_id", "d", "deviation", F.posexplode("w").alias("k", "value")).join(F.broadcast(table), ["d", "k"])  # eight rows for each length
    return out.select("vec_id", (F.col("k") + 1).alias("component"), "n", "deviation", F.nanvl("value", F.lit(None).cast("double")).alias("whitened"), "explained", "identity_error")
