"""Nearest neighbours by a robust-pruned directed graph in each shard.

A point's neighbours are proposed by a greedy search of the graph so far and thinned by a relaxed
distance rule: a candidate goes if a kept neighbour is nearer to it, by the factor ``ALPHA``, than the
point is. What stays points in many directions, so that a beam search from a few entries reaches any
region. Points enter in batches that are searched together in numpy. Shards are dealt by hash and have
a fixed size; each is searched for each block of queries.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

K, DEGREE, BEAM, ALPHA, ENTRIES, SEED = 10, 32, 80, 1.2, 16, 3
SHARD_ROWS, BLOCK, BATCH, WIDE = 5000, 512, 256, 4
FINITE = "embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(embedding, x -> x != 0)"


class Graph:
    """``points`` in single precision, ``edges`` with -1 where a point has fewer than ``DEGREE``."""

    def __init__(self, points: np.ndarray, edges: np.ndarray, entries: np.ndarray):
        self.points, self.edges, self.entries = points, edges, entries

    @classmethod
    def build(cls, points: np.ndarray, seed: int = SEED) -> Graph:
        n, rng = len(points), np.random.default_rng(seed)
        graph = cls(points, np.full((n, DEGREE), -1, dtype=np.int32), np.zeros(1, dtype=np.int64))
        order = rng.permutation(n)
        middle = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
        order = np.r_[middle, order[order != middle]]
        graph.entries, at = order[:1], 1
        while at < n:
            own = order[at : at + min(BATCH, at)]
            graph.entries = order[: min(ENTRIES, at)]
            found, far = graph.search(points[own], BEAM)
            graph.edges[own] = graph.prune(own, found, far)
            graph._turn(own)
            at += len(own)
        graph.entries = order[: min(ENTRIES, n)]
        return graph

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest points met on the way, nearest first (-1 where there are fewer), and squared distances."""
        b, n, lanes = len(queries), len(self.points), np.arange(len(queries))[:, None]
        seen = np.zeros((b, n + 1), dtype=bool)
        seen[:, n] = True  # stands for no point
        ids = np.tile(self.entries.astype(np.int64), (b, 1))
        seen[:, self.entries] = True
        far, done = self._far(queries, ids), np.zeros(ids.shape, dtype=bool)
        while True:
            open_far = np.where(done | (ids >= n), np.inf, far)
            width = min(WIDE, ids.shape[1])
            take = np.argpartition(open_far, width - 1, axis=1)[:, :width]
            live = np.isfinite(np.take_along_axis(open_far, take, axis=1))
            if not live.any():
                break
            done[lanes, take] |= live
            base = np.where(live, ids[lanes, take], n)
            near = self._edges(base).reshape(b, -1).astype(np.int64)
            near[near < 0] = n
            near.sort(axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = n
            near[seen[lanes, near]] = n
            seen[lanes, near] = True
            used = near < n
            near = np.take_along_axis(near, np.argsort(~used, axis=1, kind="stable"), axis=1)[:, : max(1, int(used.sum(axis=1).max()))]
            ids = np.concatenate([ids, near], axis=1)
            far = np.concatenate([far, self._far(queries, near)], axis=1)
            done = np.concatenate([done, near >= n], axis=1)
            if ids.shape[1] > beam:
                keep = np.argpartition(far, beam - 1, axis=1)[:, :beam]
                ids, far, done = (np.take_along_axis(x, keep, axis=1) for x in (ids, far, done))
        order = np.argsort(far, axis=1, kind="stable")
        ids, far = np.take_along_axis(ids, order, axis=1), np.take_along_axis(far, order, axis=1)
        return np.where(ids < n, ids, -1), far

    def _edges(self, base: np.ndarray) -> np.ndarray:
        out = self.edges[np.minimum(base, len(self.edges) - 1)]
        out[base >= len(self.edges)] = -1
        return out

    def _far(self, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
        own = self.points[np.minimum(ids, len(self.points) - 1)]
        d = own - queries[:, None, :]
        far = np.einsum("bij,bij->bi", d, d)
        far[ids >= len(self.points)] = np.inf
        return far

    def prune(self, own: np.ndarray, ids: np.ndarray, far: np.ndarray) -> np.ndarray:
        """At most ``DEGREE`` of each point's candidates, by the relaxed distance rule."""
        left = (ids >= 0) & (ids != own[:, None])
        vectors = self.points[np.maximum(ids, 0)]
        norms = (vectors**2).sum(axis=2)
        between = norms[:, :, None] + norms[:, None, :] - 2 * vectors @ vectors.transpose(0, 2, 1)
        out, lane = np.full((len(own), DEGREE), -1, dtype=np.int32), np.arange(len(own))
        for k in range(DEGREE):
            now = np.where(left, far, np.inf)
            best = now.argmin(axis=1)
            some = np.isfinite(now[lane, best])
            if not some.any():
                break
            out[some, k] = ids[lane, best][some]
            left &= ~(ALPHA**2 * between[lane, best] <= far)
            left[lane, best] = False
        return out

    def _turn(self, own: np.ndarray) -> None:
        """Edges back to the new points; who has too many then is pruned."""
        to, back = self.edges[own].ravel(), np.repeat(own, DEGREE)
        to, back = to[to >= 0], back[to >= 0]
        order = np.argsort(to, kind="stable")
        to, back = to[order].astype(np.int64), back[order]
        who, start, number = np.unique(to, return_index=True, return_counts=True)
        degree = (self.edges[who] >= 0).sum(axis=1)
        rank = np.arange(len(to)) - np.repeat(start, number)
        fits = np.repeat(degree + number <= DEGREE, number)
        self.edges[to[fits], (np.repeat(degree, number) + rank)[fits]] = back[fits]
        full = np.flatnonzero(degree + number > DEGREE)
        for at in range(0, len(full), BATCH):
            part = full[at : at + BATCH]
            width = int(number[part].max())
            more = np.full((len(part), width), -1, dtype=np.int64)
            for j, k in enumerate(part):
                more[j, : number[k]] = back[start[k] : start[k] + number[k]]
            ids = np.concatenate([self.edges[who[part]], more], axis=1)
            far = self._far(self.points[who[part]], np.where(ids < 0, len(self.points), ids))
            self.edges[who[part]] = self.prune(who[part], ids, far)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


INDEX = "dim int, shard int, points binary, rows binary, ids binary, edges binary, entries binary"


def index(vectors: DataFrame, shard_rows: int = SHARD_ROWS, k: int = K) -> DataFrame:
    """One row per shard with its graph, over every usable row of ``vectors`` (``vec_id``, ``embedding``).

    Rows that are equal in both columns count once. Equal vectors in a shard are one point with the
    ``k + 1`` smallest ids, all that a search for ``k`` can return.
    """
    n = vectors.count()
    shards = max(1, -(-n // shard_rows))
    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(shards)).cast("int"))

    def build(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        exact = _matrix(rows["embedding"]).astype(np.float64)
        ids = rows["vec_id"].to_numpy()
        points, place = np.unique(exact, axis=0, return_inverse=True)
        order = np.lexsort((ids, place.ravel()))
        place, ids = place.ravel()[order], ids[order]
        rank = np.arange(len(ids)) - np.searchsorted(place, place)
        held = rank <= k
        graph = Graph.build(points.astype(np.float32))
        data = points.tobytes(), place[held].astype(np.int64).tobytes(), ids[held].astype(np.int64).tobytes(), graph.edges.tobytes(), graph.entries.astype(np.int64).tobytes()
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()), *(pa.array([x], pa.binary()) for x in data)], names=["dim", "shard", "points", "rows", "ids", "edges", "entries"])

    return dealt.groupBy("dim", "shard").applyInArrow(build, INDEX)


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``embedding`` (doubles), ``dim`` of distinct rows with an id and a finite vector that is not zero."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where("vec_id IS NOT NULL").where(FINITE)
    return rows.distinct().withColumn("dim", F.size("embedding"))


def search(vectors: DataFrame, queries: DataFrame, k: int = K, beam: int = BEAM) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: each query's ``k`` nearest found, by Euclidean distance.

    A query's own id is no candidate. Rows that are no vectors (null, zero, with null or non-finite
    components) take no part; vectors of different lengths do not meet. Ties go to the smaller id.
    An empty table gives no row.
    """
    vectors = common.cut(usable(vectors), "vectors")
    made = common.cut(index(vectors, k=k), "graphs")
    asked = usable(queries).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, -(-queries.count() // BLOCK)))))

    def pack(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        data = _matrix(rows["embedding"]).tobytes(), rows["vec_id"].to_numpy().astype(np.int64).tobytes()
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int64()), *(pa.array([x], pa.binary()) for x in data)], names=["dim", "block", "asked", "asked_ids"])

    blocks = asked.groupBy("dim", "block").applyInArrow(pack, "dim int, block long, asked binary, asked_ids binary")
    # The stated queries, in blocks, against every shard.
    pairs = made.join(blocks, "dim")

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                points = np.frombuffer(r["points"]).reshape(-1, r["dim"])
                place, ids = np.frombuffer(r["rows"], np.int64), np.frombuffer(r["ids"], np.int64)
                graph = Graph(points.astype(np.float32), np.frombuffer(r["edges"], np.int32).reshape(-1, DEGREE), np.frombuffer(r["entries"], np.int64))
                asked, own = np.frombuffer(r["asked"]).reshape(-1, r["dim"]), np.frombuffer(r["asked_ids"], np.int64)
                lo = np.searchsorted(place, np.arange(len(points) + 1))
                for at in range(0, len(own), BATCH):
                    q, names = asked[at : at + BATCH], own[at : at + BATCH]
                    found, _ = graph.search(q.astype(np.float32), beam)
                    near = np.sqrt(((points[np.maximum(found, 0)] - q[:, None, :]) ** 2).sum(axis=2))
                    near[found < 0] = np.inf
                    out = []
                    for j in range(len(q)):
                        order = np.argsort(near[j], kind="stable")
                        order = order[np.isfinite(near[j][order])]
                        # As many points as can hold the first k ids, and all at the last one's distance.
                        last = near[j][order[min(len(order), k + 1) - 1]] if len(order) else 0
                        order = order[near[j][order] <= last]
                        p = found[j][order]
                        number = lo[p + 1] - lo[p]
                        rows = np.repeat(lo[p] - (np.cumsum(number) - number), number) + np.arange(number.sum())
                        far, vec = np.repeat(near[j][order], number), ids[rows]
                        far, vec = far[vec != names[j]], vec[vec != names[j]]
                        first = np.lexsort((vec, far))[:k]
                        out.append((np.full(len(first), names[j]), vec[first], far[first]))
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=["query_id", "vec_id", "score"])

    near = pairs.mapInArrow(run, "query_id long, vec_id long, score double")
    near = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
