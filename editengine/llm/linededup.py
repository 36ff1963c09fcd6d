"""Line de-duplication that can be undone: sharded cuckoo filters over exact reference counts.

A store holds which documents contain which lines, as (shard, key, doc_id) rows in Parquet, the counts
they add up to, and for each shard a cuckoo filter of the keys that are frequent enough to be dropped.
Documents may be added and taken away again at any time; a key enters its shard's filter when its
count reaches the threshold and leaves it when the count falls below, which a Bloom filter could not
do. A line is looked up in the exact table only if the filter knows it.

A line's key is the SHA-256 of the line, stripped and lower-cased (ASCII).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

MIN_CHARS, MIN_DOCS = 40, 5
SPACE = b" \t\n\x0b\x0c\r"
SLOTS, KICKS = 4, 500
# Filters are sent to the tasks in passes of this size; keys of a shard; shards at least.
FILTER_BYTES, SHARD_KEYS, SHARDS = 64 << 20, 1 << 20, 64


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """SHA-256 of the key of an already lower-cased line; None if the key is too short to count."""
    key = line.strip(SPACE)
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return hashlib.sha256(key).digest()


class Cuckoo:
    """A cuckoo filter of SHA-256 keys: 16-bit tags, two buckets of four slots for each key.

    ``insert`` must not be called twice for one key, nor ``delete`` for a key that is not in.
    """

    def __init__(self, slots: np.ndarray):
        self.slots, self.mask = slots, len(slots) - 1

    @classmethod
    def sized(cls, keys: int) -> Cuckoo:
        return cls(np.zeros((1 << max(4, int(np.ceil(np.log2(max(1, keys) / (SLOTS * 0.8))))), SLOTS), dtype=np.uint16))

    @classmethod
    def of(cls, keys: list[bytes]) -> Cuckoo:
        made = cls.sized(len(keys))
        while not made.insert_many(keys):
            made = cls(np.zeros((2 * len(made.slots), SLOTS), dtype=np.uint16))
        return made

    def _places(self, tags: np.ndarray, first: np.ndarray) -> np.ndarray:
        return first ^ ((tags.astype(np.uint64) * np.uint64(0x5BD1E995)) & np.uint64(self.mask))

    def _spots(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        words = np.frombuffer(b"".join(k[:16] for k in keys), dtype="<u8").reshape(-1, 2)
        tags = np.maximum(words[:, 1] & np.uint64(0xFFFF), 1).astype(np.uint16)
        first = words[:, 0] & np.uint64(self.mask)
        return tags, first, self._places(tags, first)

    def contains(self, keys: list[bytes]) -> np.ndarray:
        if not keys:
            return np.zeros(0, dtype=bool)
        tags, one, two = self._spots(keys)
        return (self.slots[one] == tags[:, None]).any(1) | (self.slots[two] == tags[:, None]).any(1)

    def insert_many(self, keys: list[bytes]) -> bool:
        """As ``insert`` of each; most keys find a free slot in one of their buckets at once."""
        if not keys:
            return True
        tags, one, two = self._spots(keys)
        rest = np.arange(len(keys))
        for place in (one, two):
            rest = rest[np.argsort(place[rest], kind="stable")]
            at = place[rest].astype(np.int64)
            nth = np.arange(len(at)) - np.searchsorted(at, at)  # among the keys of its bucket
            free = np.argsort(self.slots[at] != 0, axis=1, kind="stable")  # free slots first
            fits = nth < (self.slots[at] == 0).sum(axis=1)
            self.slots[at[fits], free[fits, nth[fits]]] = tags[rest[fits]]
            rest = rest[~fits]
        return all([self.insert(keys[k]) for k in rest.tolist()])

    def insert(self, key: bytes) -> bool:
        """False if no place was found; the filter must then be made anew."""
        tags, one, two = self._spots([key])
        tag, at = tags[0], int(one[0])
        for spot in (at, int(two[0])):
            if not self.slots[spot].all():
                self.slots[spot, int(np.argmin(self.slots[spot]))] = tag
                return True
        for turn in range(KICKS):
            slot = turn % SLOTS
            tag, self.slots[at, slot] = self.slots[at, slot], tag
            at = int(self._places(np.array([tag]), np.array([at], dtype=np.uint64))[0])
            if not self.slots[at].all():
                self.slots[at, int(np.argmin(self.slots[at]))] = tag
                return True
        return False

    def delete(self, key: bytes) -> None:
        tags, one, two = self._spots([key])
        for spot in (int(one[0]), int(two[0])):
            hit = np.flatnonzero(self.slots[spot] == tags[0])
            if len(hit):
                self.slots[spot, hit[0]] = 0
                return
        raise KeyError("not in the filter")

    def to_bytes(self) -> bytes:
        return self.slots.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> Cuckoo:
        return cls(np.frombuffer(data, dtype=np.uint16).reshape(-1, SLOTS).copy())


class LineStore:
    """The lines of a corpus that grows and shrinks; every change makes a new version of the counts.

    Rows without an id take no part: their lines are not counted and all stay. An id that comes in
    several rows is one document. Keys shorter than ``min_chars`` code points are never dropped.
    """

    def __init__(self, spark: SparkSession, path: str, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, shards: int | None = None):
        self.spark, self.path, self.version = spark, path, 0
        # The number of shards follows that of the keys, unless it is given.
        self.min_chars, self.min_docs, self.shards, self.fixed = min_chars, min_docs, shards or SHARDS, shards is not None
        self.written: list[tuple[int, str]] = []

    def _at(self, what: str, version: int | None = None) -> str:
        return f"{self.path}/{what}-{self.version if version is None else version}"

    def _references(self, docs: DataFrame) -> DataFrame:
        least = self.min_chars

        def find(part, texts):
            keys, ids = [], []
            for doc_id, text in zip(part.column(0).to_pylist(), texts, strict=True):
                own = {line_key(line, least) for line in text.encode().lower().split(b"\n") if len(line) >= least} - {None}
                keys += own
                ids += [doc_id] * len(own)
            return keys, ids

        found = common.by_slice(common.id_text(docs).where("doc_id IS NOT NULL"), find, "key binary, doc_id long")
        return found.distinct()

    def references(self) -> DataFrame | None:
        """``key``, ``doc_id`` of all documents now in the store."""
        live = None
        for version, kind in self.written:
            rows = self.spark.read.parquet(self._at(kind, version))
            if kind == "in":
                live = rows if live is None else live.unionByName(rows).distinct()
            elif live is not None:
                live = live.join(rows, "doc_id", "left_anti")
        return live

    def insert(self, docs: DataFrame) -> None:
        """Add documents; one that is already there must hold the same lines."""
        self.version += 1
        self._references(docs).write.parquet(self._at("in"))
        rows = self.spark.read.parquet(self._at("in"))
        known = self.references()
        if known is not None:
            rows = rows.join(known, ["key", "doc_id"], "left_anti")
        self.written.append((self.version, "in"))
        self._count(rows.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("max_doc")), known is not None)

    def delete(self, doc_ids: DataFrame) -> None:
        """Take documents away by ``doc_id``; what only they had made droppable stays from now on."""
        self.version += 1
        doc_ids.select(F.col("doc_id").cast("long")).where("doc_id IS NOT NULL").distinct().write.parquet(self._at("out"))
        gone = self.spark.read.parquet(self._at("out"))
        before = self.references()
        self.written.append((self.version, "out"))
        if before is None:
            return
        touched = before.join(gone, "doc_id", "left_semi").select("key").distinct()
        left = self.references().join(touched, "key", "left_semi").groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("max_doc"))
        kept = self.counts(self.version - 1).join(touched, "key", "left_anti")
        kept.unionByName(left).write.parquet(self._at("counts"))
        self._refilter()

    def counts(self, version: int | None = None) -> DataFrame:
        """The exact table: ``key``, ``n_docs``, ``max_doc``."""
        return self.spark.read.parquet(self._at("counts", version))

    def _count(self, added: DataFrame, further: bool) -> None:
        if further:
            added = self.counts(self.version - 1).unionByName(added).groupBy("key").agg(F.sum("n_docs").alias("n_docs"), F.max("max_doc").alias("max_doc"))
        added.write.parquet(self._at("counts"))
        self._refilter()

    def _frequent(self, version: int) -> DataFrame:
        return self.counts(version).where(F.col("n_docs") >= self.min_docs)

    def _shard(self):
        return F.pmod(F.hash("key"), F.lit(self.shards)).alias("shard")

    def _refilter(self) -> None:
        """Bring the filters to this version: only keys that crossed the threshold are put in or taken out."""
        now = self._frequent(self.version).select("key", F.lit(1).alias("now"))
        anew = self.version == 1
        if not self.fixed and (wanted := -(-now.count() // SHARD_KEYS)) > self.shards:
            self.shards, anew = 2 * wanted, True
        if anew:
            change = now.select(self._shard(), "key", F.lit(True).alias("put"))
            old = self.spark.createDataFrame([], "shard int, filter binary")
        else:
            was = self._frequent(self.version - 1).select("key", F.lit(1).alias("was"))
            change = now.join(was, "key", "full_outer").where("now IS NULL OR was IS NULL").select(self._shard(), "key", F.col("now").isNotNull().alias("put"))
            old = self.spark.read.parquet(self._at("filters", self.version - 1))
        everything = now.select(self._shard(), "key")

        def update(key, changes: pa.Table, filters: pa.Table) -> pa.Table:
            shard = key[0].as_py()
            keys, put = changes["key"].to_pylist(), changes["put"].to_pylist()
            data = filters["filter"].to_pylist()
            if data:
                held = Cuckoo.from_bytes(data[0])
                for k in (k for k, p in zip(keys, put, strict=True) if not p):
                    held.delete(k)
                full = not held.insert_many([k for k, p in zip(keys, put, strict=True) if p])
            else:
                held, full = Cuckoo.of(keys), False
            return pa.table({"shard": pa.array([shard], pa.int32()), "filter": pa.array([held.to_bytes()], pa.binary()), "full": [full]})

        made = change.groupBy("shard").cogroup(old.groupBy("shard")).applyInArrow(update, "shard int, filter binary, full boolean")
        made = common.cut(made, "filters")
        fit = made.where("NOT full").select("shard", "filter")
        grown = everything.join(made.where("full").select("shard"), "shard").groupBy("shard").applyInArrow(
            lambda rows: pa.table({"shard": pa.array(rows["shard"].to_pylist()[:1], pa.int32()), "filter": pa.array([Cuckoo.of(rows["key"].to_pylist()).to_bytes()], pa.binary())}),
            "shard int, filter binary",
        )
        fit.unionByName(grown).write.parquet(self._at("filters"))

    def filters(self) -> DataFrame:
        return self.spark.read.parquet(self._at("filters"))

    def screen(self, rows: DataFrame) -> DataFrame:
        """The (``key``, ``doc_id``) rows whose key a filter knows. Filters go to the tasks in passes of bounded size."""
        sizes = self.filters().select("shard", F.octet_length("filter").alias("size")).collect()  # a number for each shard
        passes: list[list[int]] = []
        room = 0
        for shard, size in sorted(tuple(r) for r in sizes):
            if size > room:
                passes.append([])
                room = FILTER_BYTES
            passes[-1].append(shard)
            room -= size
        rows, out = rows.select(self._shard(), "key", "doc_id"), rows.limit(0).select("key", "doc_id")
        for own in passes:
            part = rows if len(passes) == 1 else rows.where(F.col("shard").isin(own))
            out = out.union(self._known(part, {r["shard"]: r["filter"] for r in self.filters().where(F.col("shard").isin(own)).collect()}))
        return out

    def _known(self, rows: DataFrame, filters: dict[int, bytes]) -> DataFrame:
        held = self.spark.sparkContext.broadcast(filters)

        def known(batches: Iterator[pa.RecordBatch]):
            filters = {k: Cuckoo.from_bytes(v) for k, v in held.value.items()}
            for batch in batches:
                shard, keys = batch.column("shard").to_numpy(), batch.column("key").to_pylist()
                hit = np.zeros(len(keys), dtype=bool)
                for k in np.unique(shard):
                    at = np.flatnonzero(shard == k)
                    if int(k) in filters:
                        hit[at] = filters[int(k)].contains([keys[i] for i in at])
                yield batch.filter(pa.array(hit)).select(["key", "doc_id"])

        return rows.mapInArrow(known, "key binary, doc_id long")

    def apply(self, docs: DataFrame) -> DataFrame:
        """Drop lines that the store counts in ``min_docs`` documents, except in the largest ``doc_id`` with them.

        The columns of ``docs`` with the new ``text``, then ``n_lines`` (before) and ``n_dropped``. The
        documents' lines must be in the store. A null or empty text is one empty line and stays what it
        is. Columns of these two names in ``docs`` are replaced.
        """
        least = self.min_chars
        refs = self.references()
        docs = docs.drop("n_lines", "n_dropped")
        lost = self.screen(refs).join(self._frequent(self.version), "key").where("doc_id < max_doc")
        lost = lost.groupBy(F.col("doc_id").alias("lost_doc")).agg(F.collect_list("key").alias("lost_keys"))  # of one document
        names = list(docs.columns)
        at = names.index("text")
        inner = docs.toDF(*(f"c{k}" for k in range(len(names))))
        both = inner.join(lost, inner[f"c{names.index('doc_id')}"].cast("long") == lost["lost_doc"], "left").drop("lost_doc")
        out = both.drop("lost_keys").schema.add("n_lines", "long").add("n_dropped", "long")
        target = common.arrow_schema(out)

        def drop(batches):
            for part, texts in common.slices(batches, f"c{at}"):
                kept, lines_of, dropped = [], [], []
                for text, keys in zip(texts, part.column("lost_keys").to_pylist(), strict=True):
                    lines_of.append((text or "").count("\n") + 1)
                    gone = 0
                    if keys:
                        keys, lines = set(keys), text.split("\n")
                        stay = [x for x in lines if line_key(x.encode().lower(), least) not in keys]
                        text, gone = "\n".join(stay), len(lines) - len(stay)
                    kept.append(text)
                    dropped.append(gone)
                columns = [pa.array(kept, target.field(k).type) if k == at else part.column(k) for k in range(len(names))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(lines_of, pa.int64()), pa.array(dropped, pa.int64())], schema=target)

        return both.mapInArrow(drop, out).toDF(*names, "n_lines", "n_dropped")
