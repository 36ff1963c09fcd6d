"""Token ids on disk as compressed byte or bit planes.

A store is a folder of Parquet files. A row is a segment of whole documents: their ids, cut into blocks
of a fixed size, each block turned into planes (byte k, or bit k, of every id), each plane compressed
on its own. High planes are nearly constant and shrink to a few bytes. The index of a segment (its
documents, their lengths, the ids of each block) stands in columns beside it and is read without the
planes. ``file`` and ``segment`` count up with the document ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .tokens import END_ID, shared_encoder

TOKENIZER = "word_bpe_49k.json"
BLOCK_IDS, SEGMENT_IDS, LEVEL = 16_384, 65_536, 3
STORE = "file int, segment int, doc_ids array<long>, lengths array<long>, block_ids array<int>, planes array<array<binary>>, unit string, n_ids long"


def to_planes(ids: np.ndarray, unit: str) -> list[bytes]:
    """The planes of a block of 32-bit ids, lowest first."""
    octets = np.ascontiguousarray(ids.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4).T)
    if unit == "byte":
        return [x.tobytes() for x in octets]
    return [np.packbits((row >> k) & 1).tobytes() for row in octets for k in range(8)]


def from_planes(planes: list[bytes], n: int, unit: str) -> np.ndarray:
    if unit == "byte":
        octets = np.stack([np.frombuffer(x, dtype=np.uint8) for x in planes])
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(x, dtype=np.uint8), count=n) for x in planes]).reshape(4, 8, n)
        octets = np.zeros((4, n), dtype=np.uint8)
        for k in range(8):
            octets |= bits[:, k] << k
    return np.ascontiguousarray(octets.T).view("<u4").reshape(-1)


def write(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, unit: str = "byte", end_id: int = END_ID) -> None:
    """Encode every text, null ones as empty, and write the ids in ascending ``doc_id`` order.

    Rows of one id are dealt out by their text too, so an id that repeats is split over tasks. Rows
    without an id come first.
    """
    if unit not in ("byte", "bit"):
        raise ValueError(f"unit is byte or bit, not {unit}")
    end = end_id.to_bytes(4, "little")

    def run(batches):
        from pyspark import TaskContext

        encoder, file, segment = shared_encoder(tokenizer), TaskContext.get().partitionId(), 0
        pack = zstandard.ZstdCompressor(level=LEVEL)
        doc_ids, held, size = [], [], 0

        def row():
            ids = np.frombuffer(b"".join(held), dtype="<u4")
            blocks = [ids[at : at + BLOCK_IDS] for at in range(0, len(ids), BLOCK_IDS)]
            planes = [[pack.compress(x) for x in to_planes(b, unit)] for b in blocks]
            values = file, segment, doc_ids, [len(x) // 4 for x in held], [len(b) for b in blocks], planes, unit, len(ids)
            return pa.RecordBatch.from_arrays([pa.array([v], type=t) for v, t in zip(values, kinds, strict=True)], names=names)

        for part, texts in common.slices(batches):
            for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encode(texts), strict=True):
                doc_ids.append(doc_id)
                held.append(ids + end)
                size += len(ids) // 4 + 1
                if size >= SEGMENT_IDS:
                    yield row()
                    doc_ids, held, size, segment = [], [], 0, segment + 1
        if held:
            yield row()

    long_list, int_list = pa.list_(pa.int64()), pa.list_(pa.int32())
    kinds = (pa.int32(), pa.int32(), long_list, long_list, int_list, pa.list_(pa.list_(pa.binary())), pa.string(), pa.int64())
    names = ["file", "segment", "doc_ids", "lengths", "block_ids", "planes", "unit", "n_ids"]
    rows = common.id_text(docs).repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id")
    rows.mapInArrow(run, STORE).write.option("compression", "uncompressed").parquet(path)


def _ids_of(planes: list[list[bytes]], block_ids: list[int], unit: str) -> np.ndarray:
    unpack = zstandard.ZstdDecompressor()
    return np.concatenate([from_planes([unpack.decompress(x) for x in block], n, unit) for block, n in zip(planes, block_ids, strict=True)])


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (ids before the document in the whole store), ``n_tokens``, ``ids``, ``ids_crc32``."""
    stored = spark.read.schema(STORE).parquet(path)
    sizes = stored.groupBy("file").agg(F.sum("n_ids").alias("n")).orderBy("file").collect()  # one row per file
    before = dict(zip((r["file"] for r in sizes), np.cumsum([0, *(r["n"] for r in sizes)]).tolist(), strict=False))
    spot = F.transform(F.array_sort(F.collect_list(F.struct("segment", "n_ids"))), lambda x: x)
    order = stored.groupBy("file").agg(spot.alias("all"))  # a file's segments are as many as one task wrote
    starts = order.select("file", F.explode(F.transform("all", lambda x: F.struct(
        x["segment"].alias("segment"),
        F.aggregate(F.filter("all", lambda y: y["segment"] < x["segment"]), F.lit(0).cast("long"), lambda a, y: a + y["n_ids"]).alias("first"),
    ))).alias("s")).select("file", "s.segment", "s.first")
    rows = stored.join(starts, ["file", "segment"])

    def run(batches):
        for r in common.each_row(batches):
            ids = _ids_of(r["planes"], r["block_ids"], r["unit"]).astype("<u4", copy=False)
            ends = np.cumsum([0, *r["lengths"]])
            own = [ids[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            start = ends[:-1] + r["first"] + before[r["file"]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(r["doc_ids"], pa.int64()), pa.array(start), pa.array(r["lengths"], pa.int64()), pa.array(own, pa.binary()), pa.array([common.crc32(x) for x in own], pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids", "ids_crc32"],
            )

    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary, ids_crc32 long")
