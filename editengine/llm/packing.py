"""Best-fit packing of documents into sequences of a fixed length, planned on the histogram of lengths.

The plan is made from how many pieces there are of each length, at most ``capacity`` numbers, so the
driver's work does not depend on the corpus. Pieces then take the planned places by their rank among
the pieces of their length; ranks are counts per task plus the place within the task, so that one
length may hold any share of the pieces.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .tokens import END_ID, shared_encoder

TOKENIZER = "byte_bpe_50k.json"
CAPACITY = 1024
PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, ids binary, task int, nth long"


def pieces(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True, memo: int | None = None) -> DataFrame:
    """Every document's ids, those of longer ones cut from the end, so that only the first piece is shorter."""
    end = end_id.to_bytes(4, "little")

    def run(batches):
        from pyspark import TaskContext

        encoder, task = shared_encoder(tokenizer, memo), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for part, texts in common.slices(batches):
            rows = []
            for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encode(texts), strict=True):
                ids += end
                n, start, piece = len(ids) // 4, 0, 0
                while start < n:
                    stop = start + ((n - start) % capacity or capacity)
                    own = ids[4 * start : 4 * stop]
                    rows.append((doc_id, piece, start, stop - start, common.crc32(own), own if with_ids else None, task, int(seen[stop - start])))
                    seen[stop - start] += 1
                    start, piece = stop, piece + 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.int64())
            names = ("doc_id", "piece", "start", "length", "ids_crc32", "ids", "task", "nth")
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=list(names))

    return common.id_text(docs).mapInArrow(run, PIECES)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best fit, longest first, over counts: (length, first rank, number, first sequence, offset).

    The pieces of a length with ranks from the first one on go to consecutive sequences, one each, at
    the offset. Sequences that are filled alike are one range, so a length needs few steps.
    """
    room: dict[int, list[tuple[int, int]]] = {}  # space left: ranges of sequences
    slots, opened = [], 0
    for length in sorted((x for x, n in histogram.items() if n), reverse=True):
        rank, left = 0, histogram[length]
        fits = sorted(space for space in room if space >= length)
        while left:
            if fits:
                space = fits[0]
                first, n = room[space].pop()
                if not room[space]:
                    del room[space]
                    fits.pop(0)
                used = min(n, left)
                if used < n:
                    room.setdefault(space, []).append((first + used, n - used))
                times = 1
            else:
                space, first, times = capacity, opened, min(capacity // length, left)
                used = left // times
                opened += used
            for k in range(times):
                slots.append((length, rank, used, first, capacity - space + k * length))
                rank += used
            left -= used * times
            rest = space - times * length
            if rest:
                room.setdefault(rest, []).append((first, used))
                if rest >= length and times == 1:
                    fits = sorted(x for x in room if x >= length)
    return slots


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True, memo: int | None = None) -> DataFrame:
    """One row per piece: its document's ids from ``start`` on, and its place (``sequence_id``, ``offset``).

    ``with_ids`` false leaves the ids themselves null; where they go and their checksum stay.

    Null and empty texts hold the end id alone. Repeated rows and null ids are packed like any other;
    an empty table gives no row.
    """
    stored = common.cut(pieces(docs, tokenizer, capacity, end_id, with_ids, memo), "pieces")
    per_task = stored.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = per_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    counts = {r["length"]: r["n"] for r in stored.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = np.array(sorted(plan(counts, capacity)) or [(0, 0, 0, 0, 0)], dtype=np.int64)
    span = max(counts.values(), default=1) + 1
    keys = slots[:, 0] * span + slots[:, 1]

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(k).to_numpy().astype(np.int64) for k in (0, 1))
            at = np.searchsorted(keys, length * span + rank, side="right") - 1
            more = [pa.array(slots[at, 3] + rank - slots[at, 1]), pa.array(slots[at, 4])]
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], *more], names=[*batch.schema.names[2:], "sequence_id", "offset"])

    kept = "doc_id", "piece", "start", "ids_crc32", "ids"
    ranked = stored.join(base, ["task", "length"]).select("length", (F.col("base") + F.col("nth")).alias("rank"), *kept, F.col("length").cast("long").alias("size"))
    placed = ranked.mapInArrow(place, "doc_id long, piece int, start long, ids_crc32 long, ids binary, size long, sequence_id long, offset long")
    return placed.select("doc_id", "piece", "start", F.col("size").alias("length"), "ids_crc32", "sequence_id", "offset", "ids")
