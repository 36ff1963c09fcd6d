"""Removal of repeated byte strings, exactly, by bucket-pointer refinement of suffixes.

All suffixes cannot meet in one place, so they are dealt out by content: a string of ``length`` bytes is
known by the q-gram in it with the smallest hash, its anchor, which equal strings share. Runs of strings
with one anchor are pieces of text. First each chunk of documents asks which of its anchors occur in
other documents too; only pieces at those are sent on, each text once per chunk. In a bucket the pieces
at one anchor are suffixes that share a q-gram. If they are all alike they are done. Otherwise their
suffixes are refined: initial buckets are eight bytes, and a bucket is sorted by the bucket pointers
that its members have at a later offset, 8, then 16, then as far as ``length`` needs; each round uses the
pointers that the last one left, and buckets of one are not looked at again. Strings whose pointers
are equal are equal, and the smallest document of each answers the chunks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

LENGTH, GRAM = 50, 24
CHUNK_BYTES, BUCKET_ANCHORS, REFINE_BYTES = 2 << 20, 1_000_000, 1 << 18
LAST = np.iinfo(np.int64).max  # stands for a missing id: after all others
CHUNKS = "chunk long, doc_ids array<long>, lengths array<long>, data binary"
U = np.uint64


def chunks(docs: DataFrame) -> DataFrame:
    """Documents in chunks of some megabytes, their bytes compressed together."""

    def run(batches):
        from pyspark import TaskContext

        chunk, pack = TaskContext.get().partitionId() << 24, zstandard.ZstdCompressor(level=3)
        ids, held, size = [], [], 0

        def row():
            values = chunk, ids, [len(x) for x in held], pack.compress(b"".join(held))
            return pa.RecordBatch.from_arrays([pa.array([v], type=t) for v, t in zip(values, kinds, strict=True)], names=["chunk", "doc_ids", "lengths", "data"])

        for part, texts in common.slices(batches):
            for doc_id, text in zip(part.column(0).to_pylist(), texts, strict=True):
                ids.append(doc_id)
                held.append(text.encode())
                size += len(held[-1])
                if size >= CHUNK_BYTES:
                    yield row()
                    ids, held, size, chunk = [], [], 0, chunk + 1
        if ids:
            yield row()

    kinds = pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()
    return common.id_text(docs).mapInArrow(run, CHUNKS)


class Chunk:
    """A chunk's bytes and its anchors.

    ``first`` and ``last`` are the starts of the first and last string of each run, ``anchor`` where the
    run's anchor is, ``mark`` its hash, ``doc`` the document's place in the chunk.
    """

    def __init__(self, row: dict, length: int):
        raw = zstandard.ZstdDecompressor().decompress(row["data"]) if row["data"] else b""
        self.data = np.frombuffer(raw, dtype=np.uint8)
        self.ends = np.cumsum([0, *row["lengths"]])
        self.ids = np.array([LAST if x is None else x for x in row["doc_ids"]], dtype=np.int64)
        n = len(self.data)
        none = np.zeros(0, dtype=np.int64)
        self.first = self.last = self.anchor = self.doc = none
        self.mark = none.astype(U)
        if n < length:
            return
        grams = n - GRAM + 1
        hashes = gram_hashes(self.data)
        bits = U(max(1, int(grams - 1).bit_length()))
        low = (hashes >> bits) << bits
        low |= np.arange(grams, dtype=U)
        least, wide, window = low, 1, length - GRAM + 1
        while 2 * wide <= window:
            least = np.minimum(least[:-wide], least[wide:])
            wide *= 2
        if wide < window:
            least = np.minimum(least[: grams - window + 1], least[window - wide : window - wide + grams - window + 1])
        at = (least & ((U(1) << bits) - U(1))).astype(np.int64)
        # Strings that lie in one document; runs end where the anchor changes or a document does.
        starts = np.arange(len(at))
        inside = np.zeros(len(at) + 1, dtype=np.int64)
        sizes = np.diff(self.ends)
        fit = sizes >= length
        np.add.at(inside, self.ends[:-1][fit], 1)
        np.add.at(inside, self.ends[1:][fit] - length + 1, -1)
        inside = np.cumsum(inside[:-1]) > 0
        fresh = np.r_[True, at[1:] != at[:-1]] & inside
        fresh |= inside & ~np.r_[False, inside[:-1]]
        begin = np.zeros(len(at), dtype=bool)
        begin[self.ends[:-1][fit]] = True
        fresh |= begin
        self.first = starts[fresh]
        stop = np.flatnonzero(inside & np.r_[~inside[1:] | fresh[1:], True])
        self.last, self.anchor = stop, at[self.first]
        self.mark = hashes[self.anchor]
        self.doc = np.searchsorted(self.ends, self.first, side="right") - 1


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes at each place."""
    eight = eights(data)
    n = len(data) - GRAM + 1
    h = eight[:n] * U(0x9E3779B97F4A7C15)
    h ^= h >> U(29)
    h += eight[8 : n + 8] * U(0xC2B2AE3D27D4EB4F)
    h ^= h >> U(31)
    h *= U(0xBF58476D1CE4E5B9)
    h += eight[16 : n + 16]
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(32)
    h *= U(0xD6E8FEB86659FD93)
    return h


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes at each place as a number."""
    two = data[:-1].astype(np.uint16) | (data[1:].astype(np.uint16) << np.uint16(8))
    four = two[:-2].astype(np.uint32) | (two[2:].astype(np.uint32) << np.uint32(16))
    return four[:-4].astype(U) | (four[4:].astype(U) << U(32))


def refine(data: np.ndarray, length: int) -> np.ndarray:
    """For each place a bucket pointer, equal for places with the same next ``length`` bytes.

    Places nearer to the end than ``length`` have no meaning.
    """
    if len(data) < length or length < 8:
        raise ValueError("too short")
    code = eights(data)
    order = np.argsort(code)
    code = code[order]
    pointer = pointers(order, code[1:] != code[:-1])
    reach = 8
    while reach < length:
        step = min(reach, length - reach)  # the two halves may overlap
        n = len(pointer) - step
        sizes = np.bincount(pointer[:n], minlength=len(code))
        active = np.flatnonzero(sizes[pointer[:n]] > 1)
        later = pointer[active + step]
        order = active[np.argsort((pointer[active].astype(U) << U(32)) | later.astype(U))]
        own, later = pointer[order], pointer[order + step]
        fresh = np.r_[True, (own[1:] != own[:-1]) | (later[1:] != later[:-1])]
        bucket = np.r_[True, own[1:] != own[:-1]]
        place = np.arange(len(order))
        inside = place - np.maximum.accumulate(np.where(bucket, place, 0))
        sub = np.maximum.accumulate(np.where(fresh, place, 0))
        moved = pointer[:n].copy()
        moved[order] = own + inside[sub] if len(order) else own
        pointer, reach = moved, reach + step
    return pointer


def pointers(order: np.ndarray, change: np.ndarray) -> np.ndarray:
    """The rank of the first member of each place's bucket."""
    place = np.arange(len(order))
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.maximum.accumulate(np.where(np.r_[True, change], place, 0))
    return out


def smallest(pieces: list[bytes], anchors: list[int], docs: np.ndarray, length: int) -> list:
    """For each distinct piece the smallest document that holds each of its strings: a number, or an array.

    ``anchors`` is where the anchor begins in the piece, ``docs`` the smallest document with the piece.
    """
    by: dict[bytes, list[int]] = {}
    for k, (piece, at) in enumerate(zip(pieces, anchors, strict=True)):
        by.setdefault(piece[at : at + GRAM], []).append(k)
    out: list = docs.tolist()
    mixed, size = [], 0
    for own in by.values():
        if len(own) > 1:
            mixed += own
            size += sum(len(pieces[k]) for k in own)
            if size >= REFINE_BYTES:
                _refined(pieces, mixed, docs, length, out)
                mixed, size = [], 0
    if mixed:
        _refined(pieces, mixed, docs, length, out)
    return out


def _refined(pieces: list[bytes], mixed: list[int], docs: np.ndarray, length: int, out: list) -> None:
    """Put the smallest documents of the strings of some anchors' pieces into ``out``."""
    data, ends = common.joined([pieces[k] for k in mixed])
    pointer = refine(data, length)
    count = np.diff(ends) - length + 1
    offset = np.cumsum(count) - count
    at = np.repeat(ends[:-1] - offset, count) + np.arange(count.sum())
    found = pointer[at]
    least = np.full(len(data), LAST)
    np.minimum.at(least, found, np.repeat(docs[mixed], count))
    found = least[found]
    for k, a, n in zip(mixed, offset.tolist(), count.tolist(), strict=True):
        out[k] = found[a : a + n]


def _dealt(values: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    of = ((values >> U(20)) % U(buckets)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    return order, np.searchsorted(of[order], np.arange(buckets + 1))


def shared_anchors(stored: DataFrame, length: int) -> tuple[DataFrame, int]:
    """For each chunk and bucket one bit per distinct anchor: is it in another document too?"""
    size = stored.agg(F.coalesce(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0))).first()[0]
    buckets = max(8, -(-2 * size // ((length - GRAM + 2) * BUCKET_ANCHORS)))

    def ask(batches):
        for r in common.each_row(batches):
            chunk = Chunk(r, length)
            marks, several = distinct_marks(chunk)
            order, ends = _dealt(marks, buckets)
            sent = ((marks & ~U(1)) | several.astype(U))[order] & U((1 << 48) - 1)
            low, high = (sent & U(0xFFFFFFFF)).astype(np.uint32), (sent >> U(32)).astype(np.uint16)
            own = [low[a:b].tobytes() + high[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets)), pa.array(np.full(buckets, r["chunk"])), pa.array(own, pa.binary())], names=["bucket", "chunk", "marks"])

    def answer(rows: pa.Table) -> pa.Table:
        parts = []
        for blob in rows["marks"].to_pylist():
            n = len(blob) // 6
            parts.append(np.frombuffer(blob, np.uint32, n).astype(U) | (np.frombuffer(blob, np.uint16, n, 4 * n).astype(U) << U(32)))
        every = np.concatenate(parts)
        known, place, number = np.unique(every >> U(1), return_inverse=True, return_counts=True)
        number = number + np.bincount(place, weights=(every & U(1)).astype(float), minlength=len(known))
        shared = (number > 1)[place]
        ends = np.cumsum([0, *(len(x) for x in parts)])
        bits = [np.packbits(shared[a:b]).tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        return pa.table([rows["chunk"], rows["bucket"], pa.array(bits, pa.binary())], names=["chunk", "bucket", "bits"])

    asked = stored.mapInArrow(ask, "bucket long, chunk long, marks binary")
    return asked.groupBy("bucket").applyInArrow(answer, "chunk long, bucket long, bits binary"), buckets


def distinct_marks(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """The chunk's anchor hashes in order, and whether more than one of its documents has them."""
    if not len(chunk.mark):
        return chunk.mark, np.zeros(0, dtype=bool)
    order = np.argsort(chunk.mark, kind="stable")  # places, and so documents, stay in order
    marks, docs = chunk.mark[order], chunk.doc[order]
    start = np.flatnonzero(np.r_[True, marks[1:] != marks[:-1]])
    stop = np.r_[start[1:], len(marks)] - 1
    return marks[start], docs[start] != docs[stop]


def _shared_runs(chunk: Chunk, answers: list[dict], buckets: int) -> np.ndarray:
    """The chunk's runs whose anchor is in several documents."""
    marks, _ = distinct_marks(chunk)
    order, ends = _dealt(marks, buckets)
    flags = np.zeros(len(marks), dtype=bool)
    for x in answers:
        own = order[ends[x["bucket"]] : ends[x["bucket"] + 1]]
        flags[own] = np.unpackbits(np.frombuffer(x["bits"], np.uint8), count=len(own)).astype(bool)
    return np.flatnonzero(flags[np.searchsorted(marks, chunk.mark)]) if len(marks) else np.zeros(0, dtype=np.int64)


class Pieces:
    """The distinct texts of a chunk's shared runs, in order of first appearance, by bucket."""

    def __init__(self, chunk: Chunk, runs: np.ndarray, length: int, buckets: int):
        raw = chunk.data.tobytes()
        known: dict[bytes, int] = {}
        a, b = chunk.first[runs].tolist(), (chunk.last[runs] + length).tolist()
        self.of = np.fromiter((known.setdefault(raw[x:y], len(known)) for x, y in zip(a, b, strict=True)), np.int64, len(runs))
        self.texts = list(known)
        head = np.zeros(len(known), dtype=np.int64)
        head[self.of[::-1]] = runs[::-1]  # the first run with it
        self.at = (chunk.anchor[head] - chunk.first[head]).astype(np.uint8)
        self.docs = np.full(len(known), LAST)
        np.minimum.at(self.docs, self.of, chunk.ids[chunk.doc[runs]])
        self.order, self.ends = _dealt(chunk.mark[head], buckets)


def mark(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id``, ``text`` (bytes), ``starts`` and ``stops`` of the runs of bytes to remove, for every document.

    A byte goes if a string of ``length`` bytes over it also starts in a document with a smaller
    ``doc_id``. Null and empty texts have no byte. Rows of one id do not count against each other.
    Rows without an id come after all others.
    """
    if length < GRAM + 1:
        raise ValueError(f"length must be over {GRAM}")
    stored = common.cut(chunks(docs), "chunks")
    bits, buckets = shared_anchors(stored, length)
    collect = lambda rows, *names: rows.groupBy("chunk").agg(F.collect_list(F.struct(*names)).alias("answers"))  # noqa: E731  of one chunk
    bits = collect(common.cut(bits, "anchors"), "bucket", "bits")
    parts = stored.repartition("chunk")
    asked = parts.join(bits, "chunk")
    dealt = max(8, buckets)

    def ask(batches):
        pack = zstandard.ZstdCompressor(level=3)
        for r in common.each_row(batches):
            chunk = Chunk(r, length)
            runs = _shared_runs(chunk, r["answers"], buckets)
            own = Pieces(chunk, runs, length, dealt)
            rows = []
            for k in range(dealt):
                at = own.order[own.ends[k] : own.ends[k + 1]]
                if len(at):
                    texts = [own.texts[i] for i in at]
                    sizes = np.array([len(x) for x in texts], dtype=np.uint16)
                    rows.append((k, r["chunk"], len(at), pack.compress(own.docs[at].tobytes() + sizes.tobytes() + own.at[at].tobytes() + b"".join(texts))))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["bucket", "chunk", "n", "pieces"])

    def answer(rows: pa.Table) -> pa.Table:
        unpack, pack = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        known: dict[bytes, int] = {}
        anchors, asked_for, docs_of = [], [], []
        for n, blob in zip(rows["n"].to_pylist(), rows["pieces"].to_pylist(), strict=True):
            raw = unpack.decompress(blob)
            docs_of.append(np.frombuffer(raw, np.int64, n))
            sizes, at = np.frombuffer(raw, np.uint16, n, 8 * n), raw[10 * n : 11 * n]
            ends = (np.cumsum(sizes, dtype=np.int64) + 11 * n).tolist()
            places, a = [], 11 * n
            for b, spot in zip(ends, at, strict=True):
                before = len(known)
                place = known.setdefault(raw[a:b], before)
                if place == before:
                    anchors.append(spot)
                places.append(place)
                a = b
            asked_for.append(np.array(places, dtype=np.int64))
        least = np.full(len(known), LAST)
        np.minimum.at(least, np.concatenate(asked_for), np.concatenate(docs_of))
        texts = list(known)
        found = smallest(texts, anchors, least, length)
        blobs = []
        for places in asked_for:
            runs, values = [], []
            for p in places.tolist():
                x = found[p]
                if isinstance(x, int):
                    runs.append((1,))
                    values.append(x)
                    continue
                edge = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
                values.extend(x[edge].tolist())
                runs.append((len(edge), *np.diff(edge).tolist()))
            shape = np.array([v for r in runs for v in r], dtype=np.uint16)
            blobs.append(pack.compress(len(values).to_bytes(8, "little") + np.array(values, dtype=np.int64).tobytes() + shape.tobytes()))
        return pa.table([rows["chunk"], rows["bucket"], pa.array(blobs, pa.binary())], names=["chunk", "bucket", "least"])

    answers = asked.mapInArrow(ask, "bucket long, chunk long, n long, pieces binary").groupBy("bucket").applyInArrow(answer, "chunk long, bucket long, least binary")
    answers = collect(answers, "bucket", "least").withColumnRenamed("answers", "least")
    final = parts.join(bits, "chunk").join(answers, "chunk", "left")

    def remove(batches):
        unpack = zstandard.ZstdDecompressor()
        for r in common.each_row(batches):
            chunk = Chunk(r, length)
            cover = np.zeros(len(chunk.data) + 1, dtype=np.int32)
            if r["least"]:
                runs = _shared_runs(chunk, r["answers"], buckets)
                own = Pieces(chunk, runs, length, dealt)
                windows = (chunk.last - chunk.first + 1)[runs]
                of_piece = np.zeros(len(own.texts), dtype=np.int64)
                of_piece[own.of] = windows
                # Parts of pieces whose strings have one smallest document.
                piece, start, size, value = [], [], [], []
                for x in r["least"]:
                    raw = unpack.decompress(x["least"])
                    n = int.from_bytes(raw[:8], "little")
                    values, shape = np.frombuffer(raw, np.int64, n, 8), np.frombuffer(raw, np.uint16, offset=8 + 8 * n)
                    at = own.order[own.ends[x["bucket"]] : own.ends[x["bucket"] + 1]]
                    if len(shape) == len(at):
                        number, lead = np.ones(len(at), dtype=np.int64), np.zeros(len(at), dtype=np.int64)
                    else:
                        number, s, k = np.empty(len(at), dtype=np.int64), shape.tolist(), 0
                        gaps = []
                        for j in range(len(at)):
                            number[j] = s[k]
                            edge = 0
                            gaps.append(0)
                            for g in s[k + 1 : k + s[k]]:
                                edge += g
                                gaps.append(edge)
                            k += s[k]
                        lead = np.array(gaps, dtype=np.int64)
                    who = np.repeat(at, number)
                    nexts = np.r_[lead[1:], 0]
                    final_part = np.r_[who[1:] != who[:-1], True] if len(who) else np.zeros(0, bool)
                    piece.append(who)
                    start.append(lead)
                    size.append(np.where(final_part, of_piece[who], nexts) - lead)
                    value.append(values)
                piece, start, size, value = (np.concatenate(x) for x in (piece, start, size, value))
                order = np.argsort(piece, kind="stable")
                piece, start, size, value = piece[order], start[order], size[order], value[order]
                lo, hi = np.searchsorted(piece, own.of, "left"), np.searchsorted(piece, own.of, "right")
                each = np.repeat(np.arange(len(runs)), hi - lo)
                part = np.arange(len(each)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + lo[each]
                gone = value[part] < chunk.ids[chunk.doc[runs[each]]]
                each, part = each[gone], part[gone]
                a = chunk.first[runs[each]] + start[part]
                np.add.at(cover, a, 1)
                np.add.at(cover, a + size[part] - 1 + length, -1)
            covered = np.r_[False, np.cumsum(cover[:-1]) > 0, False]
            edges = chunk.ends[:-1]
            inside = covered[1:-1]
            open_at = np.flatnonzero(inside & (~covered[:-2] | _begins(len(inside), edges)))
            stop_at = np.flatnonzero(inside & (~covered[2:] | np.r_[_begins(len(inside), edges)[1:], True])) + 1
            split = np.searchsorted(open_at, chunk.ends)
            raw, e = chunk.data.tobytes(), chunk.ends
            starts = [(open_at[x:y] - z).tolist() for x, y, z in zip(split[:-1], split[1:], e[:-1], strict=True)]
            stops = [(stop_at[x:y] - z).tolist() for x, y, z in zip(split[:-1], split[1:], e[:-1], strict=True)]
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(r["doc_ids"], pa.int64()), pa.array([raw[x:y] for x, y in zip(e[:-1], e[1:], strict=True)], pa.binary()), pa.array(starts, lists), pa.array(stops, lists)],
                names=["doc_id", "text", "starts", "stops"],
            )

    return final.mapInArrow(remove, "doc_id long, text binary, starts array<long>, stops array<long>")


def _begins(n: int, edges: np.ndarray) -> np.ndarray:
    out = np.zeros(n, dtype=bool)
    out[edges[edges < n]] = True
    return out


def remove(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``starts``, ``stops``, and ``kept``, the bytes that stay."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, common.SLICE_ROWS):
                part = batch.slice(at, common.SLICE_ROWS)
                rows = []
                for text, starts, stops in zip(*(part.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                    kept = b"".join(text[a:b] for a, b in zip([0, *stops], [*starts, len(text)], strict=True))
                    rows.append((len(text), len(text) - len(kept), kept))
                size, gone, kept = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), part.column(2), part.column(3), pa.array(kept, pa.binary())],
                    names=["doc_id", "n_bytes", "n_removed", "starts", "stops", "kept"],
                )

    return mark(docs, length).mapInArrow(run, "doc_id long, n_bytes long, n_removed long, starts array<long>, stops array<long>, kept binary")
