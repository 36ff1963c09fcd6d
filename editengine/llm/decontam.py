"""Benchmark decontamination: SimHash of item-sized windows, a multi-index of blocks, and an exact check.

A window has as many words as an item; a document with fewer words is one window. Similarity is that of the weighted five-word shingles: the sum of
smaller weights over the sum of larger ones, a shingle's weight being how often it occurs. A window that
reaches ``LEAST`` shares a known number of shingles with the item, so only windows with so many shingles
of any item are fingerprinted at all; this passes over no match. Fingerprints are cut into four blocks: two within
the radius differ by a quarter of it at most in one of them, and the index goes to the block values that near. What
it finds is verified on the shingles themselves.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, wordhash

SHINGLE, LEAST, RADIUS = 5, 0.8, 23
# Item text sent to tasks at a time; queries looked up at a time; values of a block from which on bits are flipped.
ITEM_BYTES, AT_ONCE, CHANGES = 16 << 20, 256, 6885
EDGE = b".,;:!?\"'()[]{}*"
U = np.uint64
FACTORS = wordhash.FACTORS


def shingles(words: np.ndarray) -> np.ndarray:
    """A hash for each run of ``SHINGLE`` words; one of all words if there are fewer."""
    size = min(SHINGLE, len(words))
    if not size:
        return words
    n = len(words) - size + 1
    out = np.zeros(n, dtype=U)
    for k in range(size):
        out += words[k : n + k] * FACTORS[k]
        out ^= out >> U(29 + k)
    return out * FACTORS[0]


def simhash(hashes: np.ndarray) -> np.ndarray:
    """Fingerprints of rows of shingle hashes: a bit is set if it is in over half of them."""
    bits = np.unpackbits(np.ascontiguousarray(hashes).view(np.uint8).reshape(*hashes.shape, 8), axis=2, bitorder="little")
    return np.packbits(2 * bits.sum(axis=1, dtype=np.int32) > hashes.shape[1], axis=1, bitorder="little").view("<u8").ravel()


class MultiIndex:
    """Finds all of its fingerprints within the radius of a query.

    Two within the radius differ in at most a quarter of it in one of four blocks of 16 bits. In each block the
    index goes to the values that lie so near to the query's: by flipping bits of the query where that is fewer
    look-ups than there are values, else by comparing the values.
    """

    BLOCK = 16

    def __init__(self, values: np.ndarray, radius: int = RADIUS):
        self.values, self.radius, self.flips = values, radius, radius // 4
        parts = [((values >> U(k * self.BLOCK)) & U(0xFFFF)).astype(np.uint16) for k in range(4)]
        self.order = [np.argsort(x, kind="stable") for x in parts]
        self.known = [np.unique(x, return_counts=True) for x in parts]
        self.met = 0  # fingerprints compared so far

    def blocks(self) -> np.ndarray:
        """All changes of a block by as many bits as may differ."""
        every = np.arange(1 << self.BLOCK, dtype=np.uint16)
        return every[np.bitwise_count(every) <= self.flips]

    def near(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (place of the query, place of the fingerprint) within the radius, each once."""
        pairs, n = [np.zeros(0, dtype=np.int64)], len(self.values)
        for k, (order, (known, counts)) in enumerate(zip(self.order, self.known, strict=True)):
            own = ((queries >> U(k * self.BLOCK)) & U(0xFFFF)).astype(np.uint16)
            changes = self.blocks() if n > 4 * CHANGES else None
            ends = np.cumsum(counts)
            for start in range(0, len(own), AT_ONCE):
                part = own[start : start + AT_ONCE]
                if changes is None or len(changes) >= len(known):
                    q, at = np.nonzero(np.bitwise_count(part[:, None] ^ known) <= self.flips)
                else:
                    wanted = part[:, None] ^ changes
                    place = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
                    q, column = np.nonzero(known[place] == wanted)
                    at = place[q, column]
                size = counts[at]
                q = np.repeat(q + start, size)
                within = np.arange(len(q)) - np.repeat(np.cumsum(size) - size, size)
                v = order[np.repeat(ends[at] - size, size) + within]
                self.met += len(v)
                close = np.bitwise_count(queries[q] ^ self.values[v]) <= self.radius
                pairs.append(q[close] * n + v[close])
        both = np.unique(np.concatenate(pairs))
        return both // n, both % n


class Items:
    """Benchmark items by their number of words. Items without a word match nothing."""

    def __init__(self, rows: list[tuple[int, str]], least: float = LEAST, radius: int = RADIUS):
        self.least = least
        by: dict[int, list] = {}
        hashes, bounds = wordhash.words([text or "" for _, text in rows], EDGE)
        for (item_id, _), start, stop in zip(rows, bounds.tolist(), bounds.tolist()[1:], strict=False):
            words = hashes[start:stop]
            if len(words):
                by.setdefault(len(words), []).append((item_id, shingles(words)))
        self.sizes = []
        for n, own in sorted(by.items()):
            count = len(own[0][1])
            need = int(np.ceil(2 * count * least / (1 + least) - 1e-9))
            self.sizes.append((n, count, need, [i for i, _ in own], [Counter(h.tolist()) for _, h in own], MultiIndex(simhash(np.stack([h for _, h in own])), radius)))
        # Items under five words have one shingle of their own length.
        self.short = sorted({n for n in by if n < SHINGLE})
        self.known = np.unique(np.concatenate([h for own in by.values() for _, h in own])) if by else np.zeros(0, dtype=U)
        self.rough = np.zeros(1 << 20, dtype=bool)
        self.rough[(self.known >> U(44)).astype(np.int64)] = True

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        """Which shingles are of any item."""
        out = self.rough[(hashes >> U(44)).astype(np.int64)]
        at = np.flatnonzero(out)
        if len(at):
            place = np.minimum(np.searchsorted(self.known, hashes[at]), len(self.known) - 1)
            out[at] = self.known[place] == hashes[at]
        return out

    def candidates(self, texts: list[np.ndarray]) -> list[int]:
        """The texts that may hold a match, looked through at once: those with a shingle of any item."""
        if not len(self.known):
            return []
        if self.short:
            return list(range(len(texts)))
        ends = np.cumsum([len(x) for x in texts])
        every = np.concatenate(texts)
        if len(every) < SHINGLE:
            return []
        return np.unique(np.searchsorted(ends, np.flatnonzero(self.hits(shingles(every))), side="right")).tolist()

    def find(self, words: np.ndarray) -> list[tuple[int, int, int, float, int]]:
        """(item, first word, words, similarity, matching windows) of the best window for each item."""
        if not len(self.known):
            return []
        long = shingles(words) if len(words) >= SHINGLE else np.zeros(0, dtype=U)
        flags = self.hits(long)
        some = bool(flags.any())
        if not some and not self.short:
            return []
        sums = np.r_[0, np.cumsum(flags)]
        best: dict[int, tuple] = {}
        for n, count, need, ids, weights, index in self.sizes:
            size = min(n, len(words))
            if n > len(words):
                # Too short even if all of its shingles were the item's; the items that follow are longer yet.
                if len(long) < max(1, self.least * count - 1e-9):
                    break
                if sums[-1] < self.least / (1 + self.least) * (len(long) + count) - 1e-9:
                    continue
                starts, rows = np.zeros(1, dtype=np.int64), long[None]
            elif n < SHINGLE:
                own = sum_words(words, n)
                starts = np.flatnonzero(self.hits(own))
                rows = own[starts][:, None]
            else:
                if not some:
                    continue
                starts = np.flatnonzero(sums[count:] - sums[:-count] >= need)
                rows = None
            for at in range(0, len(starts), 4096):
                part = starts[at : at + 4096]
                window = long[part[:, None] + np.arange(count)] if rows is None else rows[at : at + 4096]
                q, v = index.near(simhash(window))
                for j, k in zip(q.tolist(), v.tolist(), strict=True):
                    own = Counter(window[j].tolist())
                    common_weight = sum((own & weights[k]).values())
                    likeness = common_weight / (window.shape[1] + count - common_weight)
                    if likeness >= self.least - 1e-12:
                        old = best.get(ids[k], (ids[k], 0, 0, -1.0, 0))
                        best[ids[k]] = (ids[k], int(part[j]), size, likeness, old[4] + 1) if likeness > old[3] else (*old[:4], old[4] + 1)
        return list(best.values())


def sum_words(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words, as ``shingles`` hashes a text of ``n`` words."""
    out = np.zeros(len(words) - n + 1, dtype=U)
    for k in range(n):
        out += words[k : len(out) + k] * FACTORS[k]
        out ^= out >> U(29 + k)
    return out * FACTORS[0]


MATCHES = "doc_id long, item_id long, start_word long, n_words int, similarity double, n_windows long"


def _groups(items: DataFrame) -> list[DataFrame]:
    """The items in parts whose text is small enough to be sent to every task."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-2 * size // ITEM_BYTES)) if size > ITEM_BYTES else 1
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k) for k in range(parts)]


def _words(texts: list[str]) -> list[np.ndarray]:
    """The words of each text as hashes, without the marks around them; a word that is all marks stays as it is."""
    hashes, bounds = wordhash.words(texts, EDGE)
    return [hashes[a:b] for a, b in zip(bounds.tolist(), bounds.tolist()[1:], strict=False)]


def matches(docs: DataFrame, items: DataFrame, least: float = LEAST, radius: int = RADIUS) -> DataFrame:
    """A row for each document and item that it holds: its best window and how many windows match.

    Null and empty texts match nothing, nor do items without an id or a word. Repeated rows of a
    document are listed each; items that repeat count once. Very long texts are taken whole. Of equally
    good windows the first is given. An empty table gives no row.
    """
    out = None
    for group in _groups(items):
        sent = docs.sparkSession.sparkContext.broadcast(Items([(r["item_id"], r["text"]) for r in group.collect()], least, radius))

        def run(batches, sent=sent):
            for part, texts in common.slices(batches):
                words, ids = _words(texts), part.column(0).to_pylist()
                rows = [(ids[k], *m) for k in sent.value.candidates(words) for m in sent.value.find(words[k])]
                if rows:
                    kinds = pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.int64()
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "item_id", "start_word", "n_words", "similarity", "n_windows"])

        found = common.id_text(docs).mapInArrow(run, MATCHES)
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, items: DataFrame, least: float = LEAST, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that hold no item, unchanged, each judged on its own text, whole however long.

    Rows with a null or empty text hold nothing and stay; rows that repeat each other share their fate.
    """
    names = docs.columns
    out = docs.toDF(*(f"c{k}" for k in range(len(names))))
    at = f"c{names.index('text')}"
    for group in _groups(items):
        sent = docs.sparkSession.sparkContext.broadcast(Items([(r["item_id"], r["text"]) for r in group.collect()], least, radius))

        def run(batches, sent=sent):
            for part, texts in common.slices(batches, at):
                words, kept = _words([text or "" for text in texts]), np.ones(len(texts), dtype=bool)
                for k in sent.value.candidates(words):
                    kept[k] = not sent.value.find(words[k])
                yield part.filter(pa.array(kept))

        out = out.mapInArrow(run, out.schema)
    return out.toDF(*names)
