"""SimHash near-duplicates: a self-join of a binary trie of fingerprints, and its connected components.

Two nodes of the trie are walked together, from a node paired with itself at the top: bits on which
their paths differ are summed up, and a pair is given up as soon as the sum exceeds the budget. To share
the walk out, the 64 bits are cut into blocks, more of them than the budget has errors, so that a pair
within budget agrees on some choice of ``blocks - errors`` of them. For each choice the trie is built
with those bits first; the walks that have spent nothing after them are the tasks, a node paired with
itself, and no link is lost. A node with many fingerprints is dealt into parts, and pairs of parts are
the tasks.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WORDS, SEED, ERRORS, BITS = 4, 42, 4, 64
# Fingerprints of a part of a large node; fingerprints and node pairs walked at a time.
PART, AT_ONCE, PAIRS = 4096, 32_768, 1 << 20


def fingerprint(text: str, words: int = WORDS, seed: int = SEED) -> int:
    """A bit is set if it is in over half of the hashes of the word shingles, repeats included; no word: 0."""
    found = text.encode().lower().split()  # bytes: ASCII letters and ASCII white space only
    if not found:
        return 0
    data, n = b" ".join(found), max(1, len(found) - words + 1)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    starts = (np.r_[0, ends[:-1]])[:n].tolist()
    stops = (ends[min(words, len(found)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter([digest(data[a:b], seed) for a, b in zip(starts, stops, strict=True)], np.uint64, n)
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """The bits that are in over half of the hashes; of none: 0."""
    sums, n = np.zeros(BITS, dtype=np.int64), len(hashes)
    for at in range(0, n, 1 << 16):
        part = hashes[at : at + (1 << 16)]
        sums += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(sums * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``fingerprint`` (the 64 bits as a long) of whole texts."""

    def run(part, texts):
        found = np.array([fingerprint(x, words, seed) for x in texts], dtype=np.uint64)
        return part.column(0), pa.array(found.view(np.int64))

    return common.by_slice(common.id_text(docs), run, "doc_id long, fingerprint long")


def choices(blocks: int, errors: int) -> list[np.ndarray]:
    """Orders of the bits, highest first: for each choice of blocks those blocks' bits, then the others."""
    edges = np.linspace(0, BITS, blocks + 1).astype(int)
    parts = [list(range(a, b)) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return [(np.array(sum((parts[k] for k in own), []) + sum((parts[k] for k in range(blocks) if k not in own), [])), sum(len(parts[k]) for k in own)) for own in combinations(range(blocks), blocks - errors)]


def blocks_for(n: int, errors: int) -> int:
    """Enough blocks that a node after the chosen ones holds few of ``n`` evenly spread fingerprints."""
    blocks = errors + 1
    while blocks < 2 * errors and n >> (BITS * (blocks - errors) // blocks) > 64:
        blocks += 1
    return blocks


def in_order(values: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The values with their bits in another order, the first of it highest."""
    out = np.zeros_like(values)
    for place, bit in enumerate(order):
        out |= ((values >> np.uint64(BITS - 1 - bit)) & np.uint64(1)) << np.uint64(BITS - 1 - place)
    return out


def walk(keys: np.ndarray, roots: np.ndarray, depth: int, errors: int) -> np.ndarray:
    """For every key the smallest index it is linked to, itself included, over all links below the roots.

    ``keys`` are sorted within each node; ``roots`` has rows (a from, a to, b from, b to) of node pairs,
    a node with itself or two parts of one.
    """
    label = np.arange(len(keys))
    ones: dict[int, np.ndarray] = {}

    def split(lo, hi, bit):
        if bit not in ones:
            ones[bit] = np.r_[0, np.cumsum((keys >> np.uint64(BITS - 1 - bit)) & np.uint64(1))].astype(np.int64)
        return hi - (ones[bit][hi] - ones[bit][lo])

    stack = [(depth, np.c_[roots, np.zeros(len(roots), dtype=np.int64)])]
    while stack:
        bit, pairs = stack.pop()
        if len(pairs) > PAIRS:
            stack += [(bit, x) for x in np.array_split(pairs, -(-len(pairs) // PAIRS))]
            continue
        a0, a1, b0, b1, spent = pairs.T
        single = ((a1 - a0) == 1) & ((b1 - b0) == 1)
        if single.any():
            x, y = a0[single], b0[single]
            near = np.bitwise_count(keys[x] ^ keys[y]) <= errors
            merge(label, x[near], y[near])
            pairs = pairs[~single]
            a0, a1, b0, b1, spent = pairs.T
        if not len(pairs) or bit == BITS:
            continue
        am, bm, same = split(a0, a1, bit), split(b0, b1, bit), (a0 == b0) & (a1 == b1)
        zero, one = np.c_[a0, am, b0, bm, spent], np.c_[am, a1, bm, b1, spent]
        cross = np.c_[a0, am, bm, b1, spent + 1], np.c_[am, a1, b0, bm, spent + 1][~same]
        below = np.concatenate([zero, one, *cross])
        below = below[(below[:, 0] < below[:, 1]) & (below[:, 2] < below[:, 3]) & (below[:, 4] <= errors)]
        alone = (below[:, 0] == below[:, 2]) & (below[:, 1] - below[:, 0] == 1) & (below[:, 3] - below[:, 2] == 1)
        stack.append((bit + 1, below[~alone]))
    return label


def merge(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Join the sets of ``x`` and ``y`` in ``label``, which points to the smallest member of a set."""
    while len(x):
        x, y = label[x], label[y]
        apart = x != y
        x, y = x[apart], y[apart]
        if not len(x):
            return
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            after = label[label]
            if (after == label).all():
                break
            label[:] = after


def links(nodes: DataFrame, errors: int = ERRORS, blocks: int | None = None) -> DataFrame:
    """``a``, ``b``: links that connect all ``node`` whose distinct ``fingerprint`` differ in at most ``errors`` bits.

    Inside a task links are reduced to a spanning forest, so that a group of n copies gives less than
    n rows for each choice of blocks, not n squared.
    """
    orders = choices(blocks or blocks_for(nodes.count(), errors), errors)

    def spread(batches):
        for batch in batches:
            node, value = batch.column(0), batch.column(1).to_numpy().view(np.uint64)
            for k, (order, bits) in enumerate(orders):
                key = in_order(value, order)
                lead = (key >> np.uint64(BITS - bits)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), k, np.int32)), pa.array(lead), pa.array(key.view(np.int64)), node], names=["choice", "lead", "key", "node"])

    rows = nodes.select("node", "fingerprint").mapInArrow(spread, "choice int, lead long, key long, node long")
    large = rows.groupBy("choice", "lead").count().where(F.col("count") > PART).select("choice", "lead", F.ceil(F.col("count") / PART).cast("int").alias("parts"))
    dealt = rows.join(large, ["choice", "lead"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
    tasks = dealt.select("choice", "lead", "key", "node", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    tasks = tasks.select("choice", "lead", F.least("own", "other").alias("u"), F.greatest("own", "other").alias("v"), "own", "key", "node")
    by = ["choice", "lead", "u", "v"]
    depth = {k: bits for k, (_, bits) in enumerate(orders)}

    def join(rows: pa.Table):
        choice, lead, u, v, own, key, node = (rows.column(k).to_numpy() for k in range(7))
        key = key.view(np.uint64)
        second = (own == v) & (u != v)
        order = np.lexsort((key, second, v, u, lead, choice))
        choice, lead, u, v, key, node, second = (x[order] for x in (choice, lead, u, v, key, node, second))
        fresh = np.r_[True, (choice[1:] != choice[:-1]) | (lead[1:] != lead[:-1]) | (u[1:] != u[:-1]) | (v[1:] != v[:-1])]
        start = np.flatnonzero(fresh)
        stop = np.r_[start[1:], len(key)]
        middle = stop - np.add.reduceat(second.astype(np.int64), start)
        two = u[start] != v[start]
        roots = np.c_[start, np.where(two, middle, stop), np.where(two, middle, start), stop]
        roots = roots[(roots[:, 1] > roots[:, 0]) & (roots[:, 3] > roots[:, 2]) & (roots[:, 3] - roots[:, 0] > 1)]
        out = []
        for k in np.unique(choice[roots[:, 0]]) if len(roots) else ():
            label = walk(key, roots[choice[roots[:, 0]] == k], depth[int(k)], errors)
            at = np.flatnonzero(label != np.arange(len(label)))
            out.append(np.c_[node[at], node[label[at]]])
        found = np.concatenate(out) if out else np.zeros((0, 2), dtype=np.int64)
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    def run(batches):
        """Whole nodes at a time; the last one of a batch waits for the next batch."""
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            ids = [rows.column(k).to_numpy() for k in range(4)]
            fresh = np.flatnonzero(np.any([x[1:] != x[:-1] for x in ids], axis=0)) + 1
            if not len(fresh):
                held = rows
                continue
            at = 0
            while at < fresh[-1]:
                inside = fresh[(fresh > at) & (fresh <= max(at + AT_ONCE, fresh[fresh > at][0]))]
                yield join(rows.slice(at, int(inside[-1]) - at))
                at = int(inside[-1])
            held = rows.slice(at)
        if held is not None and held.num_rows:
            yield join(held)

    tasks = tasks.repartition(*by).sortWithinPartitions(*by).select(*by, "own", "key", "node")
    return tasks.mapInArrow(run, "a long, b long").distinct()


def groups(docs: DataFrame, words: int = WORDS, seed: int = SEED, errors: int = ERRORS) -> DataFrame:
    """``doc_id``, ``fingerprint`` (hex), ``component_id``: the smallest id reachable over links.

    Equal fingerprints are one node, so exact copies cost nothing further. Texts without a word (null,
    empty, white space) have fingerprint zero and are linked like any other. Rows that repeat an id are
    each listed. Rows without an id are listed with the group of their fingerprint, null if only such
    rows have it.
    """
    rows = common.cut(fingerprints(docs, words, seed), "fingerprints")
    nodes = rows.where("doc_id IS NOT NULL").groupBy("fingerprint").agg(F.min("doc_id").alias("node"))
    nodes = common.cut(nodes, "nodes")
    roots = common.components(links(nodes, errors), "components")
    of = nodes.join(roots, "node", "left").select("fingerprint", F.coalesce("root", "node").alias("component_id"))
    out = rows.join(of, "fingerprint", "left")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
