"""Jaccard join of texts by their word shingles: prefixes under several global orders, then an exact check.

Two sets link when ``least`` hundredths of their union are common. Put the tokens of all sets into any one
order: a set of n tokens and each partner have a common token among the first n - ceil(least * n / 100) + 1
of both. This holds for every order, so a pair must pass for each of several:

* The first order brings candidates together. Tokens known to be frequent come last in it, others by hash,
  so what many texts share (a passage, a licence) is in few prefixes. What counts as frequent only decides
  how much work there is, never which links are found.
* The others are hash orders of their own, with prefixes longer by m - 1 tokens: linked sets have the first m
  of their common tokens among those of both, so a candidate with fewer in common there goes.

The sets with one prefix token are gathered under the first of them, their leader: two with a common prefix
token have a leader in common. Leaders' groups are dealt into parts of bounded size and pairs of parts are the
tasks. A first round of tasks gets prefixes alone and keeps the sets that pass all filters with another one; a
second gets whole sets, compares each with those that pass and are not in its component already, and gives a
spanning forest of the links. Pairs never leave a task.

A token is the 64-bit hash of a shingle. Texts are read three times rather than their tokens stored.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .wordhash import FACTORS, U, mixed, token_sets

WORDS, LEAST = 4, 85
# Orders beside the first one; tokens counted as frequent from here on; how many of them are sent to tasks.
FURTHER, FREQUENT, SENT = 2, 16, 200_000
# Tokens of a set that are counted: one and a half times its prefix, or so many. Tokens in a part of a leader's group.
COUNTED, PART = 24, 1_000_000
# Characters of texts handled at a time.
SLICE = 1_000_000
NAMES = [f"p{k}" for k in range(FURTHER + 1)]


class Rule(NamedTuple):
    """Sets of runs of ``words`` words link if ``least`` hundredths of their union are common."""

    words: int = WORDS
    least: int = LEAST

    def needed(self, n):
        """Common tokens that a set of n has with any partner at least."""
        return (n * self.least + 99) // 100

    def more(self, n):
        """Common tokens that the longer prefixes of linked sets have at least; of two sets the smaller number counts."""
        return (n - self.needed(n) + 1) // 2 + 1

    def links(self, shared, a, b):
        """Whether sets of a and b tokens with so many in common link; arrays or numbers."""
        return 100 * shared >= self.least * (a + b - shared)

    def smallest(self) -> int:
        """The size from which on a set has a partner but itself: k tokens may link with k + 1."""
        return next(k for k in range(1, 1000) if self.links(k, k, k + 1))


def offsets(sizes: np.ndarray) -> np.ndarray:
    return np.r_[0, np.cumsum(sizes)]


def lists(values: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(bounds.astype(np.int32), values)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of lists one after the other, and the lists' sizes."""
    return column.flatten().to_numpy(), np.diff(column.offsets.to_numpy()).astype(np.int64)


def first_of(rank: np.ndarray, sizes: np.ndarray, tokens: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sets one after the other so many tokens, by rank, then as they lie; with their bounds."""
    own = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((rank, own))  # sets stay where they are
    keep = np.arange(len(own)) - offsets(sizes)[own] < lengths[own]
    return tokens[order][keep], offsets(np.bincount(own[keep], minlength=len(sizes)))


class Orders:
    """The global orders: by the power of two of a token's count if it is known as frequent, then by hash; and
    hash orders."""

    def __init__(self, token: np.ndarray, power: np.ndarray, rule: Rule):
        self.token, self.power, self.rule = token, power, rule
        self.rough = np.zeros(1 << 22, dtype=bool)
        self.rough[token.view(U) >> U(42)] = True

    def powers(self, tokens: np.ndarray) -> np.ndarray:
        out = np.zeros(len(tokens), dtype=np.int8)
        at = np.flatnonzero(self.rough[tokens.view(U) >> U(42)])
        if len(at):
            place = np.minimum(np.searchsorted(self.token, tokens[at]), len(self.token) - 1)
            out[at] = np.where(self.token[place] == tokens[at], self.power[place], 0)
        return out

    def prefixes(self, tokens: np.ndarray, sizes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each order the prefixes of the sets, and their bounds."""
        rest, more = sizes - self.rule.needed(sizes), self.rule.more(sizes)
        first = first_of(self.powers(tokens), sizes, tokens, rest + 1)
        return [first, *(first_of(mixed(tokens.view(U) + FACTORS[k]), sizes, tokens, rest + more) for k in range(FURTHER))]


def _counted(docs: DataFrame, rule: Rule) -> DataFrame:
    """``token``: of every text those first by hash."""

    def run(part, texts):
        tokens, sizes = token_sets(texts, rule.words)
        own = np.repeat(np.arange(len(sizes)), sizes)
        most = np.maximum(COUNTED, 3 * (sizes - rule.needed(sizes) + 1) // 2)
        return (pa.array(tokens[np.arange(len(own)) - offsets(sizes)[own] < most[own]]),)

    return common.by_slice(common.id_text(docs), run, "token long", chars=SLICE)


def orders_of(docs: DataFrame, rule: Rule) -> Orders:
    """Orders that know the frequent tokens, at most about ``SENT``."""
    counts = _counted(docs, rule).groupBy("token").count().where(F.col("count") >= FREQUENT)
    counts = common.cut(counts.select("token", F.floor(F.log2("count")).cast("byte").alias("power")), "frequent")
    quota, wanted = SENT, F.lit(False)
    for power, count in sorted(((r["power"], r["count"]) for r in counts.groupBy("power").count().collect()), reverse=True):
        if count > quota:  # of the last power those that come first in the order
            wanted |= (F.col("power") == power) & (F.col("token") < int(-(2**63) + 2**64 * (quota / count)))
            break
        wanted |= F.col("power") == power
        quota -= count
    rows = counts.where(wanted).toArrow()
    token, power = rows.column(0).to_numpy(), rows.column(1).to_numpy()
    order = np.argsort(token)
    return Orders(token[order], power[order], rule)


def digests(tokens: np.ndarray, sizes: np.ndarray, seed: int) -> np.ndarray:
    """Two numbers for each set."""
    data, bounds = tokens.tobytes(), (8 * offsets(sizes)).tolist()
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(data[a:b], seed) for a, b in zip(bounds, bounds[1:], strict=False)), dtype="<i8").reshape(-1, 2)


def sets_of(docs: DataFrame, orders: Orders, seed: int = 0, also: Callable[[np.ndarray], int] | None = None) -> DataFrame:
    """``doc_id``, ``mark`` (a hash of the text), ``node`` and ``proof`` (two digests of the set), ``n`` and the
    prefixes of every row: of the first order as tokens, of the others 16 bits of each, enough to tell that few
    are common. ``also`` of a set's tokens comes as a long ``also``."""
    sent, rule = docs.sparkSession.sparkContext.broadcast(orders), orders.rule

    def run(part, texts):
        tokens, sizes = token_sets(texts, rule.words)
        (first, ends), *further = sent.value.prefixes(tokens, sizes)
        node, proof = digests(tokens, sizes, seed).T
        out = [part.column(0), part.column(2), np.ascontiguousarray(node), np.ascontiguousarray(proof), sizes]
        out += [lists(first, ends), *(lists(x.astype(np.int16), e) for x, e in further)]
        if also:
            bounds = offsets(sizes).tolist()
            out.append(np.array([also(tokens[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)], dtype=U).view(np.int64))
        return out

    further = ", ".join(f"{x} array<short>" for x in NAMES[1:])
    schema = f"doc_id long, mark long, node long, proof long, n long, {NAMES[0]} array<long>, {further}" + (", also long" if also else "")
    return common.by_slice(common.id_text(docs).withColumn("mark", F.xxhash64("text")), run, schema, chars=SLICE)


class Bitmap:
    """Tells which hashes surely are not among those of a column: 16 bits for each, but 8 MB at most."""

    def __init__(self, hashes: DataFrame):
        column = F.col(hashes.columns[0])
        self.power = min(26, max(10, (16 * hashes.count()).bit_length()))
        slots = hashes.select(F.shiftrightunsigned(column, 64 - self.power).alias("slot"))
        words = slots.selectExpr("shiftright(slot, 6) AS word", "shiftleft(1L, int(slot & 63)) AS bits").groupBy("word").agg(F.bit_or("bits").alias("bits"))
        rows = words.toArrow()
        self.words = np.zeros(1 << (self.power - 6), dtype=np.int64)
        self.words[rows.column(0).to_numpy()] = rows.column(1).to_numpy()

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes.view(U) >> U(64 - self.power)
        return (self.words[at >> U(6)].view(U) >> (at & U(63)) & U(1)).astype(bool)

    def thinned(self, rows: DataFrame, column: str) -> DataFrame:
        """The rows that may have one of the hashes."""
        sent, place = rows.sparkSession.sparkContext.broadcast(self), rows.columns.index(column)

        def run(batches):
            for batch in batches:
                yield batch.filter(pa.array(sent.value.has(batch.column(place).to_numpy())))

        return rows.mapInArrow(run, rows.schema)


class Index:
    """Sets side by side, those of a task together: their prefixes under every order, with ``tokens`` the whole, and
    their fingerprints ``also``."""

    def __init__(self, rule: Rule, sizes: np.ndarray, prefixes: list[tuple[np.ndarray, np.ndarray]], tokens: np.ndarray | None = None, also: np.ndarray | None = None):
        self.also = also
        self.rule, self.sizes, self.more = rule, sizes, rule.more(sizes)
        self.prefixes = [(x.astype(np.int16).view(np.uint16), b) for x, b in prefixes]
        self.mask = np.zeros(1 << 16, dtype=bool)
        if tokens is not None:
            known, self.ids = np.unique(tokens, return_inverse=True)
            self.starts, self.all = offsets(sizes), np.zeros(len(known), dtype=bool)

    @staticmethod
    def shared(mask: np.ndarray, k: int, values: np.ndarray, bounds: np.ndarray, others: np.ndarray) -> np.ndarray:
        """How many of the values of the k-th set each of the others has among its own."""
        counts = bounds[others + 1] - bounds[others]
        before = np.cumsum(counts) - counts
        at = np.arange(int(counts.sum())) + np.repeat(bounds[others] - before, counts)
        own = values[bounds[k] : bounds[k + 1]]
        mask[own] = True
        out = np.add.reduceat(mask[values[at]], before, dtype=np.int64)
        mask[own] = False
        return out

    def candidates(self, k: int, others: np.ndarray) -> np.ndarray:
        """Those of the other sets that pass every filter with the k-th one."""
        n = self.sizes[k]
        others = others[100 * np.minimum(self.sizes[others], n) >= self.rule.least * np.maximum(self.sizes[others], n)]
        for order, (values, bounds) in enumerate(self.prefixes):
            if not len(others):
                break
            least = np.minimum(self.more[others], self.more[k]) if order else 1
            others = others[self.shared(self.mask, k, values, bounds, others) >= least]
        return others

    def partners(self, k: int, others: np.ndarray) -> np.ndarray:
        """Those of the other sets that link with the k-th one."""
        others = self.candidates(k, others)
        if len(others):
            others = others[self.rule.links(self.shared(self.all, k, self.ids, self.starts, others), self.sizes[others], self.sizes[k])]
        return others


class Holders:
    """Which sets of a large task have a prefix token of the first order, 16 bits of it."""

    def __init__(self, index: Index, first: int, last: int):
        values, bounds = index.prefixes[0]
        own = values[bounds[first] : bounds[last]]
        by = np.argsort(own, kind="stable")
        self.holders = np.repeat(np.arange(first, last), np.diff(bounds[first : last + 1]))[by]
        self.ends = np.searchsorted(own[by], np.arange((1 << 16) + 1))
        self.index, self.seen, self.first = index, np.zeros(last - first, dtype=bool), first

    def of(self, k: int) -> np.ndarray:
        values, bounds = self.index.prefixes[0]
        self.seen[:] = False
        for t in values[bounds[k] : bounds[k + 1]].tolist():
            self.seen[self.holders[self.ends[t] : self.ends[t + 1]] - self.first] = True
        return np.flatnonzero(self.seen) + self.first


def _others(index: Index, first: int, last: int, side: np.ndarray | None, apart: int | None = None):
    """For each set of a task those behind it that may pass; with ``side``, only those of the other side, with
    ``apart``, only those whose fingerprints differ in more bits."""
    holders = Holders(index, first, last) if last - first > 100 else None
    for k in range(first, last - 1):
        others = np.arange(k + 1, last) if holders is None else holders.of(k)
        others = others[others > k]
        if apart is not None:
            others = others[np.bitwise_count(index.also[others] ^ index.also[k]) > apart]
        yield k, others if side is None else others[side[others] != side[k]]


def hopeful(index: Index, first: int, last: int, side: np.ndarray | None = None, apart: int | None = None) -> np.ndarray:
    """Which sets of a task pass every filter with another one."""
    found = np.zeros(last, dtype=bool)
    for k, others in _others(index, first, last, side, apart):
        others = index.candidates(k, others[~found[others]] if found[k] else others)
        found[others] = True
        found[k] |= len(others) > 0
    return found[first:]


def forest(index: Index, first: int, last: int, side: np.ndarray | None = None, apart: int | None = None) -> np.ndarray:
    """For each set of a task the first one of its component over the links; with ``side``, over those between the sides."""
    label = np.arange(last)
    for k, others in _others(index, first, last, side, apart):
        found = np.unique(label[index.partners(k, others[label[others] != label[k]])])
        if len(found):
            label[np.isin(label, found) | (label == label[k])] = min(label[k], found[0])
    return label[first:]


TASK = ["leader", "u", "v"]
PROPOSED = 1 << 30  # parts of proposed groups are numbered from here on
AT_ONCE = 8 << 20  # bytes


def _by_task(rows: DataFrame, fn, schema: str) -> DataFrame:
    """``fn`` of tables that hold the rows of whole (leader, u, v), ``AT_ONCE`` bytes or a little more at a time, in order
    of node within each."""

    def ordered(held: list) -> pa.Table:
        return pa.Table.from_batches(held).sort_by([(x, "ascending") for x in (*TASK, "node")]).combine_chunks()

    def run(batches):
        held, last, count = [], None, 0
        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy() for k in range(3)])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                key = tuple(keys[:, a].tolist())
                if count >= AT_ONCE and key != last:
                    yield fn(ordered(held))
                    held, count = [], 0
                held.append(batch.slice(a, b - a))
                last, count = key, count + held[-1].nbytes
        if held:
            yield fn(ordered(held))

    return rows.repartition(*TASK).sortWithinPartitions(*TASK).mapInArrow(run, schema)


def _tasks(rows: pa.Table, within: int | None = None):
    """Where each task of a table begins and ends, which rows are of its first side if it has two, and ``within``
    unless its group was proposed."""
    leader, u, v, own = (rows.column(x).to_numpy() for x in (*TASK, "own"))
    cuts = np.flatnonzero((leader[1:] != leader[:-1]) | (u[1:] != u[:-1]) | (v[1:] != v[:-1])) + 1
    for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), len(leader)], strict=True):
        yield first, last, None if u[first] == v[first] else own == u, None if u[first] >= PROPOSED else within


def _also(rows: pa.Table) -> np.ndarray | None:
    return rows.column("also").to_numpy().view(U) if "also" in rows.column_names else None  # bits are counted of unsigned numbers


def _hopeful(tasks: DataFrame, rule: Rule, within: int | None = None) -> DataFrame:
    extra = [] if within is None else ["also"]

    def run(rows: pa.Table) -> pa.RecordBatch:
        prefixes = [flat(rows.column(x).combine_chunks()) for x in NAMES]
        index = Index(rule, rows.column("n").to_numpy(), [(x, offsets(s)) for x, s in prefixes], also=_also(rows))
        found = np.concatenate([hopeful(index, *task) for task in _tasks(rows, within)])
        kept = rows.select([*TASK, "own", "node", *extra]).filter(pa.array(found))
        return kept.combine_chunks().to_batches()[0] if kept.num_rows else pa.RecordBatch.from_pylist([], kept.schema)

    schema = "leader long, u int, v int, own int, node long" + (", also long" if extra else "")
    return _by_task(tasks.select(*TASK, "own", "node", "n", *NAMES, *extra), run, schema)


def _forests(tasks: DataFrame, orders: Orders, within: int | None = None) -> DataFrame:
    """``a``, ``b``: what connects the sets that link within each task."""
    sent, extra = tasks.sparkSession.sparkContext.broadcast(orders), [] if within is None else ["also"]

    def run(rows: pa.Table) -> pa.RecordBatch:
        node, (tokens, sizes) = rows.column("node").to_numpy(), flat(rows.column("tokens").combine_chunks())
        index = Index(sent.value.rule, sizes, sent.value.prefixes(tokens, sizes), tokens, _also(rows))
        label = np.concatenate([forest(index, *task) for task in _tasks(rows, within)])
        at = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([pa.array(node[at]), pa.array(node[label[at]])], names=["a", "b"])

    return _by_task(tasks.select(*TASK, "own", "node", "tokens", *extra), run, "a long, b long").distinct()


def _candidates(sets: DataFrame, rule: Rule, proposed: DataFrame | None, within: int | None = None) -> DataFrame:
    """The rows (leader, u, v, own, node) of sets that pass every filter with another one of their task."""
    some = sets.where(F.col("doc_id").isNotNull() & (F.col("n") >= rule.smallest()))
    tokens = some.select(F.explode(NAMES[0]).alias("token"), "node", "n")
    shared = tokens.groupBy("token").agg(F.min("node").alias("leader"), F.max("node").alias("last")).where("leader < last")
    shared = common.cut(shared.select("token", "leader"), "shared")
    held = Bitmap(shared.select("token")).thinned(tokens, "token")
    members = held.join(shared, "token").select("leader", F.lit(0).alias("base"), "node", "n")
    if proposed is not None:
        members = members.union(proposed.join(some.select("node", "n").distinct(), "node").select("leader", F.lit(PROPOSED).alias("base"), "node", "n"))
    members = common.cut(members.distinct(), "members")
    large = members.groupBy("leader", "base").agg(F.sum("n").alias("total")).where(F.col("total") > PART)
    large = large.select("leader", "base", F.ceil(F.col("total") / PART).cast("int").alias("parts"))
    dealt = members.join(large, ["leader", "base"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("own", F.col("base") + F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.col("base"), F.col("base") + F.col("parts") - 1)))
    dealt = dealt.select("leader", F.least("own", "other").alias("u"), F.greatest("own", "other").alias("v"), "own", "node")
    nodes = members.select("node").distinct()
    extra = [] if within is None else ["also"]
    prefixes = Bitmap(nodes).thinned(some.select("node", "n", *NAMES, *extra), "node")
    prefixes = prefixes.withColumn(NAMES[0], _low_bits(NAMES[0])).join(nodes, "node", "left_semi").dropDuplicates(["node"])
    return common.cut(_hopeful(dealt.join(prefixes, "node"), rule, within), "hopeful")


def _low_bits(name: str) -> Column:
    """The lowest 16 bits of an array's longs, as numpy takes them."""
    return F.expr(f"transform({name}, x -> cast(((x & 65535) ^ 32768) - 32768 AS short))")


def _whole(docs: DataFrame, sets: DataFrame, nodes: DataFrame, rule: Rule, seed: int) -> DataFrame:
    """``node``, ``tokens`` of ``nodes``, from the text of one document of each."""
    holders = sets.where("doc_id IS NOT NULL").select("doc_id", "node").join(nodes, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    sent = docs.sparkSession.sparkContext.broadcast(Bitmap(holders.select(F.xxhash64("doc_id").alias("h"))))

    def run(part, texts):
        kept = np.flatnonzero(sent.value.has(part.column(2).to_numpy())).tolist()
        if not kept:
            return None
        tokens, sizes = token_sets([texts[k] for k in kept], rule.words)
        return np.ascontiguousarray(digests(tokens, sizes, seed)[:, 0]), lists(tokens, offsets(sizes))

    rows = common.id_text(docs).where("doc_id IS NOT NULL").withColumn("h", F.xxhash64("doc_id"))
    return common.by_slice(rows, run, "node long, tokens array<long>", chars=SLICE).join(nodes, "node", "left_semi").dropDuplicates(["node"])


def components(docs: DataFrame, sets: DataFrame, orders: Orders, seed: int = 0, proposed: DataFrame | None = None, within: int | None = None) -> DataFrame:
    """``node``, ``root``: for every set that is not the smallest node of its component, the one that is.

    ``proposed`` (``leader``, ``node``) adds groups to those that common prefix tokens make. With ``within`` pairs
    whose fingerprints ``also`` differ in so many bits at most are left to the proposed groups, which must hold them all.
    """
    tasks = _candidates(sets, orders.rule, proposed, within)
    nodes = common.cut(tasks.select("node").distinct(), "nodes")
    whole = _whole(docs, sets, nodes, orders.rule, seed)
    return common.components(_forests(tasks.join(whole, "node"), orders, within), "components")


def distinct_sets(docs: DataFrame, orders: Orders, also: Callable[[np.ndarray], int] | None = None) -> tuple[DataFrame, int]:
    """The written rows of ``sets_of``, and a seed with which no two sets have one node."""
    for seed in range(8):
        sets = common.cut(sets_of(docs, orders, seed, also), "sets")
        proofs = sets.groupBy("node").agg(F.min("proof").alias("low"), F.max("proof").alias("high"))
        if proofs.where("low != high").isEmpty():
            return sets, seed
    raise RuntimeError("two sets share 64 bits of their digest under each of eight seeds")


def groups(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``: the smallest id reachable over links.

    Equal sets are one node, so copies cost nothing further. Null, empty and blank texts have an empty set
    and are linked with nothing: their component is their own id. Rows that repeat an id are each listed,
    with the smallest id their own set reaches. Rows without an id link nothing; they are listed with the
    component of their set, null if no row with an id has it or their set is empty. Very long texts are
    taken whole. An empty table gives no row.
    """
    orders = orders_of(docs, Rule(words))
    sets, seed = distinct_sets(docs, orders)
    of = common.cut(sets.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least_id")), "nodes")
    roots = components(docs, sets, orders, seed)
    placed = common.cut(of.join(roots, "node", "left").select("node", "least_id", F.coalesce("root", "node").alias("root")), "placed")
    least = placed.groupBy("root").agg(F.min("least_id").alias("component"))
    found = placed.join(least, "root").select("node", "component")
    out = sets.select("doc_id", "node", "n").join(found, "node", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"))
