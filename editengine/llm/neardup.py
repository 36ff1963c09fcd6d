"""Near-duplicates for the pipeline: SimHash groups and prefix groups, verified by exact similarity.

The similarity of two texts is that of their sets of five-word shingles: the common ones over all. Two methods
share the pairs out. Those whose fingerprints lie within four bits, which copies with few edits do, come from the trie
walk of ``simhash`` alone. A similarity of 0.8 is about 10 differing bits with a deviation of 3, and no radius that
the walk can afford reaches so far, so pairs further apart come from the groups of ``jaccardjoin``, whose common
prefix tokens no pair of 0.8 or more lacks; there pairs within four bits are passed over. Both are verified alike, set
against set inside tasks, before anything becomes a link: no link is lost and none is a guess.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, jaccardjoin, simhash

WORDS, LEAST = 5, 80


def proposals(sets: DataFrame, errors: int = simhash.ERRORS) -> DataFrame:
    """``leader``, ``node``: the groups of at least two sets that the trie walk finds."""
    prints = common.cut(sets.where("doc_id IS NOT NULL AND n > 0").groupBy("also", "node").count().select(F.col("also").alias("fingerprint"), "node"), "fingerprints")
    first = common.cut(prints.groupBy("fingerprint").agg(F.min("node").alias("node")), "nodes")
    roots = common.components(simhash.links(first, errors), "components")
    of = first.join(roots, "node", "left").select("fingerprint", F.coalesce("root", "node").alias("leader"))
    placed = common.cut(prints.join(of, "fingerprint").select("leader", "node"), "placed")
    several = placed.groupBy("leader").count().where("count > 1").select("leader")
    return placed.join(several, "leader", "left_semi")


def mark(docs: DataFrame) -> Column:
    """A hash of a row's text, which tells rows of one id apart."""
    return F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without those near-duplicate to one with a smaller id; one row of each group stays.

    Rows are judged by id and text: an id that is repeated with two texts is judged for each of them. Of rows
    that repeat an id and its text one stays. Null, empty and blank texts have the same, empty set: the one
    with the smallest id stays. Rows without an id are not compared and stay. Very long texts are taken whole.
    """
    orders = jaccardjoin.orders_of(docs, jaccardjoin.Rule(WORDS, LEAST))
    sets, seed = jaccardjoin.distinct_sets(docs, orders, simhash.majority)
    roots = jaccardjoin.components(docs, sets, orders, seed, proposals(sets), simhash.ERRORS)
    own = sets.where("doc_id IS NOT NULL").select("doc_id", "mark", "node").join(roots, "node", "left")
    own = common.cut(own.select("doc_id", "mark", F.coalesce("root", "node").alias("root")), "placed")
    first = own.groupBy("root").agg(F.min(F.struct("doc_id", "mark")).alias("first"))
    lost = own.join(first, "root").where("struct(doc_id, mark) != first").select(F.col("doc_id").alias("lost_id"), F.col("mark").alias("lost_mark"))
    again = common.cut(own.groupBy("doc_id", "mark").count().where("count > 1").select(F.col("doc_id").alias("lost_id"), F.col("mark").alias("lost_mark")), "again")
    lost = common.cut(lost.union(again).distinct(), "lost")
    same = (docs["doc_id"].cast("long") == lost["lost_id"]) & (mark(docs) == lost["lost_mark"])
    kept = docs.join(lost, same, "left_anti")
    if again.isEmpty():
        return kept
    # Rows that repeat each other: one of those that no other row is before.
    before = own.join(first, "root").where("struct(doc_id, mark) = first").select(F.col("doc_id").alias("own_id"), F.col("mark").alias("own_mark")).distinct()
    ones = before.join(again, (F.col("own_id") == F.col("lost_id")) & (F.col("own_mark") == F.col("lost_mark")), "left_semi")
    ones = common.cut(ones, "ones")
    twice = docs.join(ones, (docs["doc_id"].cast("long") == ones["own_id"]) & (mark(docs) == ones["own_mark"]), "left_semi")
    return kept.unionByName(twice.dropDuplicates(["doc_id", "text"]))
