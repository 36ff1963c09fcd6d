"""The pipeline's near-duplicate stage: recall on edited copies, and rows that repeat an id."""

import random

import brute
from brute import SMALL

import corpus_pipeline
from editengine.llm import jaccardjoin, neardup, simhash


def shingles(text):
    w = brute.words(text)
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_edited_copies_go(spark):
    rng = random.Random(4)
    texts = [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()]
    texts = [t for t in texts if 60 <= len(brute.words(t)) <= 2000]
    rows = []
    for k, text in enumerate(texts):
        words = text.split()
        for at in rng.sample(range(len(words)), max(1, round(len(words) * rng.uniform(0.005, 0.03)))):
            words[at] = f"w{rng.randrange(10**6)}"
        rows += [(k, text), (1000 + k, " ".join(words))]
    rows += [(5000, "too few words"), (5001, "too  FEW words "), (5002, "too few word")]
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(4), SMALL).collect()}
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[k + 1 :]:
            if find(i) != find(j) and jaccard(a, b) >= 0.8:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    assert kept == {i for i in root if find(i) == i}
    assert sum(find(1000 + k) != 1000 + k for k in range(len(texts))) > 50 and {5000, 5002} <= kept


def test_an_id_repeated_with_two_texts_keeps_the_unique_one(spark):
    one, two = (" ".join(f"{x}{k}" for k in range(80)) for x in "ab")
    docs = spark.createDataFrame([(1, one), (2, one), (2, two), (3, two + " end")], "doc_id long, text string")
    assert sorted(tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs, SMALL).collect()) == [(1, one), (2, two)]


def test_rows_that_repeat_an_id_and_its_text(spark):
    one, two = (" ".join(f"{x}{k}" for k in range(80)) for x in "ab")
    docs = spark.createDataFrame([(1, one), (1, one), (2, one), (2, one), (3, two), (3, two), (4, None), (4, None), (5, "")], "doc_id long, text string")
    got = corpus_pipeline.near_duplicates(spark, docs, SMALL).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == [(1, one), (3, two), (4, None)]


def test_the_trie_walk_proposes_copies_with_few_edits(spark):
    """Of texts with a word or two changed most groups come from the walk, none from texts that share little."""
    rng = random.Random(8)
    rows = []
    for k in range(10):
        words = [f"{k}w{rng.randrange(10**6)}" for _ in range(400)]
        for _ in range(4):
            rows.append((len(rows), " ".join(words)))
            words[rng.randrange(400)] = "other"
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    orders = jaccardjoin.orders_of(docs, jaccardjoin.Rule(neardup.WORDS, neardup.LEAST))
    sets, _ = jaccardjoin.distinct_sets(docs, orders, simhash.majority)
    of = {r["node"]: r["doc_id"] // 4 for r in sets.collect()}
    found = [(r["leader"], r["node"]) for r in neardup.proposals(sets).collect()]
    assert len(found) > 20 and all(of[a] == of[b] for a, b in found)


def test_a_chain_of_edits_is_one_group(spark):
    """Most texts of the chain are not similar to the first one."""
    words = [f"x{k}" for k in range(200)]
    rows = []
    for k in range(12):
        rows.append((k, " ".join(words)))
        words[10 * k : 10 * k + 8] = [f"y{k}.{j}" for j in range(8)]
    assert jaccard(*(shingles(rows[k][1]) for k in (0, 1))) >= 0.8 > jaccard(*(shingles(rows[k][1]) for k in (0, 5)))
    docs = spark.createDataFrame(rows + [(50, "of its own")], "doc_id long, text string")
    assert [r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, SMALL).orderBy("doc_id").collect()] == [0, 50]


def test_pairs_within_four_bits_come_from_the_walk(spark, monkeypatch):
    """Without the walk's groups its pairs stay unlinked; pairs further apart are found all the same."""
    rng = random.Random(8)
    rows = []
    for k in range(12):
        words = [f"{k}w{rng.randrange(10**6)}" for _ in range(400)]
        rows.append((2 * k, " ".join(words)))
        for at in [200] if k < 8 else range(20, 180, 30):
            words[at] = "other"
        rows.append((2 * k + 1, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    orders = jaccardjoin.orders_of(docs, jaccardjoin.Rule(neardup.WORDS, neardup.LEAST))
    sets, _ = jaccardjoin.distinct_sets(docs, orders, simhash.majority)
    prints = {r["doc_id"]: r["also"] % 2**64 for r in sets.select("doc_id", "also").collect()}
    close = {2 * k + 1 for k in range(12) if (prints[2 * k] ^ prints[2 * k + 1]).bit_count() <= simhash.ERRORS}
    assert len(close) >= 4 and any(2 * k + 1 not in close for k in range(12))
    kept = lambda: {r["doc_id"] for r in neardup.keep_first(docs).collect()}
    firsts = {2 * k for k in range(12)}
    assert kept() == firsts
    proposed = neardup.proposals
    monkeypatch.setattr(neardup, "proposals", lambda sets: proposed(sets).limit(0))
    assert kept() == firsts | close
