"""The Jaccard join of word shingles against brute force."""

import random
from collections import Counter

import brute
import numpy as np
import pytest
from brute import SMALL

from editengine.llm import common, jaccardjoin, queries, wordhash


def want(rows):
    """(id, set size, smallest id reachable) of rows with an id."""
    def shingles(text):
        w = brute.words(text)
        return {tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))} if w else set()

    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    root = list(range(len(sets)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for k, (_, a) in enumerate(sets):
        for j in range(k):
            b = sets[j][1]
            if min(len(a), len(b)) * 100 >= 85 * max(len(a), len(b)) > 0:
                both = len(a & b)
                if 100 * both >= 85 * (len(a) + len(b) - both):
                    x, y = find(k), find(j)
                    root[x] = y
    least = {}
    for k, (i, _) in enumerate(sets):
        least[find(k)] = min(i, least.get(find(k), i))
    return Counter((i, len(s), least[find(k)]) for k, (i, s) in enumerate(sets))


def got(df):
    return Counter(tuple(r) for r in df.collect() if r["doc_id"] is not None)


def edited(rng, n_bases=6, copies=25, size=60):
    """Near copies of a few texts with one to twelve words changed, some of them in chains of edits."""
    rows = []
    for b in range(n_bases):
        words = [f"w{rng.randrange(40)}" for _ in range(size)]
        for _ in range(copies):
            own = list(words)
            for at in rng.sample(range(size), rng.randint(0, 3)):
                own[at] = f"x{rng.randrange(5)}"
            rows.append((len(rows), " ".join(own)))
            if rng.random() < 0.4:
                words[rng.randrange(size)] = f"y{rng.randrange(1000)}"
    return rows


def test_odd_rows(odd, pairs):
    out = jaccardjoin.groups(odd)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    assert got(out) == want(pairs)
    rest = Counter((r["n_shingles"], r["component_id"]) for r in out.collect() if r["doc_id"] is None)
    assert rest == Counter([(117, 5), (0, None)])


def test_empty_table(nothing):
    assert jaccardjoin.groups(nothing).count() == 0


def test_only_rows_without_sets(spark):
    docs = spark.createDataFrame([(1, None), (2, " "), (3, "a b"), (4, "A  b"), (None, "c d")], "doc_id long, text string")
    assert sorted((tuple(r) for r in jaccardjoin.groups(docs).collect()), key=str) == [(1, 0, 1), (2, 0, 2), (3, 1, 3), (4, 1, 3), (None, 1, None)]


@pytest.mark.parametrize("seed,frequent,sent,part", [(1, 16, 100_000, 10**6), (2, 2, 100_000, 700), (3, 2, 40, 10**6)])
def test_edited_copies_whatever_counts_as_frequent(spark, monkeypatch, seed, frequent, sent, part):
    monkeypatch.setattr(jaccardjoin, "FREQUENT", frequent)
    monkeypatch.setattr(jaccardjoin, "SENT", sent)
    monkeypatch.setattr(jaccardjoin, "PART", part)
    rows = edited(random.Random(seed))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    expected = want(rows)
    assert got(jaccardjoin.groups(docs)) == expected
    assert 6 <= len({c for _, _, c in expected}) < len(rows)


def test_sets_at_the_bound(spark):
    """Families of texts that lose or change a word, of sizes at which that is just enough or just too much."""
    rows = []
    for size in (4, 6, 7, 8, 9, 10, 13, 14, 20):
        words = [f"v{size}.{k}" for k in range(size)]
        texts = [words[k:] for k in range(4)] + [words[: size - 1] + ["end"], words + words]
        rows += [(len(rows) + k, " ".join(x)) for k, x in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(jaccardjoin.groups(docs)) == want(rows)


def test_prefixes_of_linked_sets_meet_under_every_order():
    rng, rule = np.random.default_rng(5), jaccardjoin.Rule()
    for _ in range(300):
        n = int(rng.integers(6, 80))
        a = np.unique(rng.integers(-(2**63), 2**63 - 1, n))
        b = np.unique(np.r_[a[rng.random(len(a)) > rng.random() * 0.15], rng.integers(-(2**63), 2**63 - 1, int(rng.integers(0, 4)))])
        both = len(np.intersect1d(a, b))
        if 100 * both < 85 * (len(a) + len(b) - both):
            continue
        sizes, tokens = np.array([len(a), len(b)]), np.r_[a, b]
        some = np.sort(rng.choice(a, len(a) // 2, replace=False))
        prefixes = jaccardjoin.Orders(some, rng.integers(4, 20, len(some)), rule).prefixes(tokens, sizes)
        for order, (values, bounds) in enumerate(prefixes):
            least = min(rule.more(sizes)) if order else 1
            assert len(set(values[: bounds[1]].tolist()) & set(values[bounds[1] :].tolist())) >= least
        index = jaccardjoin.Index(rule, sizes, prefixes, tokens)
        assert jaccardjoin.hopeful(index, 0, 2).all() and jaccardjoin.forest(index, 0, 2).tolist() == [0, 0]


def test_a_large_group_of_near_misses_leaves_few_rows(spark):
    """Texts that all share most tokens but rarely link: no pairs leave the tasks."""
    rng = random.Random(6)
    base = [f"w{k}" for k in range(200)]
    rows = []
    for k in range(600):
        own = list(base)
        for at in rng.sample(range(200), rng.choice([1, 4, 9])):
            own[at] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = got(jaccardjoin.groups(docs))
    assert out == want(rows) and 100 < len({c for _, _, c in out}) < 500


def test_two_sets_with_one_node_are_digested_anew(spark, monkeypatch):
    real, seeds = jaccardjoin.digests, set()

    def same_nodes(tokens, sizes, seed):
        seeds.add(seed)
        out = real(tokens, sizes, seed).copy()
        out[:, 0] = out[:, 0] if seed else 1
        return out

    monkeypatch.setattr(jaccardjoin, "digests", same_nodes)
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "f g h i j"), (3, "a b c d e")], "doc_id long, text string")
    assert sorted(tuple(r) for r in jaccardjoin.groups(docs).collect()) == [(1, 2, 1), (2, 2, 2), (3, 2, 1)]


def test_op11_over_the_small_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in common.table(spark, SMALL, "documents").collect()]
    assert got(queries.op11_prefix_orders(spark, SMALL)) == want(rows)


def test_words_and_tokens_of_texts():
    rng = random.Random(3)
    alphabet = ["a", "B", "é", "漢", ".", "(", " ", " ", "\t", "\n", "\x0b", "\x85", "\u00a0", "😀"]
    texts = ["", " ", "a", "x y", "one two three four", ".", "(.)", "(a)"] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(300)] + ["z" * 5000 + " end " * 3000]
    for piece in (wordhash.PIECE, 64):
        wordhash.PIECE, kept = piece, wordhash.PIECE
        try:
            for marks in (b"", b".("):
                hashes, bounds = wordhash.words(texts, marks)
                own = [[w.strip(marks.decode()) or w for w in brute.words(t)] for t in texts]
                assert np.diff(bounds).tolist() == [len(x) for x in own]
                known = {}
                for h, w in zip(hashes.tolist(), (w for x in own for w in x), strict=True):
                    assert known.setdefault(w, h) == h
                assert len(set(known.values())) == len(known)
            tokens, sizes = wordhash.token_sets(texts, 4)
            runs = [{tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))} if w else set() for w in map(brute.words, texts)]
            assert sizes.tolist() == [len(x) for x in runs]
            assert len(set(tokens.tolist())) == len(set().union(*runs))
        finally:
            wordhash.PIECE = kept
    assert [x.size for x in wordhash.token_sets([], 4)] == [0, 0]
