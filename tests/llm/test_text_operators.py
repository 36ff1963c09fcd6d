"""Line store, byte removal, SimHash groups and decontamination against brute force."""

from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from editengine.llm import common, decontam, linededup, queries, simhash, suffixdedup
from editengine.session import shared_dir
from brute import SMALL


def small_docs(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]


# --- Lines ---

def test_lines_of_odd_rows(spark, odd, pairs):
    store = linededup.LineStore(spark, shared_dir(spark, "t"))
    store.insert(odd)
    out = store.apply(odd)
    assert out.columns == [c for c in odd.columns if c not in ("n_lines", "n_dropped")] + ["n_lines", "n_dropped"]
    got = Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"] or "") for r in out.collect())
    assert got == Counter(brute.line_rows(pairs))
    assert any(r[2] for r in got)


def test_lines_without_filters_sent(spark, odd, pairs, monkeypatch):
    monkeypatch.setattr(linededup, "FILTER_BYTES", 0)
    store = linededup.LineStore(spark, shared_dir(spark, "t"), shards=3)
    store.insert(odd)
    got = Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"] or "") for r in store.apply(odd).collect())
    assert got == Counter(brute.line_rows(pairs))


def test_line_store_is_reversible(spark):
    line = "one and the same line, long enough to be counted here"
    docs = spark.createDataFrame([(k, f"{k}\n{line}") for k in range(1, 9)], "doc_id long, text string")
    store = linededup.LineStore(spark, shared_dir(spark, "t"), shards=2)
    store.insert(docs.where("doc_id <= 4"))
    assert store.apply(docs.where("doc_id <= 4")).agg(F.sum("n_dropped")).first()[0] == 0
    store.insert(docs.where("doc_id > 4"))
    assert store.apply(docs).where("n_dropped = 1").count() == 7
    store.insert(docs.where("doc_id = 8"))  # again: nothing changes
    assert store.counts().first()["n_docs"] == 8
    store.delete(docs.where("doc_id IN (8, 1)").select("doc_id"))
    left = docs.where("doc_id BETWEEN 2 AND 7")
    assert [r[0] for r in store.apply(left).where("n_dropped = 0").select("doc_id").collect()] == [7]
    store.delete(docs.where("doc_id IN (2, 3)").select("doc_id"))
    assert store.apply(docs.where("doc_id BETWEEN 4 AND 7")).agg(F.sum("n_dropped")).first()[0] == 0
    blobs = [linededup.Cuckoo.from_bytes(r["filter"]) for r in store.filters().collect()]
    assert not any(b.slots.any() for b in blobs)  # what went below the threshold left the filters


@pytest.mark.parametrize("shards", [1, 500])
def test_lines_whatever_the_shards(spark, odd, pairs, shards):
    store = linededup.LineStore(spark, shared_dir(spark, "t"), shards=shards)
    store.insert(odd)
    got = Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"] or "") for r in store.apply(odd).collect())
    assert got == Counter(brute.line_rows(pairs))


def test_shards_follow_the_keys(spark, odd, pairs, monkeypatch):
    monkeypatch.setattr(linededup, "SHARD_KEYS", 1)
    monkeypatch.setattr(linededup, "SHARDS", 1)
    docs = spark.createDataFrame([(100 + k, f"a further line that many documents share, number {n}") for n in range(9) for k in range(6 * n, 6 * n + 6)], "doc_id long, text string")
    store = linededup.LineStore(spark, shared_dir(spark, "t"))
    store.insert(odd)
    before = store.shards
    store.insert(docs)
    assert before <= 9 < store.shards
    assert store.apply(docs).where("n_dropped = 0").count() == 9
    got = Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"] or "") for r in store.apply(odd).collect())
    assert got == Counter(brute.line_rows(pairs))


def test_lines_of_an_empty_table(spark, nothing):
    store = linededup.LineStore(spark, shared_dir(spark, "t"))
    store.insert(nothing)
    assert store.apply(nothing).count() == 0


def test_cuckoo_filter():
    keys = [brute.hashlib.sha256(str(k).encode()).digest() for k in range(3000)]
    held = linededup.Cuckoo.of(keys)
    assert held.contains(keys).all()
    others = [brute.hashlib.sha256(f"x{k}".encode()).digest() for k in range(3000)]
    assert held.contains(others).mean() < 0.01
    for k in keys[:1500]:
        held.delete(k)
    assert held.contains(keys[1500:]).all() and held.contains(keys[:1500]).mean() < 0.01
    with pytest.raises(KeyError):
        linededup.Cuckoo.sized(4).delete(keys[0])


def test_op2_over_the_small_table(spark):
    want = [(i, n, d, brute.sha(t.encode())) for i, n, d, t in brute.line_rows(small_docs(spark))]
    got = [tuple(r) for r in queries.op2_line_store(spark, SMALL).orderBy("doc_id").collect()]
    assert got == sorted(want)


# --- Byte strings ---

def removed(rows):
    return Counter((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["starts"]), brute.sha(bytes(r["kept"]))) for r in rows)


@pytest.mark.parametrize("chunk", [2000, 1 << 22])
def test_removed_bytes_of_odd_rows(spark, odd, pairs, monkeypatch, chunk):
    monkeypatch.setattr(suffixdedup, "CHUNK_BYTES", chunk)
    assert removed(suffixdedup.remove(odd).collect()) == Counter(brute.removed_rows(pairs))


def test_removed_bytes_where_copies_overlap_in_part(spark, monkeypatch):
    monkeypatch.setattr(suffixdedup, "CHUNK_BYTES", 1500)
    rng = np.random.default_rng(3)
    pool = "".join(map(chr, rng.integers(97, 101, 3000)))
    cuts = rng.integers(0, 2800, (120, 2))
    docs = [(int(k), "".join(pool[a : a + 40 + int(a) % 120] for a in row)) for k, row in enumerate(cuts)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    assert removed(suffixdedup.remove(df).collect()) == Counter(brute.removed_rows(docs))


def test_removed_bytes_of_an_empty_table(nothing):
    assert suffixdedup.remove(nothing).count() == 0


@pytest.mark.parametrize("length", [25, 50, 64, 100])
def test_refinement_tells_equal_strings_apart(length):
    rng = np.random.default_rng(length)
    part = rng.integers(97, 99, 200).astype(np.uint8)
    data = np.concatenate([part, rng.integers(97, 100, 300).astype(np.uint8), part, part[:120]])
    pointer, raw = suffixdedup.refine(data, length), data.tobytes()
    seen = {}
    for k in range(len(raw) - length + 1):
        assert seen.setdefault(raw[k : k + length], pointer[k]) == pointer[k]
    assert len(set(seen.values())) == len(seen)


def test_op3_over_the_small_table(spark):
    got = [tuple(r) for r in queries.op3_suffix_buckets(spark, SMALL).orderBy("doc_id").collect()]
    assert got == sorted(brute.removed_rows(small_docs(spark)))


# --- SimHash ---

def test_groups_of_odd_rows(odd, pairs):
    got = Counter(tuple(r) for r in simhash.groups(odd).collect() if r["doc_id"] is not None)
    assert got == Counter(brute.group_rows([p for p in pairs if p[0] is not None]))
    rest = [r for r in simhash.groups(odd).collect() if r["doc_id"] is None]
    assert len(rest) == 2 and {r["component_id"] for r in rest} == {5, 1}  # of the same text, of no text


def test_groups_of_an_empty_table(nothing):
    assert simhash.groups(nothing).count() == 0


@pytest.mark.parametrize("blocks,part", [(5, 4096), (6, 4096), (7, 4096), (5, 60)])
def test_trie_join_links_all_within_budget(spark, monkeypatch, blocks, part):
    monkeypatch.setattr(simhash, "PART", part)
    monkeypatch.setattr(simhash, "PAIRS", 500)
    rng = np.random.default_rng(blocks)
    base = rng.integers(0, 2**64, 12, dtype=np.uint64)
    values = [base]
    for _ in range(25):
        flips = np.zeros(12, dtype=np.uint64)
        for _ in range(rng.integers(1, 7)):
            flips ^= np.uint64(1) << rng.integers(0, 64, 12, dtype=np.uint64)
        values.append(base ^ flips)
    values = np.unique(np.concatenate(values))
    nodes = spark.createDataFrame([(k, int(v)) for k, v in enumerate(values.view(np.int64))], "node long, fingerprint long")
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[k] ^ values[k + 1 :]) <= 4) + k + 1:
            a, b = sorted((find(k), find(int(j))))
            root[b] = a
    found = {r["node"]: r["root"] for r in common.components(simhash.links(nodes, 4, blocks), "t").collect()}
    assert [found.get(k, k) for k in range(len(values))] == [find(k) for k in range(len(values))]


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(0, 60) if k != 30] + [(5, 5)], "a long, b long")
    got = {r["node"]: r["root"] for r in common.components(links, "t").collect()}
    assert got == {k: 0 if k <= 30 else 31 for k in range(61) if k not in (0, 31)}


def test_op10_over_the_small_table(spark):
    got = [tuple(r) for r in queries.op10_simhash_trie(spark, SMALL).orderBy("doc_id").collect()]
    assert got == sorted(brute.group_rows(small_docs(spark)))


# --- Decontamination ---

def test_matches_of_odd_rows(spark, odd, pairs):
    base = dict(pairs)[5].split()
    changed = [*base[:30], "quite", *base[31:90]]
    items = [(1, " ".join(base[10:70])), (2, " ".join(changed).upper()), (3, "x"), (4, None), (5, ""), (6, "no such words here at all, none"), (None, "x"), (7, " ".join(base[:4])), (1, " ".join(base[10:70])), (8, "a" * 400)]
    frame = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    rows = decontam.matches(odd, frame).collect()
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in rows}
    want = brute.matches(pairs, items)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    assert {2, 3, 7} <= {i for _, i in want} and min(want.values()) < 1
    kept = decontam.clean(odd, frame)
    assert kept.columns == odd.columns
    held = {d for d, _ in want}
    assert Counter(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == Counter(i for i, _ in pairs if i is not None and i not in held)


def test_matches_with_items_in_groups(spark, odd, pairs, monkeypatch):
    monkeypatch.setattr(decontam, "ITEM_BYTES", 100)
    base = dict(pairs)[5].split()
    items = [(k, " ".join(base[k : k + 20])) for k in range(0, 60, 7)]
    frame = spark.createDataFrame(items, "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontam.matches(odd, frame).collect()} == brute.matches(pairs, items).keys()


def test_matches_of_empty_tables(spark, nothing, odd):
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontam.matches(nothing, items).count() == 0 and decontam.matches(odd, items).count() == 0
    assert decontam.clean(odd, items).count() == odd.count()


def test_multi_index_finds_all_within_the_radius():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 2**64, 300, dtype=np.uint64)
    asked = values[:100] ^ (np.uint64(1) << rng.integers(0, 64, 100, dtype=np.uint64))
    for radius in (3, 10, 24):
        q, v = decontam.MultiIndex(values, radius).near(asked)
        want = np.argwhere(np.bitwise_count(asked[:, None] ^ values[None]) <= radius)
        assert sorted(zip(q.tolist(), v.tolist(), strict=True)) == [tuple(x) for x in want.tolist()]


def test_op5_over_the_small_table(spark):
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in queries.op5_window_simhash(spark, SMALL).collect()}
    docs = [(i, t) for i, t in small_docs(spark) if len(t) < 6000]
    short = {i for i, _ in docs}
    want = brute.matches(docs, items)
    assert {k for k in got if k[0] in short} == want.keys()
