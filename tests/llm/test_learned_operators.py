"""Language, quality, language model, tokens, packing, search and the pipeline."""

import zlib
from collections import Counter, defaultdict
from math import log10

import brute
import numpy as np
import pytest
from brute import SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from editengine.llm import anngraph, common, hmm, langid, packing, quality, queries, simhash, tokens, tokenstore
from editengine.session import shared_dir

TENTH = "/root/testdata/sf0.01"


def truth(spark, folder, *columns, name="documents"):
    rows = spark.read.parquet(f"{folder}/{name}.parquet").select("doc_id", *columns).collect()
    return {r["doc_id"]: r[1:] for r in rows}


# --- Language ---

def test_op1_on_held_out_texts(spark):
    langs = truth(spark, TENTH, "lang")
    rows = queries.op1_subword_language(spark, TENTH).collect()
    assert len(rows) == len(langs)
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in langs if brute.crc_rest(i, 3) == 1}
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]][0] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows) and np.mean([r["accepted"] for r in rows]) > 0.99


def test_language_of_odd_rows(spark, odd, nothing):
    model = langid.fit(spark.read.parquet(f"{SMALL}/documents.parquet"))
    rows = langid.identify(odd, model).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    for k in (1, 2, 3):
        assert (by[k]["lang_pred"], by[k]["score"], by[k]["accepted"]) == ("und", 0.0, False)
    assert by[20]["lang_pred"] in ("en", "de", "fr", "es")
    kept = langid.accept(odd, model)
    assert kept.columns == odd.columns and kept.where("doc_id IN (1, 2, 3)").count() == 0
    assert langid.fit(nothing) is None and langid.identify(nothing, model).count() == 0
    assert {r["lang_pred"] for r in langid.identify(odd, None).collect()} == {"und"}
    assert langid.accept(odd, None).where("doc_id = 18").count() == 1


def test_foreign_script_is_not_accepted(spark):
    model = langid.fit(spark.read.parquet(f"{SMALL}/documents.parquet"))
    docs = spark.createDataFrame([(1, "漢字仮名交じり文" * 30), (2, "12345 67 !!")], "doc_id long, text string")
    assert not any(r["accepted"] for r in langid.identify(docs, model).collect())


# --- Quality ---

def test_op6_on_held_out_texts(spark):
    labels = truth(spark, TENTH, "quality", name="labels")
    rows = queries.op6_rule_ensemble(spark, TENTH).collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = [(r["score"], labels[r["doc_id"]][0]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    high, low = (np.array([s for s, q in held if q == k]) for k in (1, 0))
    assert (high[:, None] > low[None]).mean() > 0.95
    assert {r["doc_id"] for r in rows if r["held_out"]} == {i for i in range(1000) if brute.crc_rest(i, 5) == 0}


def test_quality_of_odd_rows(spark, odd, nothing):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, len(quality.STATS)))
    y = ((x[:, 1] > 0.2) & (x[:, 3] <= 0.5)).astype(float)
    model = quality.train(x, y)
    assert 0 < len(model.rules) and ((model.score(x) > 0.5) == y).mean() > 0.95
    rows = quality.score(odd, model).collect()
    assert len(rows) == odd.count()
    stats = np.array([[r[s] for s in quality.STATS] for r in rows])
    assert np.isfinite(stats).all() and np.allclose(model.score(stats), [r["score"] for r in rows])  # the column is the model
    assert not stats[[r["doc_id"] in (1, 2) for r in rows]].any()
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, None), (None, 1, 1), (6, None, 0)], "doc_id long, quality int, toxic int")
    few = quality.fit(odd, labels)
    assert not few.rules and quality.score(odd, few).count() == odd.count()
    assert quality.score(nothing, quality.fit(nothing, labels)).count() == 0


# --- Tokens ---

ODD_TEXTS = [
    "", " ", "\n", "a", "a b", "a  b", "a   b", "a\nb", "a\n\nb", "a \n b", "\na", "a\n", " a", "Abc, def. Ghi.\nJkl,\nm", "don't. we'll, it's",
    "12.5, 3,000. x_. y-, z!. q.. r.,", "tab\tin\tit", "x\x1cy\x85z a b　c", "Straße Ñandú été. ÀÉ, ÿ Ÿ", "é ́ É", "<|endoftext|> a <|endoftext|>b", "漢字 仮名. かな", "😀 a😀. b",
    "x" * 300 + " " + "y" * 41 + ".", "\0 a \0. b", "ΣΑΣ ΑΣ. ΑΣ, ΑΣ", "İ ı ǅ", "é ñ\xa0x\u2003y z. b.\n\n\nc", "a\tb  c", "a.b.c d,e", "end.",
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_is_the_tokenizer(name, spark, monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_ENTRIES", 2000)
    encoder = tokens.Encoder(name)
    assert encoder.form
    texts = ODD_TEXTS + [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    fresh = Tokenizer.from_file(tokens.tokenizer_path(name))
    want = [np.array(x.ids, dtype="<u4").tobytes() for x in fresh.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        assert [x for k in range(0, len(texts), 37) for x in encoder.encode(texts[k : k + 37])] == want


@pytest.mark.parametrize("unit", ["byte", "bit"])
def test_planes_round_trip(unit):
    for ids in (np.array([], dtype="<u4"), np.array([0, 1, 2**32 - 1, 50_000], dtype="<u4"), np.random.default_rng(0).integers(0, 2**32, 1001).astype("<u4")):
        planes = tokenstore.to_planes(ids, unit)
        assert len(planes) == (4 if unit == "byte" else 32)
        assert (tokenstore.from_planes(planes, len(ids), unit) == ids).all()


def encoded(name, pairs):
    encoder = Tokenizer.from_file(tokens.tokenizer_path(name))
    return [(i, np.array([*encoder.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4").tobytes()) for i, t in pairs]


@pytest.mark.parametrize("unit", ["byte", "bit"])
def test_store_of_odd_rows(spark, odd, pairs, nothing, monkeypatch, unit):
    monkeypatch.setattr(tokenstore, "SEGMENT_IDS", 500)
    monkeypatch.setattr(tokenstore, "BLOCK_IDS", 128)
    path = shared_dir(spark, "t")
    tokenstore.write(odd, path, unit=unit)
    rows = tokenstore.read(spark, path).orderBy("start").collect()
    assert Counter((r["doc_id"], bytes(r["ids"])) for r in rows) == Counter(encoded("word_bpe_49k.json", pairs))
    ids = [r["doc_id"] for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert [r["start"] for r in rows] == np.cumsum([0, *(r["n_tokens"] for r in rows)])[:-1].tolist()
    assert all(r["ids_crc32"] == zlib.crc32(r["ids"]) and len(r["ids"]) == 4 * r["n_tokens"] for r in rows)
    empty = shared_dir(spark, "t")
    tokenstore.write(nothing, empty)
    assert tokenstore.read(spark, empty).count() == 0
    with pytest.raises(ValueError):
        tokenstore.write(odd, path, unit="word")


# --- Packing ---

def check_packed(rows, capacity=1024):
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in places.values():
        own.sort()
        assert [o for o, _ in own] == np.cumsum([0, *(n for _, n in own)])[:-1].tolist() and sum(own[-1]) <= capacity
    return len(places)


SPECIAL = ["<|endoftext|> a <|endoftext|>b", "x <|startoftext|>y. z", "<|endoftext|>", "no <|end of|> it", "a b <|endoftext|>" * 700]


@pytest.fixture
def with_special(spark, tmp_path):
    """A folder of documents that hold the tokenizers' special strings, among those of the small table."""
    rows = [(r["doc_id"], r["text"]) for r in common.table(spark, SMALL, "documents").collect()] + [(1000 + k, t) for k, t in enumerate(SPECIAL)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path), rows


def test_op7_is_the_tokenizer_library(spark, with_special):
    folder, rows = with_special
    want, start = [], 0
    for i, ids in sorted(encoded("word_bpe_49k.json", rows)):
        want.append((i, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    assert [tuple(r) for r in queries.op7_token_planes(spark, folder).orderBy("doc_id").collect()] == want


def test_op9_is_the_tokenizer_library(spark, with_special):
    folder, rows = with_special
    out = queries.op9_best_fit_packing(spark, folder).collect()
    check_packed(out)
    by = defaultdict(list)
    for r in sorted(out, key=lambda r: r["piece"]):
        by[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for i, ids in encoded("byte_bpe_50k.json", rows):
        total = len(ids) // 4
        starts = [0] if total <= 1024 else [0, *range(total % 1024 or 1024, total, 1024)]
        assert by.pop(i) == [(k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(starts, [*starts[1:], total], strict=True))]
    assert not by


def test_packing_of_odd_rows(odd, pairs, nothing):
    rows = packing.pack(odd).collect()
    check_packed(rows)
    by = defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    want = Counter(encoded("byte_bpe_50k.json", pairs))
    for (i, ids), n in want.items():
        total = len(ids) // 4
        starts = [0] if total <= 1024 else [0, *range(total % 1024 or 1024, total, 1024)]
        for piece, (a, b) in enumerate(zip(starts, [*starts[1:], total], strict=True)):
            own = ids[4 * a : 4 * b]
            same = [r for r in by[i] if (r["piece"], r["start"], r["length"], r["ids_crc32"]) == (piece, a, b - a, zlib.crc32(own)) and bytes(r["ids"]) == own]
            assert len(same) == n
    assert len(rows) == sum(max(1, -(-len(ids) // 4096)) * n for (_, ids), n in want.items())
    assert packing.pack(nothing).count() == 0


def best_fit(lengths, capacity):
    """Sequences that best fit, longest first, fills one piece at a time."""
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, r in enumerate(room) if r >= n]
        if fits:
            room[min(fits, key=lambda k: room[k])] -= n
        else:
            room.append(capacity - n)
    return len(room)


@pytest.mark.parametrize("seed", range(8))
def test_plan_is_best_fit(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, [17, 65, 129][seed % 3], rng.integers(1, 400)).tolist() + [64] * int(rng.integers(0, 50))
    capacity = 128
    slots = packing.plan(Counter(lengths), capacity)
    seen, filled = Counter(), defaultdict(list)
    for length, rank, n, first, offset in sorted(slots):
        assert seen[length] == rank
        seen[length] += n
        for k in range(n):
            filled[first + k].append((offset, length))
    assert seen == Counter(lengths) and len(filled) == best_fit(lengths, capacity)
    for own in filled.values():
        own.sort()
        assert [o for o, _ in own] == np.cumsum([0, *(n for _, n in own)])[:-1].tolist() and sum(own[-1]) <= capacity


# --- Language model ---

def paths_score(model, classes):
    """Likelihood by the plain recursion, unscaled."""
    now = model.start * model.emit[classes[0]]
    for c in classes[1:]:
        now = (now @ model.move) * model.emit[c]
    return log10(now.sum())


def test_forward_and_expected_counts():
    rng = np.random.default_rng(1)
    frequency = rng.integers(1, 9, 12).astype(float)
    model = hmm.Model.guess(frequency, 3, 5)
    assert np.allclose(model.emit.sum(axis=0), 1) and np.allclose(model.move.sum(axis=1), 1) and np.isclose(model.start.sum(), 1)
    lengths = np.array([4, 1, 9, 4, 30, 1])
    classes = rng.integers(0, 12, lengths.sum()).astype(np.uint32)
    chunk = hmm.Chunk(lengths, classes)
    _, scale, _ = chunk.forward(model.start, model.move, model.emit)
    ends = np.cumsum([0, *lengths])
    own = [classes[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    assert np.allclose(chunk.log10(scale), [paths_score(model, c) for c in own])
    starts, moves, emits, total = chunk.expect(model.start, model.move, model.emit)
    assert np.isclose(starts.sum(), 6) and np.isclose(moves.sum(), lengths.sum() - 6) and np.allclose(emits.sum(axis=1), np.bincount(classes, minlength=12))
    assert np.isclose(total, sum(paths_score(model, c) for c in own))
    # Expected moves are the derivative of the log likelihood by the log of each move.
    for i, j in ((0, 1), (2, 2)):
        more = model.move.copy()
        more[i, j] *= 1 + 1e-6
        moved = hmm.Model(model.start, more, model.emit)
        slope = (sum(paths_score(moved, c) for c in own) - total) * np.log(10) / np.log1p(1e-6)
        assert np.isclose(moves[i, j], slope, rtol=1e-3)


def test_rounds_raise_the_likelihood(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    totals = [hmm.score(docs, F.lit(True), rounds=k).agg(F.sum("score")).first()[0] for k in (1, 2, 4)]
    assert totals[0] < totals[1] < totals[2]


def test_op8_over_the_small_table(spark):
    docs = truth(spark, SMALL, "text")
    own = {i: [*brute.words(t), None] for i, (t,) in docs.items()}
    counts = Counter(w for i, x in own.items() if brute.crc_rest(i, 5) != 1 for w in x)
    n, v = sum(counts.values()), len(counts)
    rows = queries.op8_hidden_markov(spark, SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        x = own[r["doc_id"]]
        base = sum(log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in x)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (brute.crc_rest(r["doc_id"], 5) == 1, len(x), sum(w in counts for w in x), n)
        assert abs(r["base_score"] - base) < 1e-6 and r["score"] < 0
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_scores_of_odd_rows(spark, odd, nothing, monkeypatch):
    monkeypatch.setattr(hmm, "CHUNK_TOKENS", 50)
    rows = hmm.score(odd, F.col("doc_id") != 5, classes=64, rounds=2).collect()
    assert len(rows) == odd.count() and all(np.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    assert {r["train"] for r in rows if r["doc_id"] is None} == {False}  # a null flag
    assert hmm.score(nothing, F.lit(True), rounds=1).count() == 0
    untrained = hmm.score(odd, F.lit(False), rounds=1).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and np.isfinite(r["score"]) for r in untrained)


def test_chunks_do_not_change_counts(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    fields = ("doc_id", "n_tokens", "n_known", "train_tokens")
    whole = {tuple(r[f] for f in fields): r["base_score"] for r in hmm.score(docs, F.lit(True), rounds=1).collect()}
    monkeypatch.setattr(hmm, "CHUNK_TOKENS", 3000)
    monkeypatch.setattr(hmm, "BUCKET_WORDS", 500)
    parts = {tuple(r[f] for f in fields): r["base_score"] for r in hmm.score(docs.repartition(3), F.lit(True), rounds=1).collect()}
    assert parts.keys() == whole.keys() and all(abs(parts[k] - whole[k]) < 1e-6 for k in whole)


# --- Search ---

def nearest(rows, queries_, k=10):
    """{query: [(vec_id, distance)]} by brute force."""
    out = {}
    for q, x in queries_:
        far = sorted((float(np.sqrt(((np.array(x) - np.array(y)) ** 2).sum())), i) for i, y in rows if i != q and len(y) == len(x))
        out[q] = far[:k]
    return out


def test_op4_recall(spark):
    rows = [(r["vec_id"], [float(v) for v in r["embedding"]]) for r in spark.read.parquet(f"{TENTH}/embeddings.parquet").collect()]
    want = nearest(rows, [r for r in rows if r[0] % 100 == 0])
    got = defaultdict(dict)
    for r in queries.op4_pruned_graph(spark, TENTH).collect():
        got[r["query_id"]][r["rank"]] = (r["score"], r["vec_id"])
    assert got.keys() == want.keys() and all(sorted(x) == list(range(1, 11)) and [x[k] for k in sorted(x)] == sorted(x.values()) for x in got.values())
    assert np.mean([len({i for _, i in got[q].values()} & {i for _, i in want[q]}) / 10 for q in want]) >= 0.9


def test_recall_over_several_shards(spark, monkeypatch):
    monkeypatch.setattr(anngraph, "BLOCK", 16)
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(12, 24))
    points = (centres[rng.integers(0, 12, 3000)] + 0.4 * rng.normal(size=(3000, 24))).tolist()
    rows = list(enumerate(points))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    made = anngraph.index(anngraph.usable(frame), shard_rows=800)
    assert made.count() == 4
    monkeypatch.setattr(anngraph, "SHARD_ROWS", 800)
    asked = rows[::60]
    want = nearest(rows, asked)
    got = defaultdict(set)
    for r in anngraph.search(frame, frame.where("vec_id % 60 = 0")).collect():
        got[r["query_id"]].add(r["vec_id"])
    assert np.mean([len(got[q] & {i for _, i in want[q]}) / 10 for q in want]) >= 0.9


def test_search_of_odd_vectors(spark):
    ok = [(k, [float(k % 3), 1.0]) for k in range(40)] + [(100, [0.0, 1.0]), (200, [1.0, 1.0, 1.0]), (201, [1.0, 1.0, 2.0]), (7, [9.0, 9.0])]
    bad = [(300, None), (301, [0.0, 0.0]), (302, [None, 1.0]), (303, [float("nan"), 1.0]), (304, [float("inf"), 1.0]), (305, []), (None, [1.0, 1.0]), (0, [0.0, 1.0])]
    frame = spark.createDataFrame(ok + bad, "vec_id long, embedding array<double>").withColumns({c: F.lit("clash") for c in ("dim", "shard", "block", "rank")})
    rows = anngraph.search(frame, frame.where("vec_id % 100 = 0")).collect()
    want = nearest(ok, [r for r in ok if r[0] % 100 == 0])
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["score"], r["vec_id"]))
    assert got == want
    assert anngraph.search(frame.limit(0), frame.limit(0)).count() == 0


# --- Pipeline ---

def test_stages_against_brute_force(spark):
    docs = common.table(spark, SMALL, "documents")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, common.cut(stage(spark, docs, SMALL), "stage")
        kept[name] = docs
        if name != "best-fit packing":
            assert docs.columns == columns
        source = [(r["doc_id"], r["text"]) for r in before.orderBy("doc_id").collect()]
        if name == "language ID":
            assert {r["doc_id"] for r in docs.collect()} == {i for i, t in source if any(c.isalpha() for c in t or "")}
        elif name == "line dedup":
            assert [(r["doc_id"], r["text"], r["n_chars"]) for r in docs.orderBy("doc_id").collect()] == [(i, t, len(t)) for i, _, _, t in brute.line_rows(source)]
        elif name == "SimHash near-dedup":
            assert [r["doc_id"] for r in docs.orderBy("doc_id").collect()] == [i for i, c in brute.alike_rows(source).items() if i == c]
        elif name == "benchmark decontamination":
            items = [tuple(r) for r in common.table(spark, SMALL, "benchmark").select("item_id", "text").collect()]
            gone = {i for i, _ in source} - {r["doc_id"] for r in docs.collect()}
            short = [(i, t) for i, t in source if len(t) < 6000]
            assert gone & {i for i, _ in short} == {i for i, _ in brute.matches(short, items)}
        else:
            rows = docs.collect()
            check_packed(rows)
            joined = {i: b"".join(bytes(r["ids"]) for r in sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["piece"])) for i, _ in source}
            assert joined == dict(encoded("byte_bpe_50k.json", source))
    final = Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, SMALL).collect())
    assert final == Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in kept["best-fit packing"].collect())


def test_stages_of_odd_and_empty_tables(spark, odd, nothing):
    for docs in (odd, nothing):
        names = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = common.cut(stage(spark, docs, SMALL), "stage")
            if name != "best-fit packing":
                assert docs.columns == names
    assert docs.count() == 0


def test_groups_keep_documents_without_ids(spark, odd):
    kept = corpus_pipeline.near_duplicates(spark, odd, SMALL)
    assert kept.where("doc_id IS NULL").count() == 2 and kept.columns == odd.columns
    rows = sorted(((r["doc_id"], r["text"]) for r in odd.where("doc_id IS NOT NULL").collect()), key=lambda r: (r[0], r[1] or ""))
    stays = [rows[k][0] for k, c in brute.alike_rows([(k, t) for k, (_, t) in enumerate(rows)]).items() if k == c]  # by row: ids repeat
    assert sorted(r["doc_id"] for r in kept.where("doc_id IS NOT NULL").collect()) == stays  # also of rows that repeat each other one stays
    assert simhash.fingerprint("") == 0
