"""Documents with fewer words than a benchmark item, compared as a whole."""

import random
from collections import Counter

import brute

from editengine.llm import decontam


def whole_matches(docs, items, least=0.8):
    """{(document, item): similarity} of whole documents that are shorter than the item."""
    edge = ".,;:!?\"'()[]{}*"
    norm = lambda text: [w.strip(edge) or w for w in brute.words(text)]
    shingles = lambda w: Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4)))
    out = {}
    for item, text in items:
        for doc, body in docs:
            own, target = norm(body), norm(text)
            if 0 < len(own) < len(target):
                likeness = sum((shingles(own) & shingles(target)).values()) / sum((shingles(own) | shingles(target)).values())
                if likeness >= least - 1e-12:
                    out[doc, item] = likeness
    return out


def test_documents_shorter_than_an_item(spark):
    rng = random.Random(6)
    vocabulary = [f"w{k}" for k in range(80)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(n))) for k, n in enumerate([3, 4, 5, 6, 9, 12, 20, 39, 39, 60, 120] * 2)]
    items.append((90, "again and again and again and again and again and again and again and again and again"))
    docs = []
    for _, text in items:
        own = text.split()
        for lost in range(1, 1 + len(own) // 4):
            at = rng.randint(0, lost)
            docs.append(" ".join(own[at : len(own) - lost + at]) + ".")
            middle = rng.randrange(len(own))
            docs.append(" ".join(own[:middle] + own[middle + lost :]))
    docs = list(enumerate(docs))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute.matches(docs, items)
    for pair, likeness in whole_matches(docs, items).items():
        want[pair] = max(likeness, want.get(pair, 0))
    rows = decontam.matches(frame, bench).collect()
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in rows}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    sizes = {k: len(t.split()) for k, t in docs}
    assert all(r["n_words"] <= sizes[r["doc_id"]] for r in rows) and len(want) > 100
    assert {r["doc_id"] for r in decontam.clean(frame, bench).collect()} == set(sizes) - {d for d, _ in want}


def test_an_item_without_its_last_word(spark):
    text = " ".join(f"x{k}" for k in range(39))
    docs = spark.createDataFrame([(1, text.rsplit(" ", 1)[0])], "doc_id long, text string")
    (row,) = decontam.matches(docs, spark.createDataFrame([(1, text)], "item_id long, text string")).collect()
    assert tuple(row) == (1, 1, 0, 38, 34 / 35, 1)
