"""Spelling variants against brute force."""

import re
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from brute import SMALL

from editengine.llm import common, queries, spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) < len(b):
        a, b = b, a
    return any(a[:k] + a[k + 1 :] == b for k in range(len(a)))


def want(rows):
    counts = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            word = run.translate(brute.LOWER)
            h = zlib.crc32(f"{i}:{word}".encode())
            if i is not None and h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    # Near words have a string in common when each loses at most one code point.
    groups = defaultdict(set)
    for w in words:
        for key in {w, *(w[:k] + w[k + 1 :] for k in range(len(w)))}:
            groups[key].add(w)
    beside = defaultdict(set)
    for own in groups.values():
        for a in own:
            beside[a] |= {b for b in own if b not in beside[a] and near(a, b)}
    form = {}
    for w, n in words.items():
        best = min(beside[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = []
    for w, n in words.items():
        end = w
        while form[end]:
            end = form[end]
        out.append((w, n, len(beside[w]), form[w], words.get(form[w]), end))
    return Counter(out)


COLUMNS = ["word", "n", "n_near", "form", "form_n", "root"]


def got(df):
    return Counter(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_odd_rows(odd, pairs):
    out = got(spelling.variants(odd))
    assert out == want(pairs) and sum(out.values()) > 20


def test_empty_table_and_no_words(spark, nothing):
    assert spelling.variants(nothing).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, None), (2, "a bc 123")], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("pass_words,places", [(8 << 20, 16_384), (50, 100)])
def test_chains_ties_and_marks(spark, monkeypatch, pass_words, places):
    """Forms of forms, ties between forms, equal letters in a row, letters beyond ASCII, and long runs, in one
    pass and in several."""
    monkeypatch.setattr(spelling, "PASS_WORDS", pass_words)
    monkeypatch.setattr(spelling, "PLACES", places)
    base = ["abcdefg", "abcdefgh", "abcdefghi", "zabcdefgh", "étéoooo", "×÷÷aaaa", "aaaaaaa", "aaaaaaaa", "q" * 300, "q" * 299 + "r", "q" * 70, "q" * 71]
    words = [(base[0], 300), (base[1], 25), (base[2], 2), (base[3], 2), (base[4], 40), ("Étéoooo", 3), ("ètéoooo", 40), ("êtéoooo", 4), (base[5], 20), ("×÷aaaa", 3), ("×÷÷aaaab", 2)]
    words += [(w, 2 + 30 * (k % 2)) for k, w in enumerate(base[6:])]
    rows, k = [], 0
    for w, n in words:
        for _ in range(n):
            rows.append((k, f"<{w.upper() if k % 2 and w.isascii() else w}>, x"))
            k += 1
    out = got(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)))
    assert out == want(rows)
    assert any(root != form and form for _, _, _, form, _, root in out)


def test_filters_hold_all_words_and_few_others():
    rng = np.random.default_rng(2)
    words = sorted({"".join(map(chr, rng.integers(97, 123, rng.integers(7, 70)))) for _ in range(5000)})
    varied = spelling.Varied(words)
    blooms = spelling.Blooms(Counter(map(len, words)))
    block, bits = blooms.slots(varied.hashes(), varied.lengths)
    np.bitwise_or.at(blooms.bits, block, bits)
    assert blooms.may_hold(varied.hashes(), varied.lengths).all()
    others = spelling.Varied(["".join(map(chr, rng.integers(97, 123, 9))) for _ in range(20_000)])
    assert blooms.may_hold(others.hashes(), others.lengths).mean() < 0.03


def test_edited_hashes_are_those_of_the_edited_words():
    words = ["abcdefg", "étéoooo", "q" * 100]
    varied = spelling.Varied(words)
    at = np.arange(len(varied.data))
    for letter in (None, ord("z"), 0xFF):
        hashes, lengths = varied.deleted(at) if letter is None else varied.replaced(at, letter)
        edited = [w[:k] + ("" if letter is None else chr(letter)) + w[k + 1 :] for w in words for k in range(len(w))]
        again = spelling.Varied(edited)
        assert (hashes == again.hashes()).all() and (lengths == again.lengths).all()


def test_op12_over_the_small_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in common.table(spark, SMALL, "documents").collect()]
    out = got(queries.op12_bloom_variants(spark, SMALL))
    assert out == want(rows) and any(r[3] for r in out)
