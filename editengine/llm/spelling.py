"""Spelling variants: words at one edit's distance, found by Bloom-guided probing of their neighbourhoods.

For every word its strings with one code point deleted or replaced are probed in Bloom filters of the vocabulary,
one filter for each length; what one word gains by an insertion the other loses by a deletion. A filter is blocked:
the bits of a word lie in one 64-bit block, which a probe reads at once. Filters are sent to all tasks in passes of
at most ``PASS_WORDS`` words, so their size is bounded whatever the vocabulary. Only positives are shuffled, to a
join with the vocabulary that removes the false ones.

Words hold code points up to U+00FF only, so one byte stands for each.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .wordhash import LETTERS, U, _powers, mixed

LEAST_CHARS, LEAST_COUNT, TIMES, ONE_IN = 7, 2, 10, 31
RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % LEAST_CHARS)
# Words of a pass (two bytes each); bits that a word sets in its block; longer words share a filter.
PASS_WORDS, SET_BITS, LONG = 8 << 20, 5, 64
# Words counted before they leave a task; places in words that are varied at a time.
HELD, PLACES = 200_000, 16_384


def altered(run: str, start: int) -> str:
    """The run itself, or without one code point if ``ONE_IN`` divides its hash; ``start`` is that of ``<doc_id>:``."""
    h = zlib.crc32(run.encode(), start)
    return run if h % ONE_IN else run[: h % len(run)] + run[h % len(run) + 1 :]


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word``, ``n``: the altered runs of at least ``LEAST_CHARS`` code points and ``LEAST_COUNT`` occurrences.

    Runs of rows without an id stay as they are.
    """

    def run(batches):
        held: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for part, texts in common.slices(batches):
            for doc_id, text in zip(part.column(0).to_pylist(), texts, strict=True):
                runs = Counter(RUN.findall(text.encode().lower().decode()))  # bytes: A-Z alone
                if doc_id is None:
                    held.update(runs)
                    continue
                start = zlib.crc32(b"%d:" % doc_id)
                for word, n in runs.items():
                    own = altered(word, start)
                    if len(own) >= LEAST_CHARS:
                        held[own] += n
            if len(held) >= HELD:
                yield out()
                held.clear()
        if held:
            yield out()

    counts = common.id_text(docs).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= LEAST_COUNT)


class Varied:
    """Hashes of words and of their strings with one edit.

    A word is a polynomial of its bytes' random numbers, so an edit changes its value in one step.
    """

    def __init__(self, words: list[str]):
        raw = [w.encode("latin-1") for w in words]
        self.data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.lengths = np.array([len(x) for x in raw], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.owner = np.repeat(np.arange(len(raw)), self.lengths)
        self.place = np.arange(len(self.data)) - self.starts[self.owner]
        self.power, inverse = _powers(int(self.lengths.max(initial=0)) + 1)
        self.back = inverse[1]
        parts = LETTERS[self.data] * self.power[self.place]
        self.sums = np.r_[U(0), np.cumsum(parts, dtype=U)]
        self.value = self.sums[self.starts + self.lengths] - self.sums[self.starts]

    @staticmethod
    def hashed(value: np.ndarray, length: np.ndarray) -> np.ndarray:
        return mixed(value + length.astype(U))

    def hashes(self) -> np.ndarray:
        return self.hashed(self.value, self.lengths)

    def deleted(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of places in the data the hash and length of their word without it."""
        own = self.owner[at]
        start = self.starts[own]
        before, after = self.sums[at] - self.sums[start], self.sums[start + self.lengths[own]] - self.sums[at + 1]
        return self.hashed(before + after * self.back, self.lengths[own] - 1), self.lengths[own] - 1

    def replaced(self, at: np.ndarray, letter: int) -> tuple[np.ndarray, np.ndarray]:
        """Of places in the data the hash and length of their word with another letter there."""
        own = self.owner[at]
        change = (LETTERS[letter] - LETTERS[self.data[at]]) * self.power[self.place[at]]
        return self.hashed(self.value[own] + change, self.lengths[own]), self.lengths[own]


class Blooms:
    """Blocked Bloom filters, one for each length: four words to a block of 64 bits."""

    def __init__(self, counts: dict[int, int]):
        blocks = np.zeros(LONG + 1, dtype=np.int64)
        for length, n in counts.items():
            blocks[min(length, LONG)] += n
        self.blocks = -(-blocks // 4)
        self.first = np.cumsum(self.blocks) - self.blocks
        self.bits = np.zeros(int(self.blocks.sum()), dtype=U)

    def slots(self, hashes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The block of each word, -1 where its length has no filter, and the bits it has there."""
        shard = np.minimum(lengths, LONG)
        size = self.blocks[shard]
        block = self.first[shard] + (((hashes >> U(32)) * size.astype(U)) >> U(32)).astype(np.int64)
        bits = np.zeros(len(hashes), dtype=U)
        for k in range(SET_BITS):
            bits |= U(1) << ((hashes >> U(6 * k)) & U(63))
        return np.where(size > 0, block, -1), bits

    def may_hold(self, hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        block, bits = self.slots(hashes, lengths)
        return (block >= 0) & (self.bits[block] & bits == bits) if len(self.bits) else np.zeros(len(hashes), dtype=bool)


def _pass_of(hashes: np.ndarray, passes: int) -> np.ndarray:
    return (hashes % U(passes)).astype(np.int64)


def _filters(words: DataFrame, passes: int, k: int) -> Blooms:
    """The filters of the words of the k-th pass; tasks set bits and Spark joins them block by block."""

    def lengths(batches):
        for batch in batches:
            varied = Varied(batch.column(0).to_pylist())
            own = varied.lengths[_pass_of(varied.hashes(), passes) == k]
            found, n = np.unique(np.minimum(own, LONG), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], names=["length", "n"])

    counts = words.mapInArrow(lengths, "length long, n long").groupBy("length").agg(F.sum("n").alias("n"))
    blooms = Blooms({r["length"]: r["n"] for r in counts.collect()})

    def bits(batches):
        for batch in batches:
            varied = Varied(batch.column(0).to_pylist())
            hashes = varied.hashes()
            own = _pass_of(hashes, passes) == k
            block, set_bits = blooms.slots(hashes[own], varied.lengths[own])
            yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(set_bits.view(np.int64))], names=["block", "bits"])

    rows = words.mapInArrow(bits, "block long, bits long").groupBy("block").agg(F.bit_or("bits").alias("bits")).toArrow()
    blooms.bits[rows.column(0).to_numpy()] = rows.column(1).to_numpy().view(U)
    return blooms


def _positives(words: DataFrame, blooms: Blooms, letters: list[int], passes: int, k: int) -> DataFrame:
    """``candidate``, ``word``, ``n``: edited strings that the filters of a pass may hold."""
    sent = words.sparkSession.sparkContext.broadcast(blooms)

    def run(batches):
        held = sent.value
        for batch in batches:
            words = batch.column(0).to_pylist()
            varied = Varied(words)
            # Of equal letters in a row any one deleted gives the same string: the first.
            fresh = np.r_[True, varied.data[1:] != varied.data[:-1]] | (varied.place == 0) if len(varied.data) else np.zeros(0, dtype=bool)
            for start in range(0, len(varied.data), PLACES):
                places = np.arange(start, min(start + PLACES, len(varied.data)))
                found: list[tuple[str, int]] = []
                for letter in (None, *letters):
                    # A pair of words that differ in one letter is met from the word with the smaller one.
                    at = places[fresh[places]] if letter is None else places[varied.data[places] < letter]
                    hashes, lengths = varied.deleted(at) if letter is None else varied.replaced(at, letter)
                    hit = held.may_hold(hashes, lengths) & (_pass_of(hashes, passes) == k)
                    new = "" if letter is None else chr(letter)
                    for p in at[hit].tolist():
                        w, i = int(varied.owner[p]), int(varied.place[p])
                        found.append((words[w][:i] + new + words[w][i + 1 :], w))
                if found:
                    own = pa.array([w for _, w in found])
                    yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in found]), batch.column(0).take(own), batch.column(1).take(own)], names=["candidate", "word", "n"])

    return words.mapInArrow(run, "candidate string, word string, n long")


def near_pairs(words: DataFrame) -> DataFrame:
    """``word``, ``n``, ``near``, ``near_n``: every two words that differ by one edit, from both sides."""
    passes = max(1, -(-words.count() // PASS_WORDS))
    letters = sorted(ord(r[0]) for r in words.select(F.explode(F.split("word", ""))).distinct().collect() if r[0])  # 90 at most
    own, out = words.select(F.col("word").alias("candidate"), F.col("n").alias("near_n")), None
    for k in range(passes):
        found = _positives(words, _filters(words, passes, k), letters, passes, k)
        out = found if out is None else out.union(found)
    pairs = common.cut(out.join(own, "candidate").select("word", "n", F.col("candidate").alias("near"), "near_n"), "near")
    return pairs.union(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))


def roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root``: the end of the chain of forms from each word that has one.

    A form occurs ten times as often as its word, so chains are short; each round doubles the steps taken.
    """
    now = common.cut(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        following = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = common.cut(now.join(following, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return now


def variants(docs: DataFrame) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n``, ``root`` of every word of the vocabulary.

    A word's form is its near word of largest n, of several the smallest in code-point order, if that n is ten times
    its own. Null and empty texts have no words; repeated rows count each; rows without an id count with their runs
    unaltered; a run of any length is one word. An empty table gives no row.
    """
    words = common.cut(vocabulary(docs), "vocabulary")
    best = near_pairs(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("best"))
    joined = words.join(best, "word", "left")
    enough = -F.col("best.order") >= TIMES * F.col("n")
    placed = common.cut(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.order")).alias("form_n")), "forms")
    ends = roots(placed.where("form IS NOT NULL"))
    return placed.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
