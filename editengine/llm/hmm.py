"""A hidden Markov language model of word classes, trained by Baum-Welch over partitions.

Texts are coded once: each task cuts its documents into chunks with a vocabulary of their own. To learn
how often a word occurs in the whole corpus, a chunk sends its vocabulary, split by word hash, to
buckets that add the counts up and answer each chunk; no table of words is sent to all tasks.

A word that occurs twice or more in training belongs to one of ``classes`` hashed classes, every other
word to the rare class. A state emits a class, the class a word by its share of the class's tokens; half
of the rare class stands for words never seen, the other half for those seen once. The model's size does
not depend on the corpus. Each round, expected counts are added up inside a task, and the tasks' sums
meet by slices of classes.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

STATES, CLASSES, ROUNDS, PRIOR, SEED = 8, 1 << 15, 5, 200.0, 7
CHUNK_TOKENS, GROUP_TOKENS, SLICE_CLASSES = 1_000_000, 250_000, 4096
BUCKET_WORDS = 1_000_000
END = b"\n"  # no word holds it
CODED = "chunk long, doc_ids array<long>, train array<boolean>, lengths array<long>, words binary, counts binary, tokens binary, n_words long"


def code(docs: DataFrame) -> DataFrame:
    """Chunks of documents: the hashes of their words, how often each occurs in training documents, the tokens."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(F.col("train"), F.lit(False)).alias("train"))
    kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary(), pa.int64())
    names = ["chunk", "doc_ids", "train", "lengths", "words", "counts", "tokens", "n_words"]

    def run(batches):
        from pyspark import TaskContext

        chunk, pack = TaskContext.get().partitionId() << 24, zstandard.ZstdCompressor(level=3)

        def fresh():
            local: defaultdict = defaultdict()
            local.default_factory = local.__len__
            return local, [], [], []

        def row():
            lengths = [len(x) for x in tokens]
            every = np.concatenate(tokens)
            learned = every[np.repeat(np.array(train, dtype=bool), lengths)]
            words = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in local), np.uint64, len(local))
            counts = np.bincount(learned, minlength=len(local)).astype(np.int64)
            values = chunk, ids, train, lengths, words.tobytes(), pack.compress(counts.tobytes()), pack.compress(every.tobytes()), len(local)
            return pa.RecordBatch.from_arrays([pa.array([v], type=t) for v, t in zip(values, kinds, strict=True)], names=names)

        local, ids, train, tokens = fresh()
        size = 0
        for part, texts in common.slices(batches):
            for doc_id, learn, text in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), texts, strict=True):
                words = text.encode().lower().split()  # bytes: ASCII letters and ASCII white space only
                words.append(END)
                tokens.append(np.fromiter(map(local.__getitem__, words), np.uint32, len(words)))
                ids.append(doc_id)
                train.append(learn)
                size += len(words)
                if size >= CHUNK_TOKENS:
                    yield row()
                    local, ids, train, tokens = fresh()
                    size, chunk = 0, chunk + 1
        if ids:
            yield row()

    return rows.mapInArrow(run, CODED)


def count_words(coded: DataFrame, classes: int) -> tuple[DataFrame, int]:
    """For each chunk and bucket the corpus counts of the chunk's words in the bucket, in the chunk's order.

    A bucket's first row has its totals: ``n_tokens``, ``n_distinct``, ``n_once`` and the tokens of each class.
    """
    total = coded.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    buckets = max(8, -(-total // BUCKET_WORDS))

    def ask(batches):
        unpack, pack = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        for r in common.each_row(batches):
            words, counts = np.frombuffer(r["words"], np.uint64), np.frombuffer(unpack.decompress(r["counts"]), np.int64)
            of = words % np.uint64(buckets)
            order = np.argsort(of, kind="stable")
            ends = np.searchsorted(of[order], np.arange(buckets + 1, dtype=np.uint64))
            own = [order[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(buckets)), pa.array(np.full(buckets, r["chunk"])), pa.array([words[x].tobytes() for x in own], pa.binary()), pa.array([pack.compress(counts[x].tobytes()) for x in own], pa.binary())],
                names=["bucket", "chunk", "words", "counts"],
            )

    def answer(rows: pa.Table) -> pa.Table:
        unpack, pack = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        words = [np.frombuffer(x, np.uint64) for x in rows["words"].to_pylist()]
        counts = np.concatenate([np.frombuffer(unpack.decompress(x), np.int64) for x in rows["counts"].to_pylist()]).astype(np.float64)
        known, place = np.unique(np.concatenate(words), return_inverse=True)
        sums = np.bincount(place, weights=counts, minlength=len(known)).astype(np.int64)
        ends = np.cumsum([0, *(len(x) for x in words)])
        n = rows.num_rows
        once = np.zeros(n, dtype=np.int64)
        tokens, distinct = once.copy(), once.copy()
        tokens[0], distinct[0], once[0] = sums.sum(), (sums > 0).sum(), (sums == 1).sum()
        of_class = np.bincount(_class_of(known, sums, classes), weights=sums, minlength=classes + 1).astype(np.int64)
        found = [pack.compress(sums[place[a:b]].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        data = rows["chunk"], rows["bucket"], pa.array(found, pa.binary()), pa.array(tokens), pa.array(distinct), pa.array(once), pa.array([pack.compress(of_class.tobytes())] + [None] * (n - 1), pa.binary())
        return pa.table(list(data), names=["chunk", "bucket", "sums", "n_tokens", "n_distinct", "n_once", "of_class"])

    asked = coded.select("chunk", "words", "counts").mapInArrow(ask, "bucket long, chunk long, words binary, counts binary")
    return asked.groupBy("bucket").applyInArrow(answer, "chunk long, bucket long, sums binary, n_tokens long, n_distinct long, n_once long, of_class binary"), buckets


def _class_of(words: np.ndarray, total: np.ndarray, classes: int) -> np.ndarray:
    return np.where(total >= 2, (words % np.uint64(classes)).astype(np.int64), classes)


def classify(coded: DataFrame, classes: int = CLASSES) -> tuple[DataFrame, int, np.ndarray]:
    """Chunks with a class for each token and the parts of each document's score that no state decides."""
    answers, buckets = count_words(coded, classes)
    answers = common.cut(answers, "counts")
    sums = answers.agg(*(F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in ("n_tokens", "n_distinct", "n_once"))).first()
    n, distinct, once = sums["n_tokens"], sums["n_distinct"], sums["n_once"]

    def add(batches):
        out = np.zeros(classes + 1, dtype=np.int64)
        for r in common.each_row(batches):
            out += np.frombuffer(zstandard.ZstdDecompressor().decompress(r["of_class"]), np.int64)
        at = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(out[at])], names=["class", "n"])

    counted = answers.where("of_class IS NOT NULL").select("of_class").mapInArrow(add, "class long, n long").groupBy("class").agg(F.sum("n").alias("n")).collect()
    class_sums = np.zeros(classes + 1)
    for r in counted:
        class_sums[r["class"]] = r["n"]
    class_sums[classes] += 0.5

    def run(batches):
        unpack, pack = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=3)
        for r in common.each_row(batches):
            words = np.frombuffer(r["words"], np.uint64)
            total = np.empty(len(words), dtype=np.int64)
            total[np.argsort(words % np.uint64(buckets), kind="stable")] = np.concatenate([np.frombuffer(unpack.decompress(x["sums"]), np.int64) for x in r["answers"]])
            of = _class_of(words, total, classes)
            base = np.log10((total + 0.5) / (n + 0.5 * (distinct + 1)))
            share = np.where(total >= 2, total / np.maximum(class_sums[of], 1), np.where(total == 1, 0.5 / max(once, 1), 0.5))
            tokens = np.frombuffer(unpack.decompress(r["tokens"]), np.uint32)
            starts = np.cumsum([0, *r["lengths"]])[:-1]
            values = [np.add.reduceat(x[tokens], starts) for x in ((total > 0).astype(np.int64), base, np.log10(share))]
            data = r["chunk"], r["doc_ids"], r["train"], r["lengths"], pack.compress(of[tokens].astype(np.uint32).tobytes()), *values
            yield pa.RecordBatch.from_arrays([pa.array([x], type=t) for x, t in zip(data, kinds, strict=True)], names=names)

    longs, doubles = pa.list_(pa.int64()), pa.list_(pa.float64())
    kinds = (pa.int64(), longs, pa.list_(pa.bool_()), longs, pa.binary(), longs, doubles, doubles)
    names = ["chunk", "doc_ids", "train", "lengths", "classes", "n_known", "base", "fixed"]
    schema = "chunk long, doc_ids array<long>, train array<boolean>, lengths array<long>, classes binary, n_known array<long>, base array<double>, fixed array<double>"
    by_chunk = answers.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("bucket", "sums"))).alias("answers"))  # of one chunk
    return common.cut(coded.drop("counts").join(by_chunk, "chunk").mapInArrow(run, schema), "classes"), n, class_sums


def documents_of(row: dict, chosen: np.ndarray | None = None):
    """(places of documents, side by side) of a chunk: some documents of like length at a time."""
    lengths = np.array(row["lengths"], dtype=np.int64)
    ends = np.cumsum(np.r_[0, lengths])
    classes = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["classes"]), np.uint32)
    order = np.argsort(-lengths, kind="stable")
    order = order if chosen is None else order[chosen[order]]
    group = np.cumsum(lengths[order]) // GROUP_TOKENS
    for k in np.unique(group):
        own = order[group == k]
        yield own, Chunk(lengths[own], np.concatenate([classes[ends[i] : ends[i + 1]] for i in own]))


class Chunk:
    """Documents side by side: position t of all that are longer than t, longest first."""

    def __init__(self, lengths: np.ndarray, classes: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.order]
        starts = (np.cumsum(lengths) - lengths)[self.order]
        longest = int(self.lengths[0])
        self.width = np.searchsorted(-self.lengths, -np.arange(longest), side="left")  # documents longer than t
        self.at = np.r_[0, np.cumsum(self.width)]
        step = np.repeat(np.arange(longest), self.width)
        lane = np.arange(len(classes)) - self.at[step]
        self.classes = classes[starts[lane] + step]
        self.step, self.lane = step, lane

    def forward(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scaled forward values, the scales, the emissions, in side-by-side order."""
        seen = emit[self.classes]
        ahead, scale = np.empty_like(seen), np.empty(len(seen))
        at = self.at.tolist()
        now = start[None, :]
        for t in range(len(at) - 1):
            a, b = at[t], at[t + 1]
            now = (now[: b - a] @ move if t else now) * seen[a:b]
            s = now.sum(axis=1)
            now /= s[:, None]
            ahead[a:b], scale[a:b] = now, s
        return ahead, scale, seen

    def log10(self, scale: np.ndarray) -> np.ndarray:
        """The log probability of each document, in the order given."""
        out = np.empty(len(self.lengths))
        out[self.order] = np.bincount(self.lane, weights=np.log10(scale), minlength=len(self.lengths))
        return out

    def expect(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Expected counts of first states, moves and emissions, and the log probability of all."""
        ahead, scale, seen = self.forward(start, move, emit)
        back = np.ones_like(seen)
        at, turned = self.at.tolist(), np.ascontiguousarray(move.T)
        seen /= scale[:, None]
        for t in range(len(at) - 3, -1, -1):
            a, b, c = at[t], at[t + 1], at[t + 2]
            back[a : a + c - b] = (seen[b:c] * back[b:c]) @ turned
        later = np.arange(self.at[1], len(seen))
        before = self.at[self.step[later] - 1] + self.lane[later]
        moves = (ahead[before].T @ (seen[later] * back[later])) * move
        state = ahead * back
        classes = emit.shape[0]
        emits = np.stack([np.bincount(self.classes, weights=state[:, k], minlength=classes) for k in range(state.shape[1])], axis=1)
        return state[: self.at[1]].sum(axis=0), moves, emits, float(np.log10(scale).sum())


class Model:
    """Start, move and emission probabilities; emissions are smoothed towards the class frequencies."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def of(cls, starts: np.ndarray, moves: np.ndarray, emits: np.ndarray, frequency: np.ndarray, prior: float = PRIOR) -> Model:
        share = frequency / frequency.sum()
        k = len(starts)
        start = (starts + 1) / (starts.sum() + k)
        move = (moves + 1) / (moves.sum(axis=1, keepdims=True) + k)
        emit = (emits + prior * share[:, None]) / (emits.sum(axis=0) + prior)
        return cls(start, move, emit)

    @classmethod
    def guess(cls, frequency: np.ndarray, states: int, seed: int) -> Model:
        """States that last, with the class frequencies shaken differently in each."""
        shaken = frequency[:, None] * np.exp(np.random.default_rng(seed).normal(size=(len(frequency), states)))
        moves = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
        return cls.of(np.ones(states), 1e6 * moves, shaken, frequency)


def fit(classed: DataFrame, frequency: np.ndarray, states: int = STATES, rounds: int = ROUNDS, seed: int = SEED) -> Model:
    """Baum-Welch rounds over all training documents."""
    spark = classed.sparkSession
    model = Model.guess(frequency, states, seed)
    parts = -(-len(frequency) // SLICE_CLASSES)
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(model)  # of a size that the parameters fix

        def expect(batches, sent=sent):
            from pyspark import TaskContext

            now, task = sent.value, TaskContext.get().partitionId()
            starts, moves, emits, score = np.zeros(states), np.zeros((states, states)), np.zeros_like(now.emit), 0.0
            for r in common.each_row(batches):
                for _, chunk in documents_of(r, np.array(r["train"], dtype=bool)):
                    more = chunk.expect(now.start, now.move, now.emit)
                    starts, moves, emits, score = starts + more[0], moves + more[1], emits + more[2], score + more[3]
            blobs = [x.astype(np.float32).tobytes() for x in np.split(emits, range(SLICE_CLASSES, len(emits), SLICE_CLASSES))]
            blobs.append(np.r_[starts, moves.ravel(), score].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(parts + 1)), pa.array(np.full(parts + 1, task)), pa.array(blobs, pa.binary())], names=["part", "task", "sums"])

        def add(key: tuple[pa.Scalar, ...], rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part = key[0].as_py()
            kind, total = (np.float64 if part == parts else np.float32), 0.0
            for batch in rows:
                for x in batch.column("sums").to_pylist():
                    total = total + np.frombuffer(x, kind).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([total.tobytes()], pa.binary())], names=["part", "sums"])

        told = classed.select("train", "lengths", "classes").mapInArrow(expect, "part long, task long, sums binary")
        sums = {r["part"]: np.frombuffer(r["sums"]) for r in told.groupBy("part").applyInArrow(add, "part long, sums binary").collect()}
        sent.unpersist()
        if not sums:
            break
        emits = np.concatenate([sums[k] for k in range(parts)]).reshape(-1, states)
        last = sums[parts]
        model = Model.of(last[:states], last[states : states + states * states].reshape(states, states), emits, frequency)
    return model


def score(docs: DataFrame, train, states: int = STATES, classes: int = CLASSES, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """Score every whole text by a model of the documents for which the column ``train`` is true.

    ``doc_id``, ``train``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (unigrams) and
    ``score``, log10 probabilities of all words and the end. A null or empty text is the end alone.
    Repeated rows and rows without an id are documents of their own; a null ``train`` is false. With no
    training document the model knows no word and is all prior.
    """
    coded = common.cut(code(docs.select("doc_id", "text", train.alias("train"))), "coded")
    classed, n, frequency = classify(coded, classes)
    model = fit(classed, frequency, states, rounds, seed)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        now = sent.value
        for r in common.each_row(batches):
            own = np.array(r["fixed"])
            for at, chunk in documents_of(r):
                own[at] += chunk.log10(chunk.forward(now.start, now.move, now.emit)[1])
            rest = [pa.array(r[k], t) for k, t in (("lengths", pa.int64()), ("n_known", pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(r["doc_ids"], pa.int64()), pa.array(r["train"], pa.bool_()), *rest, pa.array(np.full(len(own), n, dtype=np.int64)), pa.array(r["base"], pa.float64()), pa.array(own)],
                names=["doc_id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return classed.mapInArrow(run, "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
