"""Language identification: averaged hashed subword embeddings and a linear softmax.

A subword is a run of two to four bytes inside a word with its borders. A text is the mean of the
embeddings of its subwords, which a softmax turns into languages. Both layers are trained in numpy by
stochastic gradient descent on windows of a bounded number of labelled texts; a temperature comes from
windows that took no part in it. As both layers are linear, they are multiplied out once, and a whole
text costs one look-up for each subword.

The softmax only compares the languages it knows. Whether a text is in any of them is judged by how
familiar its subwords are: the mean logarithm of their share in the language where each is most frequent,
so a text of several known languages is as familiar as one of a single language. The bound for a text's
length comes from the held-out windows, cut to several lengths.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

# The bound of the sample: texts for each language, windows of a text, bytes of a window.
TEXTS, WINDOWS, WINDOW_BYTES = 1500, 3, 400
BUCKETS, DIM, EPOCHS, BATCH, RATE, SEED = 1 << 16, 16, 4, 64, 0.5, 11
SIZES = (2, 3, 4)
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
SLICE, SHARES = 1_000_000, 1 << 30
# Part of held-out windows that may be rejected, lengths in bytes they are cut to, share left to unseen subwords.
REJECTED, CUTS, UNSEEN, TAIL = 0.001, (6, 12, 25, 50, 100, 200, 400), 0.05, 3.1


def _fold() -> np.ndarray:
    """ASCII letters in lower case, other ASCII as a space; bytes of longer characters as they are."""
    table = np.arange(256, dtype=np.uint8)
    table[:128] = 32
    for low in range(ord("a"), ord("z") + 1):
        table[low] = table[low - 32] = low
    return table


FOLD = _fold()


def subwords(texts: list[bytes]):
    """For each size the bucket of every place (``BUCKETS`` where no subword begins), and where the texts begin."""
    data, ends = common.joined([b" " + x for x in texts] + [b" " * max(SIZES)])
    data = FOLD[data]
    space = data == 32
    wide = data.astype(np.uint32)
    n = len(data) - max(SIZES)
    out = []
    for size in SIZES:
        code, inner = wide[:n].copy(), np.zeros(n, dtype=bool)
        for k in range(1, size):
            code |= wide[k : n + k] << np.uint32(8 * k)
            if k < size - 1:
                inner |= space[k : n + k]
        inner |= space[:n] & space[size - 1 : n + size - 1]
        mixed = (code ^ (code >> np.uint32(15))) * np.uint32(0x9E3779B1 + 2 * size)
        out.append(np.where(inner, BUCKETS, mixed >> np.uint32(16)).astype(np.int32))
    return out, ends[: len(texts)]


class Model:
    """``weights`` has a row per bucket, of zeros for one never seen, and a row of zeros for no subword.

    Their last column is the familiarity. ``bounds`` are (logarithm of the number of subwords, least familiarity).
    """

    def __init__(self, labels: list[str], weights: np.ndarray, scale: float = 1.0, least: float = 0.0, bounds=((0.0, -np.inf),)):
        self.labels, self.weights, self.scale, self.least, self.bounds = labels, weights, scale, least, np.array(bounds)

    def measure(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logits, familiarity and number of subwords of each text; few texts at a time."""
        parts = [self._measure(texts[at : at + 256]) for at in range(0, max(1, len(texts)), 256)]
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    def _measure(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found, starts = subwords(texts)
        total = np.zeros((len(texts), self.weights.shape[1]))
        number = np.zeros(len(texts))
        for ids in found:
            total += np.add.reduceat(self.weights[ids], starts, axis=0, dtype=np.float64)
            number += np.add.reduceat((ids < BUCKETS).astype(np.int64), starts)
        mean = total / np.maximum(number, 1)[:, None]
        return mean[:, :-1], mean[:, -1], number

    def judge(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of the languages, and whether a text is in one or several of them."""
        logits, familiar, number = self.measure(texts)
        sure = softmax(logits * self.scale)
        bound = np.interp(np.log(np.maximum(number, 1)), *self.bounds.T)
        return sure, (sure.max(axis=1) >= self.least) & (number > 0) & (familiar >= bound)


def familiarity(bags: list[np.ndarray], target: np.ndarray, n: int) -> np.ndarray:
    """For each bucket the logarithm of its share in the language, of ``n``, that uses it most; 0 for no subword."""
    out = np.zeros(BUCKETS + 1)
    out[:BUCKETS] = UNSEEN / BUCKETS
    for lang in range(n):
        count, own = np.zeros(BUCKETS, dtype=np.int64), np.flatnonzero(target == lang)
        for at in range(0, len(own), 64):
            count += np.bincount(np.concatenate([bags[k] for k in own[at : at + 64]]), minlength=BUCKETS)
        out[:BUCKETS] = np.maximum(out[:BUCKETS], (1 - UNSEEN) * count / max(1, count.sum()) + UNSEEN / BUCKETS)
    out[:BUCKETS] = np.log(out[:BUCKETS])
    return out


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(texts: list[bytes], langs: list[str], seed: int = SEED) -> Model | None:
    """None without a labelled text. A fifth of the windows set the temperature and the rejection."""
    labels = sorted(set(langs))
    if not labels:
        return None
    rng = np.random.default_rng(seed)
    target = np.array([labels.index(x) for x in langs])
    order = rng.permutation(len(texts))
    held, used = order[: len(order) // 5], order[len(order) // 5 :]
    table = rng.normal(scale=1 / DIM, size=(BUCKETS + 1, DIM)).astype(np.float32)
    table[BUCKETS] = 0
    out = np.zeros((DIM, len(labels)), dtype=np.float32)
    bags = []
    for text in texts:
        ids = np.concatenate(subwords([text])[0])
        bags.append(ids[ids < BUCKETS].astype(np.uint16))
    used = np.array([k for k in used if len(bags[k])], dtype=int)
    steps, step = EPOCHS * -(-len(used) // BATCH), 0
    for _ in range(EPOCHS):
        for at in range(0, len(used), BATCH):
            own = rng.permutation(used)[:BATCH] if at == 0 else used[at : at + BATCH]
            rate, step = RATE * (1 - step / steps), step + 1
            sizes = np.array([len(bags[k]) for k in own])
            ids = np.concatenate([bags[k] for k in own])
            mean = np.add.reduceat(table[ids], np.cumsum(sizes) - sizes, axis=0) / sizes[:, None]
            error = softmax(mean @ out)
            error[np.arange(len(own)), target[own]] -= 1
            back = (error @ out.T) / sizes[:, None]
            out -= rate * (mean.T @ error) / len(own) * DIM
            places, which = np.unique(ids, return_inverse=True)
            lanes = np.repeat(np.arange(len(own)), sizes)
            grown = np.stack([np.bincount(which, weights=back[lanes, k], minlength=len(places)) for k in range(DIM)], axis=1)
            table[places] -= (rate * DIM * grown).astype(np.float32)
        rng.shuffle(used)
    known = np.zeros(BUCKETS + 1, dtype=bool)
    for k in used:
        known[bags[k]] = True
    table[~known] = 0  # a subword that was never seen speaks for no language
    spent = np.full(len(texts), -1)
    spent[used] = target[used]
    model = Model(labels, np.c_[table @ out, familiarity(bags, spent, len(labels))].astype(np.float32))
    if len(held):
        logits, right = model.measure([texts[k] for k in held])[0], target[held]
        loss = lambda t: -np.log(np.maximum(softmax(logits * t)[np.arange(len(held)), right], 1e-12)).mean()
        model.scale = float(min(np.geomspace(0.25, 64, 49), key=loss))
        # At the even share nothing speaks for any language; a text of two languages is well above it.
        model.least = min(0.99, 1.2 / len(labels))
        model.bounds = bounds(model, [texts[k] for k in held])
    return model


def bounds(model: Model, windows: list[bytes]) -> np.ndarray:
    """The familiarity that all but ``REJECTED`` of the windows reach, for each length they are cut to."""
    rows = []
    for size in CUTS:
        _, familiar, number = model.measure([w[at : at + size] for w in windows for at in range(0, max(1, len(w) - size + 1), size)])
        familiar, number = familiar[number > 0], number[number > 0]
        if len(familiar):
            # Few windows do not show their tail; the spread then stands for it.
            least = min(np.quantile(familiar, REJECTED), familiar.mean() - TAIL * familiar.std())
            rows.append((float(np.log(np.median(number))), float(least)))
    return np.array(sorted(rows) or [(0.0, -np.inf)])


def fit(docs: DataFrame, texts: int = TEXTS, seed: int = SEED) -> Model | None:
    """Learn from ``text`` and non-null ``lang``: windows, spread over whole texts, of ``texts`` per language."""
    rows = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("id"))
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    # A hash keeps about twice what is wanted of each language where the texts are read; few are ordered.
    shares = [x for r in rows.groupBy("lang").count().collect() for x in (F.lit(r["lang"]), F.lit(min(SHARES, 2 * texts * SHARES // r["count"] + 1)))]
    if not shares:
        return None
    hashed = rows.withColumn("h", F.xxhash64("text", "id")).where(F.pmod("h", F.lit(SHARES)) < F.create_map(*shares)[F.col("lang")])
    best = Window.partitionBy("lang").orderBy("h")
    chosen = hashed.withColumn("r", F.row_number().over(best)).where(F.col("r") <= texts).select("lang", "text")

    def cut(part, values):
        langs, windows = [], []
        for lang, text in zip(part.column(0).to_pylist(), values, strict=True):
            data = text.encode()
            for at in np.unique(np.linspace(0, max(0, len(data) - WINDOW_BYTES), WINDOWS).astype(int)).tolist():
                langs.append(lang)
                windows.append(data[at : at + WINDOW_BYTES])
        return langs, windows

    found = common.by_slice(chosen, cut, "lang string, part binary").orderBy("lang", F.xxhash64("part")).collect()
    return train([bytes(r["part"]) for r in found], [r["lang"] for r in found], seed)


def _judge(model: Model | None, texts: list) -> tuple[list, np.ndarray, np.ndarray]:
    lettered = np.array([bool(x and LETTER.search(x)) for x in texts], dtype=bool)
    langs, scores, kept = [UNKNOWN] * len(texts), np.zeros(len(texts)), lettered.copy()
    if model is None:
        return langs, scores, kept
    at = np.flatnonzero(lettered)
    if len(at):
        sure, familiar = model.judge([texts[k].encode() for k in at])
        best = sure.argmax(axis=1)
        for k, b in zip(at, best, strict=True):
            langs[k] = model.labels[b]
        scores[at] = sure.max(axis=1)
        kept[at] = familiar
    return langs, scores, kept


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (calibrated), ``accepted``, for every whole text.

    A text that is null or has no letter is ``und``, score 0, not accepted. Any other gets the likeliest
    language; it is accepted if its subwords are as familiar as those of the held-out windows and the score is
    above the even share. Without a model all are ``und``.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # buckets times languages
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(part, texts):
        langs, scores, kept = _judge(sent.value, texts)
        return part.column(0), langs, pa.array(scores), pa.array(kept)

    return common.by_slice(rows, run, "doc_id long, lang_pred string, score double, accepted boolean", chars=SLICE)


def accept(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs`` whose text is accepted, unchanged. Without a model every text with a letter is."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    inner = docs.toDF(*(f"c{k}" for k in range(len(names))))
    at = f"c{names.index('text')}"

    def run(batches):
        for part, texts in common.slices(batches, at, SLICE):
            yield part.filter(pa.array(_judge(sent.value, texts)[2]))

    return inner.mapInArrow(run, inner.schema).toDF(*names)
