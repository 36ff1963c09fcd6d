"""Hashes of words and of runs of words, for many texts at once in numpy.

A word is a polynomial of its bytes, modulo 2^64, whose coefficients come from a table of random numbers; sums
over all bytes before each place give every word's value by one subtraction. No word is looked up, so the
cost does not depend on how many different words there are.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
SEED, PIECE = 20, 1 << 18
_RNG = np.random.default_rng(SEED)
LETTERS = _RNG.integers(0, 2**64, 256, dtype=U)
BASE = int(_RNG.integers(0, 2**63, dtype=U)) * 8 + 5
FACTORS = _RNG.integers(0, 2**64, 64, dtype=U) | U(1)
_POWERS: list[np.ndarray] = []


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the input moves every bit of the output; one to one."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse."""
    if not _POWERS or len(_POWERS[0]) < n:
        base = BASE % 2**64
        _POWERS[:] = [np.cumprod(np.r_[U(1), np.full(max(n, 1 << 16) - 1, x, dtype=U)]) for x in (base, pow(base, -1, 2**64))]
    return _POWERS


def _piece(data: np.ndarray, marks: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of some bytes and where they start; ``marks`` flags bytes to strip at both ends."""
    letter = (data != 32) & ((data < 9) | (data > 13))
    edge = np.flatnonzero(np.diff(np.r_[False, letter, False]))
    start, stop = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, dtype=U), start
    a, b = start, stop
    if marks is not None:
        core = np.flatnonzero(letter & ~marks[data])
        if len(core):
            first, last = np.searchsorted(core, start), np.searchsorted(core, stop) - 1
            some = first <= last  # a word that is all marks stays as it is
            a = np.where(some, core[np.minimum(first, len(core) - 1)], start)
            b = np.where(some, core[last] + 1, stop)
    power, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=U)
    np.cumsum(LETTERS[data] * power[: len(data)], out=sums[1:])
    return mixed((sums[b] - sums[a]) * inverse[a] + (b - a).astype(U)), start


def words(texts: list[str], marks: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of the texts, A-Z lower-cased, and where each text's begin (the end last).

    Words are what stands between spaces, tabs and line ends of any kind.
    """
    raw = [x.encode() for x in texts]
    data = np.frombuffer(b"\n".join(raw).lower(), dtype=np.uint8)
    flags = None
    if marks:
        flags = np.zeros(256, dtype=bool)
        flags[list(marks)] = True
    found, starts, at = [np.zeros(0, dtype=U)], [np.zeros(0, dtype=np.int64)], 0
    while at < len(data):
        stop = at + PIECE  # cut behind white space: words stay whole, however long
        while stop < len(data) and not (gap := np.flatnonzero(np.isin(data[stop : stop + PIECE], (32, 9, 10, 11, 12, 13)))[:1]).size:
            stop += PIECE
        stop = stop + int(gap[0]) if stop < len(data) else len(data)
        own, places = _piece(data[at:stop], flags)
        found.append(own)
        starts.append(places + at)
        at = stop
    bounds = np.cumsum([0, *(len(x) + 1 for x in raw)])
    return np.concatenate(found), np.searchsorted(np.concatenate(starts), bounds)


def token_sets(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct tokens of all texts, in rising order within each, and how many each has.

    A token stands for a run of ``size`` words; a text with fewer has one for all of its words, one without a
    word has none.
    """
    hashes, bounds = words(texts)
    runs = max(0, len(hashes) - size + 1)
    full = np.zeros(runs, dtype=U)
    for k in range(size):
        full += hashes[k : k + runs] * FACTORS[k]
    full = mixed(full).view(np.int64)
    counts = np.diff(bounds)
    sizes = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    ends = np.cumsum(sizes)
    out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.int64)
    for start, n, stop, k in zip(bounds.tolist(), counts.tolist(), ends.tolist(), sizes.tolist(), strict=False):
        if n >= size:
            part = out[stop - k : stop]
            part[:] = full[start : start + k]
            part.sort()
        elif n:
            short = hashes[start : start + n] * FACTORS[-n:] * U(2 * n + 1)
            out[stop - 1] = mixed(short.sum(dtype=U, keepdims=True)).view(np.int64)[0]
    own = np.repeat(np.arange(len(sizes)), sizes)
    fresh = np.ones(len(out), dtype=bool)
    fresh[1:] = (out[1:] != out[:-1]) | (own[1:] != own[:-1])
    return out[fresh], np.bincount(own[fresh], minlength=len(sizes))
