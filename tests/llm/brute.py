"""Plain statements of what the corpus operators return, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = " \t\n\x0b\x0c\r"


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def crc_rest(doc_id, modulus: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % modulus


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


def line_rows(docs, min_chars=40, min_docs=5):
    """Per document (id, lines, dropped, text)."""
    holders = defaultdict(set)
    for i, text in docs:
        for line in (text or "").split("\n"):
            key = line.strip(SPACE).translate(LOWER)
            if i is not None and len(key) >= min_chars:
                holders[key].add(i)
    last = {k: max(v) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = lines if i is None else [x for x in lines if last.get(x.strip(SPACE).translate(LOWER), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def removed_rows(docs, length=50):
    """Per document (id, bytes, removed, spans, sha of the rest)."""
    first = {}
    order = lambda i: (i is None, i or 0)
    for i, text in docs:
        data = (text or "").encode()
        for p in range(len(data) - length + 1):
            s = data[p : p + length]
            first[s] = min(first.get(s, (True, 2**63)), order(i))
    out = []
    for i, text in docs:
        data = (text or "").encode()
        gone = [False] * len(data)
        for p in range(len(data) - length + 1):
            if first[data[p : p + length]] < order(i):
                gone[p : p + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(data), sum(gone), spans, sha(bytes(b for b, g in zip(data, gone, strict=True) if not g))))
    return out


def fingerprint(text: str | None) -> int:
    own = words(text)
    if not own:
        return 0
    shingles = [" ".join(own[k : k + 4]) for k in range(max(1, len(own) - 3))]
    hashes = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def group_rows(docs, errors=4):
    """Per document with an id (id, fingerprint, smallest id reachable)."""
    prints = [(i, fingerprint(text)) for i, text in docs]
    ids = {i for i, _ in prints}
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, f) in enumerate(prints):
        for j, g in prints[k + 1 :]:
            if (f ^ g).bit_count() <= errors:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [(i, f"{f:016x}", find(i)) for i, f in prints]


def matches(docs, items, least=0.8):
    """{(document, item): similarity} of the best window of the item's size."""
    edge = ".,;:!?\"'()[]{}*"
    norm = lambda text: [w.strip(edge) or w for w in words(text)]
    shingles = lambda w: Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4)))
    out = {}
    for item, text in items:
        target = norm(text)
        if item is None or not target:
            continue
        want = shingles(target)
        for doc, body in docs:
            own = norm(body)
            for p in range(len(own) - len(target) + 1):
                now = shingles(own[p : p + len(target)])
                likeness = sum((now & want).values()) / sum((now | want).values())
                if likeness >= least - 1e-12:
                    out[doc, item] = max(likeness, out.get((doc, item), 0))
    return out


def alike_rows(docs, size=5, percent=80):
    """{id: smallest id reachable} over links of word-shingle sets that share so much; empty sets are alike."""
    def shingles(text):
        w = words(text)
        return {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()

    sets = [(i, shingles(text)) for i, text in docs]
    root = {i: i for i, _ in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if find(i) != find(j) and percent * max(len(a), len(b)) <= 100 * min(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    x, y = sorted((find(i), find(j)))
                    root[y] = x
    return {i: find(i) for i in root}
