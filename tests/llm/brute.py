"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import xxhash

DOCS = "doc_id long, text string"


class Groups:
    """Union-find whose roots are the smallest members."""

    def __init__(self):
        self.parent = {}

    def root(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def link(self, a, b):
        a, b = sorted((self.root(a), self.root(b)))
        self.parent[b] = a


def simhash(text, size=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def fingerprint_groups(prints, most=4):
    """prints: {id: fingerprint}; {id: smallest id reachable}."""
    groups, ids = Groups(), sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if bin(prints[a] ^ prints[b]).count("1") <= most:
                groups.link(a, b)
    return {i: groups.root(i) for i in ids}


def substring_rows(docs, window):
    """(id, words, removed, sha256 of the kept words) of each document, in order."""
    words = [(t or "").encode().split() for _, t in docs]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(docs, words, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def vector_rows(rows, least=0.93):
    """(id, links, smallest id reachable, kept) of each (id, vector, label)."""
    groups, links = Groups(), [0] * len(rows)
    good = [
        v is not None and label is not None and None not in v and len(v) > 0 and np.isfinite(v).all() and any(v) for _, v, label in rows
    ]
    for i, (a, v, x) in enumerate(rows):
        for j, (b, w, y) in enumerate(rows[:i]):
            if good[i] and good[j] and x == y and len(v) == len(w):
                if np.dot(v, w) / (np.linalg.norm(v) * np.linalg.norm(w)) >= least:
                    links[i] += 1
                    links[j] += 1
                    groups.link(a, b)
    return sorted((a, n, groups.root(a), groups.root(a) == a) for (a, *_), n in zip(rows, links, strict=True))
