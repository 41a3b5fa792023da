"""BagMinHash signatures of word-shingle multisets (numpy, run inside Arrow functions)."""

from __future__ import annotations

import math

import numpy as np

from marketlens.llm.hashing import grams, mix, word_hashes, words

REGISTERS, BANDS, ROWS = 130, 26, 5
SHINGLE = 5
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _unit(x: np.ndarray) -> np.ndarray:
    """(0, 1] from the top 53 bits."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0 ** -53


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, multiplicity, first entry of each document and one past the last): the multiset of k-word shingles.

    A document of 1 to k - 1 words has one shingle of all its words; one without words has none.
    """
    starts, ends, first = words(raw, offsets)
    hashes = word_hashes(raw, starts, ends)
    every = grams(hashes, k)
    out_h, out_w, sizes = [], [], [0]
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= k:
            s = np.sort(every[a:b - k + 1])
            new = np.concatenate([[0], np.flatnonzero(s[1:] != s[:-1]) + 1])
            out_h.append(s[new])
            out_w.append(np.diff(new, append=len(s)))
        elif b > a:
            out_h.append(grams(hashes[a:b], b - a, seed=b - a))
            out_w.append(np.ones(1, np.int64))
        else:
            sizes.append(0)
            continue
        sizes.append(len(out_h[-1]))
    if not out_h:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.cumsum(sizes)
    return np.concatenate(out_h), np.concatenate(out_w), np.cumsum(sizes)


def _points(h: np.ndarray, w: np.ndarray, doc: np.ndarray, horizon: np.ndarray, m: int):
    """Points (register slot, time, identity) below each document's horizon.

    Weights are discretised into unit levels and levels into blocks 0-1, 1-2, 2-4, 4-8, ... A
    block has one Poisson process whose rate is its size, for every element alike; the levels of
    a point inside its block are drawn from the same stream, and an element of weight w takes the
    points of its w lowest levels. So two documents see the same points wherever their weights
    overlap, which makes equal registers as likely as their weighted Jaccard similarity.
    """
    block = 0
    with np.errstate(over="ignore"):
        while len(h):
            low, size = (0, 1) if block == 0 else (1 << (block - 1), 1 << (block - 1))
            state = mix(h + np.uint64(block + 1) * _GOLD)
            t = np.zeros(len(h))
            live_h, live_w, live_d, end = state, w, doc, horizon[doc]
            while len(live_h):
                live_h = live_h + _GOLD
                r = mix(live_h)
                t = t - np.log(_unit(r)) / size
                on = t < end
                live_h, live_w, live_d, t, end, r = live_h[on], live_w[on], live_d[on], t[on], end[on], r[on]
                q = mix(r ^ np.uint64(0xA0761D6478BD642F))
                slot = ((q >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
                if size > 1:
                    level = low + ((q & np.uint64(0xFFFFFFFF)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
                    ok = level < live_w
                    yield (live_d * m + slot)[ok], t[ok], r[ok]
                else:
                    yield live_d * m + slot, t, r
            more = w > low + size
            h, w, doc = h[more], w[more], doc[more]
            block += 1


def signatures(h: np.ndarray, w: np.ndarray, first: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """(documents, m) identities of each register's first point; rows of documents without shingles stay 0."""
    docs = len(first) - 1
    sig = np.zeros((docs, m), np.uint64)
    doc = np.repeat(np.arange(docs), np.diff(first))
    total = np.bincount(doc, w, docs)
    todo = np.flatnonzero(total > 0)
    factor = 2.0
    while len(todo):
        horizon = np.zeros(docs)
        horizon[todo] = m * (math.log(m) + factor) / total[todo]
        take = horizon[doc] > 0
        best = np.full(docs * m, np.inf)
        parts = list(_points(h[take], w[take], doc[take], horizon, m))
        for slot, t, _ in parts:
            np.minimum.at(best, slot, t)
        flat = sig.reshape(-1)
        for slot, t, r in parts:
            won = t == best[slot]
            flat[slot[won]] = r[won]
        empty = np.isinf(best.reshape(docs, m)[todo]).any(axis=1)
        todo = todo[empty]
        factor = 2 * factor + 4
    return sig


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """(documents, bands) 64-bit keys; the band's number is part of its key."""
    with np.errstate(over="ignore"):
        key = np.zeros((len(sig), bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64) * _GOLD
        for r in range(rows):
            key = mix(key ^ sig[:, r:bands * rows:rows])
    return key


def overlap(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two multisets given as sorted hash arrays with repeats."""
    n = len(a) + len(b)
    if not n:
        return 0.0
    both = np.concatenate([np.unique(a), np.unique(b)])
    both.sort()
    shared = both[1:][both[1:] == both[:-1]]
    common = 0
    if len(shared):
        ca = np.searchsorted(a, shared, "right") - np.searchsorted(a, shared, "left")
        cb = np.searchsorted(b, shared, "right") - np.searchsorted(b, shared, "left")
        common = int(np.minimum(ca, cb).sum())
    return common / (n - common)
