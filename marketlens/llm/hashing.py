"""Word and shingle hashes of Arrow text columns, vectorised over the column's byte buffer (no per-word Python)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_R = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_R_INV = pow(_R, -1, 1 << 64)
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_POW = np.ones(1, np.uint64)
_INV = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW, _INV
    if len(_POW) < n:
        size = max(n, 1 << 20)
        one = np.ones(1, np.uint64)
        with np.errstate(over="ignore"):
            _POW = np.cumprod(np.concatenate([one, np.full(size, _R, np.uint64)]))
            _INV = np.cumprod(np.concatenate([one, np.full(size, _R_INV, np.uint64)]))
    return _POW, _INV


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without nulls; offsets has one entry more than the column."""
    column = column.cast(pa.large_binary())
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset:column.offset + len(column) + 1]
    base = int(offsets[0])
    raw = np.frombuffer(data, np.uint8)[base:int(offsets[-1])] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - base


def slices(column: pa.Array, limit: int = 1 << 20) -> list[pa.Array]:
    """The column in runs of rows of about ``limit`` bytes each (a longer row is a run of its own)."""
    _, offsets = buffers(column)
    cuts = [0]
    while cuts[-1] < len(column):
        at = int(np.searchsorted(offsets, offsets[cuts[-1]] + limit, side="left"))
        cuts.append(min(max(at, cuts[-1] + 1), len(column)))
    return [column.slice(a, b - a) for a, b in zip(cuts, cuts[1:])]


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start byte, end byte, first word of each document and one past the last) of the words [^\\x20\\x09-\\x0D]+."""
    inside = ~_SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)  # a document starts here: no word spans it
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]]) if len(raw) else inside
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.concatenate([inside[1:], [False]]) if len(raw) else inside
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets, side="left")


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each word's bytes: a polynomial by prefix sums, finished by a mixer."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(raw) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * up[:len(raw)])])
        h = (sums[ends] - sums[starts]) * down[starts]
        return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(seed))


def grams(hashes: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of every run of k hashes (len - k + 1 of them; none where there are fewer)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _powers(len(hashes) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[:len(hashes)])])
        return mix((sums[k:] - sums[:-k]) * down[:n] + np.uint64(seed))
