"""Vectorised hashes of words and of runs of words, for use inside tasks."""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_PIECE = 1 << 20
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base and of its inverse, modulo 2 to the 64."""
    if base not in _powers or len(_powers[base][0]) < n:
        size = max(n, 1 << 12)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            row = np.full(size, b, np.uint64)
            row[0] = 1
            both.append(np.multiply.accumulate(row))
        _powers[base] = (both[0], both[1])
    up, down = _powers[base]
    return up[:n], down[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _piece(data: np.ndarray) -> np.ndarray:
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    if not edge.size:
        return np.zeros(0, np.uint64)
    starts, ends = edge[::2], edge[1::2]
    up, down = powers(_BYTE_BASE, len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    own = (sums[ends] - sums[starts]) * down[starts]
    return mix(own + (ends - starts).astype(np.uint64) * np.uint64(_WORD_BASE))


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash for each word. Texts of any length are read in pieces that end between words."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw, np.uint8)
    if len(data) <= _PIECE:
        return _piece(data)
    out, at = [], 0
    while at < len(data):
        end = min(at + _PIECE, len(data))
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        out.append(_piece(data[at:end]))
        at = end
    return np.concatenate(out)


def runs(words: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """A 64-bit hash for each run of k consecutive words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    if salt:
        words = mix(words ^ np.uint64(salt))
    up, down = powers(_WORD_BASE, len(words))
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up, out=sums[1:])
    return mix((sums[k:] - sums[:-k]) * down[:n])


def sequence_hash(words: np.ndarray, salt: int = 0) -> int:
    """One signed 64-bit hash of a whole word sequence."""
    whole = runs(words, len(words), salt) if len(words) else np.zeros(1, np.uint64)
    return int((whole ^ mix(np.array([len(words)], np.uint64))).view(np.int64)[0])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` consecutive values, from running minima forwards and backwards within blocks."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(grid, axis=1).ravel()
    backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])
