"""Fuzzy text ratios from 0 to 100 over longest common subsequences, for whole batches of pairs at once.

ratio = 200 LCS / (|a| + |b|). Texts are matrices of character codes, a row a text, and a pair is two row numbers. A pair's LCS is one lane of 64-bit words: bit i says that letter i of its shorter text
isn't used yet, and one step for each letter of the longer texts serves all lanes (several words a lane, with carries, for texts of over 64 letters). Lanes are sorted by length, so that
a step serves lanes that need it. `partial_ratio` has a lane for each window; a window is only searched if the letters it shares with the shorter text could
beat the pair's most promising window.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.text import match_text

#: Weights of the parts of `wratio`, and the length ratios at which they change.
_UNBASE, _PART, _FAR, _LONGER, _MUCH_LONGER = 0.95, 0.9, 0.6, 1.5, 8.0
#: Lanes that are searched together.
LANES = 1 << 16


@dataclass
class Coded:
    """Texts as rows of character codes, padded with 0, and their lengths."""

    codes: np.ndarray
    sizes: np.ndarray

    def __getitem__(self, rows: np.ndarray) -> Coded:
        return Coded(self.codes[rows], self.sizes[rows])


def coded(texts: list[str]) -> Coded:
    held = np.array(texts or [""], dtype=np.str_)
    out = Coded(np.ascontiguousarray(held).view(np.uint32).reshape(len(held), -1), np.strings.str_len(held).astype(np.int64))
    return out if len(texts) else out[np.arange(0)]


def _cut(codes: np.ndarray, sizes: np.ndarray) -> Coded:
    """Rows cut to a size each."""
    sizes = np.maximum(sizes, 0)
    return Coded(np.where(np.arange(codes.shape[1])[None, :] < sizes[:, None], codes, 0), sizes)


def _by_length(a: Coded, b: Coded) -> tuple[Coded, Coded]:
    """The shorter and the longer text of each pair."""
    width = max(a.codes.shape[1], b.codes.shape[1])
    x, y = (np.pad(t.codes, ((0, 0), (0, width - t.codes.shape[1]))) for t in (a, b))
    swap = a.sizes > b.sizes
    return Coded(np.where(swap[:, None], y, x), np.minimum(a.sizes, b.sizes)), Coded(np.where(swap[:, None], x, y), np.maximum(a.sizes, b.sizes))


def _symbols(short: Coded, long: Coded) -> tuple[np.ndarray, np.ndarray, int]:
    """Both sides' codes as small numbers, 0 for no letter, and how many there are."""
    short_codes, long_codes = short.codes[:, : max(1, short.sizes.max())], long.codes[:, : max(1, long.sizes.max())]
    found, at = np.unique(np.concatenate([[0], short_codes.ravel(), long_codes.ravel()]), return_inverse=True)
    at = at[1:]
    return at[: short_codes.size].reshape(short_codes.shape), at[short_codes.size :].reshape(long_codes.shape), len(found)


def _masks(symbols: np.ndarray, sizes: np.ndarray, n_symbols: int) -> np.ndarray:
    """[word, pair, symbol]: the places of a symbol in a pair's shorter text as bits."""
    out = np.zeros((max(1, -(-int(sizes.max()) // 64)), len(sizes), n_symbols), np.uint64)
    for i in range(int(sizes.max())):
        live = np.flatnonzero(sizes > i)
        out[i >> 6, live, symbols[live, i]] |= np.uint64(1 << (i & 63))
    return out


def _step(free: list[np.ndarray], at: list[np.ndarray]) -> None:
    """One letter of the longer texts: bits of `free` that the letter can use go, with carries from word to word."""
    carry = None
    for w, row in enumerate(free):
        used = row & at[w]
        total = row + used
        if len(free) == 1:
            free[0] = total | (row & ~used)
            return
        over = total < used
        if carry is not None:
            more = total + carry
            over |= more < total
            total = more
        free[w] = total | (row & ~used)
        carry = over.astype(np.uint64)


def _used(free: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
    """How many of the first `sizes` bits are used."""
    out = sizes.copy()
    for w, row in enumerate(free):
        left = np.clip(sizes - 64 * w, 0, 64)
        own = np.where(left == 64, ~np.uint64(0), (np.uint64(1) << np.minimum(left, 63).astype(np.uint64)) - np.uint64(1))
        out -= np.bitwise_count(row & own).astype(np.int64)
    return out


def lcs(a: Coded, b: Coded) -> np.ndarray:
    """The length of the longest common subsequence of each pair of rows."""
    out = np.zeros(len(a.sizes), np.int64)
    short, long = _by_length(a, b)
    order = np.lexsort((long.sizes, -(-short.sizes // 64)))
    for at in range(0, len(order), LANES):
        rows = order[at : at + LANES]
        s, g = short[rows], long[rows]
        own, other, n = _symbols(s, g)
        masks, lanes = [m.ravel() for m in _masks(own, s.sizes, n)], np.arange(len(rows)) * n
        free = [np.full(len(rows), ~np.uint64(0)) for _ in masks]
        for j in range(int(g.sizes.max())):
            _step(free, [m.take(lanes + other[:, j]) for m in masks])
        out[rows] = _used(free, s.sizes)
    return out


def ratios(a: Coded, b: Coded) -> np.ndarray:
    total = a.sizes + b.sizes
    return np.where(total > 0, 200.0 * lcs(a, b) / np.maximum(total, 1), 100.0)


def partial_ratios(a: Coded, b: Coded, above: np.ndarray | float = -1.0) -> np.ndarray:
    """The best ratio of each pair's shorter text with windows of its length in the longer, shortened windows at both ends included.

    Pairs that can't come above `above` needn't be searched, and get a ratio that isn't above it.
    """
    out = np.where((a.sizes == 0) & (b.sizes == 0), 100.0, 0.0)
    some = np.flatnonzero((a.sizes > 0) & (b.sizes > 0))
    short, long = _by_length(a[some], b[some])
    above = np.broadcast_to(above, out.shape)[some]
    order = np.lexsort((long.sizes, short.sizes))
    lanes = np.cumsum((short.sizes + long.sizes - 1)[order])
    for rows in np.split(order, np.searchsorted(lanes, np.arange(LANES, lanes[-1] if len(lanes) else 0, LANES))):
        if len(rows):
            out[some[rows]] = _windows(short[rows], long[rows], above[rows])
    return out


def _windows(short: Coded, long: Coded, above: np.ndarray) -> np.ndarray:
    own, other, n_symbols = _symbols(short, long)
    masks = _masks(own, short.sizes, n_symbols)
    n, m, top = short.sizes, long.sizes, int(short.sizes.max())
    pairs = np.repeat(np.arange(len(n)), n + m - 1)
    firsts = np.concatenate([[0], np.cumsum(n + m - 1)[:-1]])
    # Where each window starts in the longer text, from n - 1 before its begin.
    starts = np.arange(len(pairs)) - firsts[pairs] - (n - 1)[pairs]
    sizes = np.minimum(starts + n[pairs], m[pairs]) - np.maximum(starts, 0)
    padded = np.pad(other, ((0, 0), (top, top)))
    # No more letters can be in common than the window has of those of the shorter text.
    known = (masks != 0).any(0)[np.arange(len(n))[:, None], padded] & (padded > 0)
    before = np.pad(np.cumsum(known, 1), ((0, 0), (1, 0)))
    common = np.minimum(before[pairs, starts + n[pairs] + top] - before[pairs, starts + top], n[pairs])
    bound = 200.0 * common / (n[pairs] + sizes)
    masks, padded, width = [w.ravel() for w in masks], padded.ravel(), padded.shape[1]

    def searched(lanes: np.ndarray) -> np.ndarray:
        p = pairs[lanes]
        at, symbol, size = p * width + starts[lanes] + top, p * n_symbols, n[p]
        free = [np.full(len(lanes), ~np.uint64(0)) for _ in masks]
        for k in range(int(size.max())):
            letter = padded.take(at + k, mode="clip") * (k < size)
            _step(free, [w.take(symbol + letter) for w in masks])
        return 200.0 * _used(free, size) / (size + sizes[lanes])

    best, highest = np.zeros(len(n)), np.maximum.reduceat(bound, firsts)
    likely = np.flatnonzero((bound == highest[pairs]) & (highest > above)[pairs])
    if not len(likely):
        return best
    likely = likely[np.unique(pairs[likely], return_index=True)[1]]
    best[pairs[likely]] = searched(likely)
    rest = np.flatnonzero(bound > np.maximum(best, above)[pairs])
    if len(rest):
        np.maximum.at(best, pairs[rest], searched(rest))
    return best


@dataclass
class Words:
    """Texts with their words sorted, and their distinct words sorted, each followed by a space, with the number of each letter's word."""

    plain: Coded
    ordered: Coded
    distinct: Coded
    numbers: np.ndarray
    holds: np.ndarray

    def __getitem__(self, rows: np.ndarray) -> Words:
        return Words(self.plain[rows], self.ordered[rows], self.distinct[rows], self.numbers[rows], self.holds[rows])


def worded(texts: list[str], vocabulary: dict[str, int]) -> Words:
    """`vocabulary` numbers all words of the texts that are compared."""
    split = [t.split() for t in texts]
    unique = [sorted(set(ws)) for ws in split]
    distinct = coded(["".join(f"{w} " for w in ws) for ws in unique])
    numbers = np.zeros(distinct.codes.shape, np.int64)
    holds = np.zeros((len(texts), len(vocabulary) + 1), bool)
    for i, ws in enumerate(unique):
        own = [vocabulary[w] for w in ws]
        numbers[i, : distinct.sizes[i]] = np.repeat(own, [len(w) + 1 for w in ws])
        holds[i, own] = True
    return Words(coded(texts), coded([" ".join(sorted(ws)) for ws in split]), distinct, numbers, holds)


def vocabulary_of(*texts: list[str]) -> dict[str, int]:
    return {w: i + 1 for i, w in enumerate(sorted({w for side in texts for t in side for w in t.split()}))}


def _common_first(x: Words, y: Words) -> tuple[Coded, Coded]:
    """The distinct words of x, those that y has first, and these alone."""
    n = np.arange(len(x.numbers))
    letter = np.arange(x.numbers.shape[1])[None, :] < x.distinct.sizes[:, None]
    common = letter & y.holds[n[:, None], x.numbers]
    order = np.argsort(np.where(common, 0, np.where(letter, 1, 2)), axis=1, kind="stable")
    codes, size = np.take_along_axis(x.distinct.codes, order, 1), np.maximum(common.sum(1) - 1, 0)
    # The space after the last word goes.
    return _cut(codes, x.distinct.sizes - 1), _cut(codes, size)


def _token_ratios(x: Words, y: Words) -> np.ndarray:
    """The best ratio of the sorted words, of the common words, and of each side's distinct words after the common ones."""
    left, both = _common_first(x, y)
    right, _ = _common_first(y, x)
    sets = ratios(left, right)
    some = np.flatnonzero(both.sizes > 0)
    sets[some] = np.maximum(sets[some], np.maximum(ratios(both[some], left[some]), ratios(both[some], right[some])))
    return np.maximum(ratios(x.ordered, y.ordered), np.where((left.sizes > 0) & (right.sizes > 0), sets, 0.0))


def _partial_token_ratios(x: Words, y: Words, above: np.ndarray) -> np.ndarray:
    """The same of partial ratios, for which common words, as they begin both sides, give 100."""
    shared = (x.holds & y.holds).any(1)
    out = np.where(shared, 100.0, 0.0)
    rest = np.flatnonzero(~shared)
    a, b = x[rest], y[rest]
    found = partial_ratios(a.ordered, b.ordered, above[rest])
    # Without repeated words, the distinct words are the sorted words.
    again = np.flatnonzero((a.ordered.sizes != np.maximum(a.distinct.sizes - 1, 0)) | (b.ordered.sizes != np.maximum(b.distinct.sizes - 1, 0)))
    whole = lambda w: _cut(w.distinct.codes, w.distinct.sizes - 1)
    worded_ = np.flatnonzero((a.distinct.sizes > 0) & (b.distinct.sizes > 0))
    again = np.intersect1d(again, worded_)
    found[again] = np.maximum(found[again], partial_ratios(whole(a[again]), whole(b[again]), above[rest][again]))
    out[rest] = found
    return out


def wratios(x: Words, y: Words) -> np.ndarray:
    """The best of plain, token and partial ratios, the latter weighted down as lengths differ; 0 where a text is empty."""
    out = np.zeros(len(x.plain.sizes))
    n, m = x.plain.sizes, y.plain.sizes
    longer = np.maximum(n, m) / np.maximum(np.minimum(n, m), 1)
    for rows, part in ((longer < _LONGER, None), ((longer >= _LONGER) & (longer <= _MUCH_LONGER), _PART), (longer > _MUCH_LONGER, _FAR)):
        rows = np.flatnonzero(rows & (n > 0) & (m > 0))
        if not len(rows):
            continue
        a, b = x[rows], y[rows]
        best = ratios(a.plain, b.plain)
        if part is None:
            out[rows] = np.maximum(best, _UNBASE * _token_ratios(a, b))
            continue
        best = np.maximum(best, _UNBASE * part * _partial_token_ratios(a, b, best / (_UNBASE * part) - 1e-6))
        out[rows] = np.maximum(best, part * partial_ratios(a.plain, b.plain, best / part - 1e-6))
    return out


def ratio(a: str, b: str) -> float:
    return float(ratios(coded([a]), coded([b]))[0])


def partial_ratio(a: str, b: str) -> float:
    return float(partial_ratios(coded([a]), coded([b]))[0])


def wratio(a: str, b: str) -> float:
    known = vocabulary_of([a], [b])
    return float(wratios(worded([a], known), worded([b], known))[0])


def _over(score):
    """A function of two columns of cleaned texts: each distinct text is coded once a batch."""

    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        (i, x), (j, y) = pd.factorize(a), pd.factorize(b)
        return pd.Series(score(list(x), i, list(y), j))

    return lambda a, b: run(match_text(a), match_text(b))


def pair_partial_ratios(x: list[str], i: np.ndarray, y: list[str], j: np.ndarray) -> np.ndarray:
    """`partial_ratio` of x[i] and y[j] for arrays of places i and j."""
    return partial_ratios(coded(x)[i], coded(y)[j])


def pair_wratios(x: list[str], i: np.ndarray, y: list[str], j: np.ndarray) -> np.ndarray:
    known = vocabulary_of(x, y)
    return wratios(worded(x, known)[i], worded(y, known)[j])


def partial_ratio_of(a: Column, b: Column) -> Column:
    """`partial_ratio` of two text columns, cleaned as for containment."""
    return _over(pair_partial_ratios)(a, b)


def wratio_of(a: Column, b: Column) -> Column:
    """`wratio` of two text columns, cleaned as for containment."""
    return _over(pair_wratios)(a, b)
