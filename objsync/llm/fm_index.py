"""An FM-index over a sequence of integers: wavelet-tree ranks and sampled positions.

The sequence is sorted by its suffixes once; what is kept is its Burrows-Wheeler
transform as a wavelet tree of packed bits, the symbol counts, and every ``sample``-th
suffix position. All searches take many patterns at once.
"""

from __future__ import annotations

import numpy as np


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Suffix order of ``seq``, whose last symbol occurs once and is the smallest.

    Prefix doubling that sorts again only suffixes which are not yet told apart.
    """
    n = len(seq)
    order = np.argsort(seq, kind="stable")
    rank = np.empty(n, dtype=np.int64)
    rank[order] = _group_starts(seq[order], np.arange(n))
    width = 1
    open_rows = _shared(rank[order])
    while len(open_rows):
        members = order[open_rows]
        after = np.minimum(members + width, n - 1)
        key = rank[members] * np.int64(n) + rank[after]
        by = np.argsort(key, kind="stable")
        order[open_rows] = members[by]
        rank[order[open_rows]] = _group_starts(key[by], open_rows)
        ranks = rank[order[open_rows]]
        open_rows = open_rows[_shared(ranks)]
        width *= 2
    return order


def _group_starts(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """For sorted keys at ``rows``: the row at which each key's group starts."""
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    return rows[np.flatnonzero(new)[np.cumsum(new) - 1]]


def _shared(values: np.ndarray) -> np.ndarray:
    """Places whose value also stands before or after them."""
    same = np.zeros(len(values), dtype=bool)
    equal = values[1:] == values[:-1]
    same[1:] |= equal
    same[:-1] |= equal
    return np.flatnonzero(same)


#: For each place in a word, the bits below it.
_BELOW = (np.uint64(1) << np.arange(64, dtype=np.uint64)) - np.uint64(1)


class _Bits:
    """A packed bit vector with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate(([0], np.cumsum(ones)[:-1])).astype(np.int64)
        self.zeros = len(bits) - int(ones.sum())

    def rank(self, i: np.ndarray) -> np.ndarray:
        word = i >> 6
        bits = self.words.take(word)
        bits &= _BELOW.take(i & 63)
        return self.before.take(word) + np.bitwise_count(bits)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) != 0


class FMIndex:
    """``seq`` holds symbols from 1 to ``sigma - 1``; an end symbol 0 is added.

    ``labels``, one for each place of ``seq``, are kept in suffix order (the document
    array), so that a range of suffixes gives the labels of all places it stands for.
    """

    def __init__(
        self, seq: np.ndarray, sigma: int, sample: int = 8, labels: np.ndarray | None = None
    ):
        seq = np.append(seq, 0).astype(np.int64)
        self.n, self.sigma = len(seq), sigma
        order = suffix_array(seq)
        if labels is not None:
            self.labels = np.append(labels, labels[:1])[order]
        last = seq[order - 1]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(seq, minlength=sigma))))
        self.levels: list[tuple[int, _Bits]] = []
        for shift in reversed(range(max(1, int(sigma - 1).bit_length()))):
            bits = (last >> shift) & 1
            self.levels.append((shift, _Bits(bits)))
            last = np.concatenate((last[bits == 0], last[bits == 1]))
        self._origin = self._down(np.arange(sigma), np.zeros(sigma, dtype=np.int64))
        kept = order % sample == 0
        self._is_kept = _Bits(kept)
        self._kept = order[kept]

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for shift, bits in self.levels:
            ones = bits.rank(i)
            one = (symbol >> shift & 1).astype(bool)
            i = np.where(one, ones + bits.zeros, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol is among the first ``i`` of the transform."""
        return self._down(symbol, i) - self._origin[symbol]

    def step(self, symbol, low, high):
        """Ranges of suffixes that start with ``symbol`` and then as [low, high) do."""
        both = self.rank(np.concatenate((symbol, symbol)), np.concatenate((low, high)))
        base = self.first[symbol]
        return base + both[: len(low)], base + both[len(low) :]

    def search(self, patterns: np.ndarray, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes that start with each row of ``patterns``; empty: none.

        A pattern is given up, with the range it then has, once fewer than ``least``
        suffixes are left.
        """
        m, length = patterns.shape
        # a range for the last symbol is the counts' own
        low = self.first[patterns[:, -1]] if length else np.zeros(m, dtype=np.int64)
        high = self.first[patterns[:, -1] + 1] if length else np.full(m, self.n)
        alive = np.flatnonzero(high - low >= least)
        for j in reversed(range(length - 1)):
            a, b = self.step(patterns[alive, j], low[alive], high[alive])
            low[alive], high[alive] = a, b
            alive = alive[b - a >= least]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions in ``seq`` of the suffixes at ``rows``, by walks to a kept one."""
        out = np.empty(len(rows), dtype=np.int64)
        open_, at, steps = np.arange(len(rows)), rows.astype(np.int64), 0
        while len(open_):
            done = self._is_kept.get(at)
            out[open_[done]] = self._kept[self._is_kept.rank(at[done])] + steps
            open_, at = open_[~done], at[~done]
            symbol, i = np.zeros(len(at), dtype=np.int64), at
            for shift, bits in self.levels:
                bit, ones = bits.get(i), bits.rank(i)
                symbol |= bit.astype(np.int64) << shift
                i = np.where(bit, bits.zeros + ones, i - ones)
            at = self.first[symbol] + i - self._origin[symbol]
            steps += 1
        return out
