"""FM-index over a sequence of small integers: suffix order, wavelet-tree ranks, backward search, sampled positions."""

from __future__ import annotations

import numpy as np


class WaveletTree:
    """rank(c, i): how often symbol c occurs before position i, for arrays of both.

    One level per bit of a symbol, high bit first; each level keeps its zeros before its ones and
    the running count of ones.
    """

    def __init__(self, symbols: np.ndarray, largest: int) -> None:
        self.bits = max(int(largest).bit_length(), 1)
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for bit in reversed(range(self.bits)):
            ones = (symbols >> bit) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(ones, dtype=np.int32))).astype(np.int32))
            self.zeros.append(len(symbols) - int(self.ones[-1][-1]))
            symbols = np.concatenate((symbols[ones == 0], symbols[ones == 1]))

    def rank(self, symbol: np.ndarray, position: np.ndarray) -> np.ndarray:
        begin = np.zeros_like(position)
        for level, bit in enumerate(reversed(range(self.bits))):
            ones, zeros = self.ones[level], self.zeros[level]
            right = ((symbol >> bit) & 1) == 1
            before, first = ones[position], ones[begin]
            position = np.where(right, zeros + before, position - before)
            begin = np.where(right, zeros + first, begin - first)
        return position - begin


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes in order. Each 0 ends what can be compared and is a symbol of its own."""
    ends = symbols == 0
    ended = int(ends.sum())
    rank = np.where(ends, np.cumsum(ends) - 1, symbols.astype(np.int64) + ended - 1)
    width, n = 1, len(symbols)
    order = np.argsort(rank, kind="stable")
    while True:
        ahead = np.zeros(n, dtype=np.int64)
        ahead[: max(n - width, 0)] = rank[width:] + 1
        key = rank * (max(int(rank.max()), n) + 2) + ahead
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        rank = np.empty(n, dtype=np.int64)
        rank[order] = new
        if int(new[-1]) == n - 1:
            return order
        width *= 2


class FmIndex:
    """Index of runs of symbols 1..largest, each run closed by a 0."""

    def __init__(self, symbols: np.ndarray, largest: int, sample: int = 8) -> None:
        order = suffix_order(symbols)
        before = symbols[order - 1]
        self.last = before
        counts = np.bincount(symbols, minlength=largest + 2)
        self.first = np.concatenate(([0], np.cumsum(counts)))  # first[c]: suffixes starting with less than c
        self.tree = WaveletTree(before.astype(np.int64), largest)
        # The start of a run is always kept, so that no walk has to cross a 0.
        kept = (order % sample == 0) | (before == 0)
        self.kept = kept
        self.kept_before = np.cumsum(kept) - 1
        self.positions = order[kept]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges [low, high) of the suffixes that start with each row of ``phrases``."""
        last = phrases[:, -1]
        low, high = self.first[last].copy(), self.first[last + 1].copy()
        for column in range(phrases.shape[1] - 2, -1, -1):
            live = np.flatnonzero(low < high)
            symbol = phrases[live, column].astype(np.int64)
            start = self.first[symbol]
            low[live] = start + self.tree.rank(symbol, low[live])
            high[live] = start + self.tree.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows of the suffix order: walk backwards to a kept position."""
        at, steps = rows.copy(), np.zeros(len(rows), dtype=np.int64)
        open_rows = np.flatnonzero(~self.kept[at])
        while len(open_rows):
            row = at[open_rows]
            symbol = self.last[row].astype(np.int64)
            at[open_rows] = self.first[symbol] + self.tree.rank(symbol, row)
            steps[open_rows] += 1
            open_rows = open_rows[~self.kept[at[open_rows]]]
        return self.positions[self.kept_before[at]] + steps
