"""FM-index over a shard of symbol sequences: wavelet-matrix ranks and sampled suffixes."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray, seps: int) -> np.ndarray:
    """Order of all suffixes by prefix doubling.

    ``text`` holds ranks: 0..seps-1 are separators, each used once, so ties
    end at a separator and the doubling stops after the longest repeat.
    The first round packs as many symbols as fit into one sort key.
    """
    n = len(text)
    bits = max(1, int(text.max(initial=0)).bit_length())
    step = max(1, 62 // bits)
    wide = np.zeros(n + step, np.int64)
    wide[:n] = text
    key = np.zeros(n, np.int64)
    for j in range(step):
        key = (key << bits) | wide[j:j + n]
    while True:
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.empty(n, bool)
        new[:1] = True
        new[1:] = sorted_key[1:] != sorted_key[:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        if new.all() or step >= n:
            return order
        after = np.zeros(n, np.int64)
        after[:n - step] = rank[step:]
        key = rank * np.int64(n + 1) + after
        step *= 2


class WaveletMatrix:
    """Ranks and accesses over a symbol sequence, one bit level at a time."""

    def __init__(self, seq: np.ndarray, symbols: int):
        self.levels = max(1, int(symbols - 1).bit_length())
        self.ones, self.zeros = [], []
        x = seq
        for level in range(self.levels - 1, -1, -1):
            bit = (x >> level) & 1
            ones = np.zeros(len(x) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(int(len(x) - ones[-1]))
            x = np.concatenate([x[bit == 0], x[bit == 1]])
        self.first = self._down(np.arange(symbols), np.zeros(symbols, np.int64))

    def _down(self, symbol, at):
        for k in range(self.levels):
            ones = self.ones[k][at]
            bit = (symbol >> (self.levels - 1 - k)) & 1
            at = np.where(bit == 1, self.zeros[k] + ones, at - ones)
        return at

    def rank(self, symbol, at):
        """Occurrences of each symbol before each position."""
        return self._down(symbol, at) - self.first[symbol]

    def access_rank(self, at):
        """The symbol at each position and its rank there."""
        symbol = np.zeros(len(at), np.int64)
        for k in range(self.levels):
            ones = self.ones[k][at].astype(np.int64)
            bit = self.ones[k][at + 1] - ones
            symbol = (symbol << 1) | bit
            at = np.where(bit == 1, self.zeros[k] + ones, at - ones)
        return symbol, at - self.first[symbol]


class FMIndex:
    """Index of segments of symbols 1..symbols-1; 0 stands before each segment.

    Every ``rate``-th text position keeps its suffix position, and so does
    each segment start, so a walk to a sample never leaves its segment.
    """

    def __init__(self, text: np.ndarray, symbols: int, rate: int = 8):
        sep = text == 0
        seps = int(sep.sum())
        ranks = np.where(sep, np.cumsum(sep) - 1, text + seps - 1)
        order = suffix_array(ranks, seps)
        bwt = text[order - 1].astype(np.int64)
        self.bwt = WaveletMatrix(bwt, symbols)
        count = np.bincount(text, minlength=symbols)
        self.start = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
        mask = (order % rate == 0) | (bwt == 0)
        self.sampled = mask
        self.sample_rank = np.cumsum(mask) - 1
        self.sample_pos = order[mask]

    def search(self, patterns: np.ndarray, size: np.ndarray):
        """Suffix ranges [sp, ep) of right-aligned patterns, all searched at once backwards."""
        width = patterns.shape[1]
        last = patterns[:, -1]
        sp, ep = self.start[last].copy(), self.start[last + 1].copy()
        for j in range(1, width):
            live = np.flatnonzero((size > j) & (sp < ep))
            if not len(live):
                break
            c = patterns[live, width - 1 - j]
            sp[live] = self.start[c] + self.bwt.rank(c, sp[live])
            ep[live] = self.start[c] + self.bwt.rank(c, ep[live])
        return sp, np.maximum(sp, ep)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix ranks, by walking back to a sampled suffix."""
        pos = np.empty(len(rows), np.int64)
        todo, at, steps = np.arange(len(rows)), rows.astype(np.int64), 0
        while len(todo):
            hit = self.sampled[at]
            pos[todo[hit]] = self.sample_pos[self.sample_rank[at[hit]]] + steps
            todo, at = todo[~hit], at[~hit]
            c, r = self.bwt.access_rank(at)
            at = self.start[c] + r
            steps += 1
        return pos
