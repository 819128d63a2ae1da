"""A compressed FM-index over word sequences: backward search on a wavelet matrix.

Symbols are dense word numbers; sequences are parted by a symbol of their own, so no
match crosses them. Rows are sorted by their first DEPTH symbols, which is all that
patterns of up to DEPTH symbols need. The wavelet matrix keeps the transform as packed
bits with one running count per 64, about log2(words) bits a symbol.

All searches advance together, one symbol at a time, as numpy arrays.
"""

from __future__ import annotations

import numpy as np

DEPTH = 64


def sort_rows(s: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes' first DEPTH symbols (prefix doubling)."""
    n = len(s)
    rank = s.astype(np.int64)
    size = 1
    order = np.argsort(rank, kind="stable")
    while size < DEPTH:
        after = np.zeros(n, np.int64)
        after[:n - size] = rank[size:] + 1 if n > size else 0
        key = rank * (int(rank.max()) + 2) + after
        order = np.argsort(key)
        sorted_key = key[order]
        step = np.zeros(n, np.int64)
        step[1:] = np.cumsum(sorted_key[1:] != sorted_key[:-1])
        rank = np.empty(n, np.int64)
        rank[order] = step
        size *= 2
        if n == 0 or step[-1] == n - 1:
            break
    return order


class WaveletMatrix:
    """Counts of a symbol before a position."""

    def __init__(self, s: np.ndarray, n_symbols: int):
        self.levels = max(1, int(n_symbols - 1).bit_length())
        self.words, self.before, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            bit = (s >> level & 1).astype(np.uint8)
            packed = np.packbits(bit, bitorder="little")
            packed = np.concatenate([packed, np.zeros(-len(packed) % 8 + 8, np.uint8)]).view(np.uint64)
            self.words.append(packed)
            self.before.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)[:-1]]).astype(np.int32))
            self.zeros.append(int(len(s) - bit.sum()))
            s = np.concatenate([s[bit == 0], s[bit == 1]])
        self.start = self.follow(np.zeros(n_symbols, np.int64), np.arange(n_symbols))

    def follow(self, at: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Position in the symbol's leaf order to which ``at`` leads."""
        for k in range(self.levels):
            block = at >> 6
            ones = self.before[k][block] + np.bitwise_count(self.words[k][block] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)))
            at = np.where(symbol >> (self.levels - 1 - k) & 1, self.zeros[k] + ones, at - ones)
        return at

    def rank(self, at: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        return self.follow(at, symbol) - self.start[symbol]


class FMIndex:
    def __init__(self, s: np.ndarray, n_symbols: int):
        order = sort_rows(s)
        self.size = len(s)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=n_symbols))])
        self.transform = WaveletMatrix(s[order - 1], n_symbols)  # of the first position: the last symbol, a separator

    def extend(self, lo: np.ndarray, hi: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: rows of the pattern with ``symbol`` put before it."""
        both = self.transform.rank(np.concatenate([lo, hi]), np.concatenate([symbol, symbol])) + np.tile(self.first[symbol], 2)
        return both[:len(lo)], both[len(lo):]


def repeated_windows(index: FMIndex, s: np.ndarray, begin: np.ndarray, length: np.ndarray, window: int) -> np.ndarray:
    """For each sequence s[begin:begin + length] of the index, which of its windows occur
    at more than one place of the index: flags [sequence, window].

    Matching statistics by thresholds: a backward search from a window's end stops where
    the pattern occurs once. Every window that holds that pattern is then unique, so the
    search goes on at the next window that does not. While windows repeat, the next
    search covers several at once, up to DEPTH words, and fewer after it failed.
    """
    n_windows = length - window + 1
    flags = np.zeros((len(begin), int(n_windows.max(initial=0))), bool)
    most = DEPTH - window
    # of each running search: its sequence, its first window, windows it covers beyond, next word, rows
    q = np.flatnonzero(n_windows > 0)
    w = np.zeros(len(q), np.int64)
    more = np.zeros(len(q), np.int64)
    at = w + window - 1
    lo, hi = np.zeros(len(q), np.int64), np.full(len(q), index.size, np.int64)
    while len(q):
        lo, hi = index.extend(lo, hi, s[begin[q] + at])
        once = hi - lo <= 1
        whole = ~once & (at == w)
        ended = np.flatnonzero(once | whole)
        at = at - 1
        if not len(ended):
            continue
        for k in range(int(more[ended].max()) + 1):
            hit = ended[whole[ended] & (more[ended] >= k)]
            flags[q[hit], w[hit] + k] = True
        e_w, e_more, e_at = w[ended], more[ended], at[ended] + 1
        good = whole[ended]
        failed_wide = ~good & (e_more > 0)
        # after a success go on behind it; after a failure at word p the windows up to p are unique
        new_w = np.where(good, e_w + e_more + 1, np.where(failed_wide, e_w, e_at + 1))
        new_more = np.where(good, np.maximum(2 * e_more, 7), np.where(failed_wide, e_more // 2, 0))
        left = n_windows[q[ended]] - 1 - new_w
        new_more = np.minimum(np.minimum(new_more, most), np.maximum(left, 0))
        w[ended], more[ended] = new_w, new_more
        at[ended] = new_w + new_more + window - 1
        lo[ended], hi[ended] = 0, index.size
        done = ended[left < 0]
        if len(done):
            keep = np.ones(len(q), bool)
            keep[done] = False
            q, w, more, at, lo, hi = q[keep], w[keep], more[keep], at[keep], lo[keep], hi[keep]
    return flags
