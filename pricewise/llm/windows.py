"""Word windows routed by minimizers.

Every window of WINDOW words holds an anchor: the run of ``m`` words with the least hash. Equal windows have equal anchors, so a shuffle by anchor brings them together
without moving each window on its own: consecutive windows with one anchor travel as
one stretch of words.
"""

from __future__ import annotations

import numpy as np
import xxhash

WINDOW = 35
#: Bits of a run hash that give way to its place.
_PLACE = np.uint64((1 << 20) - 1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(words: list[bytes], seed: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)


def run_hashes(h: np.ndarray, m: int) -> np.ndarray:
    """Hash of every run of m words."""
    n = len(h) - m + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, m, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(m):
            out ^= h[j:j + n]
            out *= _MIX
            out ^= out >> np.uint64(29)
    return out


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every run of w values, by doubling."""
    size, out = 1, x
    while 2 * size <= w:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    return np.minimum(out[:len(x) - w + 1], out[w - size:]) if size < w else out


def stretches(h: np.ndarray, first: np.ndarray, m: int, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first word, windows) of every stretch of the rows whose words begin at
    ``first``; h holds the hashes of all words. The windows of a stretch have their
    anchor at one place, the leftmost of equal ones, so there are window - m + 1 at most
    and equal windows stand in different stretches. A stretch of n windows has
    n + window - 1 words and lies in one row."""
    z = np.zeros(0, np.int64)
    if len(h) < window:
        return np.zeros(0, np.uint64), z, z
    runs = run_hashes(h, m)
    # the low bits hold the place, so that the minimum tells it
    place = sliding_min(runs & ~_PLACE | np.arange(len(runs), dtype=np.uint64) & _PLACE, window - m + 1) & _PLACE
    i = np.arange(len(place), dtype=np.uint64)
    place = (i + ((place - i) & _PLACE)).astype(np.int64)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(row[:len(place)] == row[window - 1:])
    if not len(at):
        return np.zeros(0, np.uint64), z, z
    place, r = place[at], row[at]
    begin = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (r[1:] != r[:-1])])
    return runs[place[begin]], at[begin], np.diff(np.r_[begin, len(at)])
