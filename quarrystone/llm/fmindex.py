"""A full-text index over integer symbols: suffix array, Burrows-Wheeler transform, wavelet tree, sampled positions."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order, by prefix doubling. The last symbol must be the least and occur once."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    n, k = len(text), 1
    order = np.argsort(rank, kind="stable")
    while k < n and (n == 0 or rank.max() < n - 1):
        follow = np.zeros(n, np.int64)
        follow[: n - k] = rank[k:] + 1
        key = rank * (n + 1) + follow
        order = np.argsort(key, kind="stable")
        held = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(held[1:] != held[:-1])))
        k *= 2
    return order


class WaveletTree:
    """Ranks and access on a sequence, a bit of the symbols at a time, high bits first; each level is stored in one row, zeros before ones."""

    def __init__(self, seq: np.ndarray, n_symbols: int):
        self.levels: list[tuple[int, np.ndarray, int]] = []
        for shift in range(max(1, int(n_symbols - 1).bit_length()) - 1, -1, -1):
            bit = (seq >> shift) & 1
            ones = np.zeros(len(seq) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.levels.append((shift, ones, len(seq) - int(ones[-1])))
            seq = np.concatenate((seq[bit == 0], seq[bit == 1]))
        self.begin = self._down(np.arange(n_symbols), np.zeros(n_symbols, np.int64))

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, ones, zeros in self.levels:
            before = ones[at]
            at = np.where((symbols >> shift) & 1, zeros + before, at - before)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self._down(symbols, at) - self.begin[symbols]

    def access_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it occurs before."""
        symbols = np.zeros(len(at), np.int64)
        for shift, ones, zeros in self.levels:
            before = ones[at]
            bit = ones[at + 1] - before
            symbols |= bit.astype(np.int64) << shift
            at = np.where(bit, zeros + before, at - before)
        return symbols, at - self.begin[symbols]


class FMIndex:
    """Index of `text` (symbols of 1 and more; 0 ends it). With `breaks`, 1 is a break, which no phrase may have.

    Breaks are sorted as different symbols, so that suffixes are compared up to the next break only and long repeats cost nothing;
    what follows a break is sampled, so that no step to the left goes over one.
    """

    def __init__(self, text: np.ndarray, n_symbols: int, sample: int = 8, breaks: bool = False):
        text = np.append(text, 0).astype(np.int64)
        at = np.flatnonzero(text == 1) if breaks else np.zeros(0, np.int64)
        ranks = text + len(at)
        ranks[at], ranks[-1] = np.arange(1, len(at) + 1), 0
        sa = suffix_array(ranks)
        bwt = text[sa - 1]
        self.n = len(text)
        self.less = np.concatenate(([0], np.cumsum(np.bincount(bwt, minlength=n_symbols))))
        self.tree = WaveletTree(bwt, n_symbols)
        self.sampled = (sa % sample == 0) | ((bwt == 1) & breaks)
        self.sample_at = np.cumsum(self.sampled) - 1
        self.samples = sa[self.sampled]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows of suffixes that begin with each phrase (rows of symbols, aligned at the right), as half-open ranges: backward search of all phrases together."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for step in range(phrases.shape[1]):
            live = live[lengths[live] > step]
            symbols = phrases[live, phrases.shape[1] - 1 - step]
            a = self.less[symbols] + self.tree.rank(symbols, lo[live])
            b = self.less[symbols] + self.tree.rank(symbols, hi[live])
            lo[live], hi[live] = a, b
            live = live[a < b]
            if not len(live):
                break
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the text of the suffixes at these rows, by steps to the left until a sampled one."""
        out = np.zeros(len(rows), np.int64)
        left, at, steps = np.arange(len(rows)), rows.copy(), 0
        while len(left):
            done = self.sampled[at]
            out[left[done]] = self.samples[self.sample_at[at[done]]] + steps
            left, at = left[~done], at[~done]
            symbols, before = self.tree.access_rank(at)
            at = self.less[symbols] + before
            steps += 1
        return out
