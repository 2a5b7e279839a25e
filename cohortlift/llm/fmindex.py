"""FM-index over the words of one training shard: wavelet-tree ranks, backward search, sampled suffix positions."""

from __future__ import annotations

import numpy as np

#: Every SAMPLE-th text position of a shard is kept in the index; others are reached by walking back.
SAMPLE = 8


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order: sorted by their first symbols, then by doubling; only suffixes that still tie are sorted again."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    # as many symbols as a key of 63 bits holds; 0 stands behind the end
    bits = int(text.max() + 1).bit_length()
    length = max(1, 63 // bits)
    padded = np.r_[text + 1, np.zeros(length, np.int64)]
    key = padded[:n].copy()
    for k in range(1, length):
        key = key << bits | padded[k : n + k]
    order = np.argsort(key)
    value = key[order]
    first = np.r_[True, value[1:] != value[:-1]]
    # rank: where the group of a suffix starts
    rank = np.full(n + 1, -1, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    # places in groups of two or more
    places = np.flatnonzero(~(first & np.r_[first[1:], True]))
    while len(places):
        suffix = order[places]
        key = rank[suffix] * (n + 1) + rank[np.minimum(suffix + length, n)] + 1
        again = np.argsort(key)
        suffix, key = suffix[again], key[again]
        order[places] = suffix
        new = np.r_[True, key[1:] != key[:-1]]
        rank[suffix] = np.maximum.accumulate(np.where(new, places, 0))
        places = places[~(new & np.r_[new[1:], True])]
        length *= 2
    return order


class Wavelet:
    """Ranks of symbols in a sequence, one level of bits for each bit of the alphabet: zeros first, then ones, stable (wavelet matrix)."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.bits = max(1, int(alphabet - 1).bit_length())
        self.ones, self.zeros = [], []
        now = symbols.astype(np.int32)
        for level in range(self.bits - 1, -1, -1):
            bit = (now & 1 << level) != 0
            ones = np.zeros(len(bit) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(bit) - int(ones[-1]))
            now = np.concatenate((now[~bit], now[bit]))

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each end."""
        low, high = np.zeros_like(end), end.copy()
        for k in range(self.bits):
            one = (symbol >> (self.bits - 1 - k) & 1).astype(bool)
            a, b = self.ones[k][low], self.ones[k][high]
            low, high = np.where(one, self.zeros[k] + a, low - a), np.where(one, self.zeros[k] + b, high - b)
        return high - low


class FMIndex:
    """text: symbols from 1 on; 0 stands behind its end."""

    def __init__(self, text: np.ndarray, alphabet: int):
        full = np.r_[text, 0].astype(np.int64)
        suffixes = suffix_array(full)
        self.last = full[suffixes - 1]
        self.before = np.r_[0, np.cumsum(np.bincount(full, minlength=alphabet))]
        self.ranks = Wavelet(self.last, alphabet)
        kept = suffixes % SAMPLE == 0
        self.kept, self.nth_kept, self.kept_at = kept, np.cumsum(kept) - 1, suffixes[kept]
        self.n = len(full)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """phrases (n, length) of symbols, below zero for unknown ones -> the rows [low, high) of suffixes that start with each."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n)
        high[(phrases < 0).any(1)] = 0
        for k in range(phrases.shape[1] - 1, -1, -1):
            live = np.flatnonzero(low < high)
            c = phrases[live, k]
            low[live], high[live] = (self.before[c] + self.ranks.rank(c, end[live]) for end in (low, high))
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text positions of these suffix rows: steps back to a sampled one."""
        out, todo, steps = np.empty(len(rows), np.int64), np.arange(len(rows)), 0
        row = rows.copy()
        while len(todo):
            known = self.kept[row]
            out[todo[known]] = self.kept_at[self.nth_kept[row[known]]] + steps
            todo, row = todo[~known], row[~known]
            c = self.last[row]
            row = self.before[c] + self.ranks.rank(c, row)
            steps += 1
        return out
