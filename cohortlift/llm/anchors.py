"""Covering codes and the comparison of bit strings that meet at an anchor.

A fingerprint of 64 bits is three blocks: A and B of 23 bits, C of 18. Anchors in A and B are the words of the binary Golay code (length 23,
covering radius 3), anchors in C are the words of a Hamming code on its last 15 bits (covering radius 1): every bit string lies within the
covering radius of an anchor. Let two fingerprints differ in t bits or fewer. Two of their three blocks then differ in s = 2t // 3 bits
together or fewer, and the point half way between them in these two blocks lies h = ceil(s / 2) bits or fewer from both. The anchor that
covers this point is therefore within covering radius plus h of both. So each fingerprint goes to every anchor pair within covering radius
plus h, in the blocks (A, B), (A, C) and (B, C), and each link of t bits or fewer is seen at some anchor.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

#: Generator polynomial of the Golay code, bits and covering radii of the codes.
GOLAY = 0xC75
GOLAY_BITS, GOLAY_RADIUS = 23, 3
HAMMING_BITS, HAMMING_RADIUS = 15, 1
LOW, MASK_B, MASK_C = 18, (1 << GOLAY_BITS) - 1, (1 << HAMMING_BITS) - 1
#: Anchors with more members are searched from member to member, which leaves out those found already.
DENSE = 64


def _remainder(x: int) -> int:
    for bit in range(GOLAY_BITS - 1, 10, -1):
        if x >> bit & 1:
            x ^= GOLAY << (bit - 11)
    return x


class Code:
    """For each syndrome the bit patterns that lead to an anchor, by cost: the bits beyond the covering radius."""

    def __init__(self, bits: int, radius: int, reach: int, parity: list[int]):
        self.bits, self.half = bits, bits // 2
        low, high = np.zeros(1 << self.half, np.int32), np.zeros(1 << (bits - self.half), np.int32)
        for table, start in ((low, 0), (high, self.half)):
            for x in range(len(table)):
                for b in range(int(x).bit_length()):
                    if x >> b & 1:
                        table[x] ^= parity[start + b]
        self.low, self.high = low, high
        found = [(sum(1 << b for b in at), max(0, n - radius)) for n in range(radius + reach + 1) for at in combinations(range(bits), n)]
        pattern, cost = np.array([p for p, _ in found], np.int64), np.array([c for _, c in found], np.int64)
        syndrome = self.syndrome(pattern)
        order = np.lexsort((cost, syndrome))
        self.pattern, self.cost = pattern[order], cost[order]
        # ends[c][s]: where the patterns of cost c or less end for syndrome s
        n = max(parity).bit_length()
        self.start = np.searchsorted(syndrome[order], np.arange(1 << n))
        key = syndrome[order] * (reach + 1) + self.cost
        self.ends = [np.searchsorted(key, np.arange(1 << n) * (reach + 1) + c, "right") for c in range(reach + 1)]

    def syndrome(self, x: np.ndarray) -> np.ndarray:
        return self.low[x & ((1 << self.half) - 1)] ^ self.high[x >> self.half]

    def reach(self, x: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index into x and anchor, for all anchors of x that cost `left` or less (left: per element, below zero for none)."""
        s = self.syndrome(x)
        ends = np.stack(self.ends)[np.maximum(left, 0), s]
        n = np.where(left < 0, 0, ends - self.start[s])
        at = np.repeat(np.arange(len(x)), n)
        pattern = self.pattern[np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n) + self.start[s][at]]
        return at, x[at] ^ pattern


@lru_cache(maxsize=4)
def codes(reach: int) -> tuple[Code, Code]:
    golay = Code(GOLAY_BITS, GOLAY_RADIUS, reach, [_remainder(1 << b) for b in range(GOLAY_BITS)])
    return golay, Code(HAMMING_BITS, HAMMING_RADIUS, reach, [b + 1 for b in range(HAMMING_BITS)])


def half_way(threshold: int) -> int:
    return -(-(2 * threshold // 3) // 2)


def first_anchors(prints: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """prints (n, words) -> row index and key of each anchor in block A and in block B; the key holds word, block and anchor."""
    golay, _ = codes(h := half_way(threshold))
    rows, keys = [], []
    for word in range(prints.shape[1]):
        x = prints[:, word]
        for block, part in enumerate((x >> np.uint64(LOW + GOLAY_BITS), x >> np.uint64(LOW) & np.uint64(MASK_B))):
            at, anchor = golay.reach(part.astype(np.int64), np.full(len(x), h))
            rows.append(at)
            keys.append(anchor | (2 * word + block) << GOLAY_BITS)
    return np.concatenate(rows), np.concatenate(keys)


def links_at(keys: np.ndarray, prints: np.ndarray, threshold: int, total: int) -> np.ndarray:
    """Members of whole first anchors -> index pairs that link what is linked at any anchor pair: (n, 2), without circles.

    Linked: `threshold` bits or fewer differ in the word of the anchor, and `total` or fewer in all words.
    """
    golay, hamming = codes(h := half_way(threshold))
    place, word = keys >> GOLAY_BITS & 1, keys >> (GOLAY_BITS + 1)
    x = prints[np.arange(len(keys)), word]
    a, b, c = ((x >> np.uint64(s) & np.uint64(m)).astype(np.int64) for s, m in ((LOW + GOLAY_BITS, MASK_B), (LOW, MASK_B), (0, MASK_C)))
    left = h - np.maximum(0, np.bitwise_count(np.where(place == 0, a, b) ^ (keys & MASK_B)).astype(np.int64) - GOLAY_RADIUS)
    at_b, in_b = golay.reach(b, np.where(place == 0, left, -1))
    at_c, in_c = hamming.reach(c, left)
    at = np.concatenate((at_b, at_c))
    fine = keys[at] << (GOLAY_BITS + 1) | np.concatenate((in_b, in_c | 1 << GOLAY_BITS))
    order = np.argsort(fine, kind="stable")
    at, fine = at[order], fine[order]
    starts = np.flatnonzero(np.r_[True, fine[1:] != fine[:-1]]) if len(fine) else np.zeros(0, int)
    sizes = np.diff(np.r_[starts, len(fine)])

    def near(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        differ = np.bitwise_count(prints[i] ^ prints[j])
        return (differ[np.arange(len(i)), word[i]] <= threshold) & (differ.sum(1) <= total)

    found = []
    few = np.repeat(sizes <= DENSE, sizes)
    some, group = at[few], np.repeat(np.arange(len(sizes)), sizes)[few]
    for k in range(1, min(DENSE, int(sizes[sizes <= DENSE].max(initial=0)))):
        i = np.flatnonzero(group[k:] == group[:-k])
        p, q = some[i], some[i + k]
        ok = near(p, q)
        found.append(np.stack((p[ok], q[ok]), 1))
    for g in np.flatnonzero(sizes > DENSE):
        found.append(_walk(at[starts[g] : starts[g] + sizes[g]], near))
    return _forest(np.concatenate(found) if found else np.zeros((0, 2), int), len(keys))


def _walk(members: np.ndarray, near) -> np.ndarray:
    """Links along which all linked members are reached: each member found is compared with those not found yet."""
    out, rest = [], members
    while len(rest):
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            one = todo.pop()
            hit = near(np.full(len(rest), one), rest)
            if hit.any():
                out.append(np.stack((np.full(hit.sum(), one), rest[hit]), 1))
                todo.extend(rest[hit])
                rest = rest[~hit]
    return np.concatenate(out) if out else np.zeros((0, 2), int)


def _forest(pairs: np.ndarray, n: int) -> np.ndarray:
    """Those of the links that join what is not joined yet."""
    keys = np.unique(pairs.min(1) * n + pairs.max(1)) if len(pairs) else np.zeros(0, int)
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    out = []
    for p, q in zip((keys // n).tolist() if n else [], (keys % n).tolist() if n else [], strict=True):
        a, b = root(p), root(q)
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append((p, q))
    return np.array(out, int).reshape(-1, 2)
