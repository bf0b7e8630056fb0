"""Signature tree over a bounded group of token sets, and its join with itself.

Tokens that only one set has can't be shared, so they count for sizes alone; each other token has
a bit of its own. A node holds the OR of its sets' bitmaps and the range of their sizes. Two nodes
are compared through the most tokens that two of their sets can share, the number of bits that both
nodes have; and a pair of nodes whose sets are in one class already is left out, so that a large
group of near copies costs links in proportion to its size, not to its square.
"""

from __future__ import annotations

import numpy as np

LEAF = 16
CHUNK = 2048


class Classes:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        if i == j:
            return False
        self.parent[max(i, j)] = min(i, j)
        return True

    def all(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if (up == self.parent).all():
                return up
            self.parent = up


def similar(shared: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """100 * intersection >= percent * union."""
    return (100 + percent) * shared >= percent * (a + b)


def links(sets: list[np.ndarray], percent: int = 75, known: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Pairs of sets that are similar, enough to join all that are joined by a chain of similar
    pairs. ``known``: classes that hold already; pairs within one aren't looked at."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    if n == 2 and known is None:
        shared = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [(0, 1)] if similar(np.int64(shared), sizes[0], sizes[1], percent) else []
    order = np.lexsort((sizes, [s[0] for s in sets]))
    sizes = sizes[order]
    _, code, count = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True, return_counts=True)
    bit = np.cumsum(count > 1) - 1
    row = np.repeat(np.arange(n), sizes)
    used = count[code] > 1
    row, code = row[used], bit[code[used]]
    words = max(1, (int(bit[-1]) + 64) // 64)
    maps = np.zeros((n, words), np.uint64)
    np.bitwise_or.at(maps, (row, code // 64), np.uint64(1) << (code % 64).astype(np.uint64))

    classes = Classes(n)
    if known is not None:
        _, first, group = np.unique(known[order], return_index=True, return_inverse=True)
        classes.parent = first[group]
    out: list[tuple[int, int]] = []

    def compare(a: np.ndarray, b: np.ndarray) -> None:
        for i in range(0, len(a), CHUNK):
            x, y = a[i : i + CHUNK], b[i : i + CHUNK]
            shared = np.bitwise_count(maps[x] & maps[y]).sum(1, dtype=np.int64)
            good = similar(shared, sizes[x], sizes[y], percent)
            for p, q in zip(x[good].tolist(), y[good].tolist(), strict=True):
                if classes.join(p, q):
                    out.append((int(order[p]), int(order[q])))

    compare(np.arange(n - 1), np.arange(1, n))
    for _ in range(4):  # the largest class's first set against all outside; only saves work below
        now = classes.all()
        top = np.bincount(now, minlength=n).argmax()
        other = np.flatnonzero(now != top)
        if len(other) < LEAF:
            break
        compare(np.full(len(other), top), other)

    # levels of the tree, from the leaves up: OR, least and largest size
    cut = np.arange(0, n, LEAF)
    levels = [(np.bitwise_or.reduceat(maps, cut), np.minimum.reduceat(sizes, cut), np.maximum.reduceat(sizes, cut))]
    while len(levels[-1][1]) > 1:
        joined, least, most = levels[-1]
        cut = np.arange(0, len(least), 2)
        levels.append((np.bitwise_or.reduceat(joined, cut), np.minimum.reduceat(least, cut), np.maximum.reduceat(most, cut)))

    a = b = np.zeros(1, np.int64)
    for depth in range(len(levels) - 1, -1, -1):
        joined, least, most = levels[depth]
        now = classes.all()
        width = LEAF << depth
        cut = np.arange(0, n, width)
        low, high = np.minimum.reduceat(now, cut), np.maximum.reduceat(now, cut)
        keep = ~((low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b]))
        keep &= (100 * most[a] >= percent * least[b]) & (100 * most[b] >= percent * least[a])
        a, b = a[keep], b[keep]
        if not len(a):
            return out
        best = np.concatenate([np.bitwise_count(joined[a[i : i + CHUNK]] & joined[b[i : i + CHUNK]]).sum(1, dtype=np.int64) for i in range(0, len(a), CHUNK)])
        good = similar(best, least[a], least[b], percent)
        a, b = a[good], b[good]
        if depth:
            children = len(levels[depth - 1][1])
            pairs = np.concatenate([np.stack([2 * a + i, 2 * b + j], 1) for i in (0, 1) for j in (0, 1)])
            pairs = pairs[(pairs[:, 0] < children) & (pairs[:, 1] < children) & (pairs[:, 0] <= pairs[:, 1])]
            a, b = pairs[:, 0], pairs[:, 1]
    inner = np.arange(LEAF)
    step = max(1, CHUNK // (LEAF * LEAF)) * 8
    for i in range(0, len(a), step):
        x = (a[i : i + step, None, None] * LEAF + inner[None, :, None] + 0 * inner[None, None, :]).ravel()
        y = (b[i : i + step, None, None] * LEAF + inner[None, None, :] + 0 * inner[None, :, None]).ravel()
        good = (x < y) & (y < n)
        x, y = x[good], y[good]
        now = classes.all()
        good = (now[x] != now[y]) & (100 * sizes[x] >= percent * sizes[y]) & (100 * sizes[y] >= percent * sizes[x])
        compare(x[good], y[good])
    return out
