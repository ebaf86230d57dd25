"""Signature trees: an all-pairs join of token sets by Jaccard similarity within one task's worth of sets.

A set's signature is a bitmap of hashed tokens, at least as wide as the set is large.  Sets are
sorted by size; LEAF of them make a leaf, FAN nodes make a node of the next level, and a node holds the
OR of the bitmaps below it and the range of sizes.  Two trees (or one with itself) are traversed
together.  A pair of nodes is dropped if their sizes cannot reach the threshold, if the bits that the
two ORs have in common leave room for too small an overlap, or if all below is in one component
already.  At the leaves the signatures' XOR bounds each pair's difference from below: exact, since two
bits that differ come from two tokens that differ.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

LEAF, FAN = 64, 4
#: Bits of a signature: a power of two, at least the set's size and at least this.
LEAST_BITS = 256


def signature(tokens: np.ndarray) -> bytes:
    """The bitmap of a set of 64-bit tokens.  Halving a bitmap by OR gives that of half the width."""
    width = max(LEAST_BITS, 1 << (len(tokens) - 1).bit_length()) if len(tokens) else LEAST_BITS
    bits = np.zeros(width, np.uint8)
    bits[(tokens >> np.uint64(24)).astype(np.int64) & (width - 1)] = 1
    return np.packbits(bits).tobytes()


def folded(bitmaps: list[np.ndarray], words: int) -> np.ndarray:
    """The bitmaps as rows of so many 64-bit words: wider ones are halved by OR."""
    out = np.empty((len(bitmaps), words), np.uint64)
    for k, b in enumerate(bitmaps):
        out[k] = b if len(b) == words else np.bitwise_or.reduce(b.reshape(-1, words), axis=0)
    return out


class Tree:
    """sizes and bitmaps of sets, sorted by size."""

    def __init__(self, sizes: np.ndarray, bitmaps: list[bytes]) -> None:
        self.order = np.argsort(sizes, kind="stable")
        self.sizes = sizes[self.order].astype(np.int64)
        self.bitmaps = [np.frombuffer(bitmaps[k], np.uint64) for k in self.order]
        edges = [0]
        while edges[-1] < len(sizes):  # a leaf's sizes differ by less than half, so its bitmaps keep nearly their own width
            edges.append(min(edges[-1] + LEAF, int(np.searchsorted(self.sizes, 1.5 * self.sizes[edges[-1]], "right"))))
        #: By level, from the leaves: (first, end, words, OR, most tokens beyond the bits of a set).
        self.levels = [[self._leaf(a, b) for a, b in zip(edges, edges[1:], strict=False)]]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            self.levels.append([self._join(below[k : k + FAN]) for k in range(0, len(below), FAN)])

    def _leaf(self, a: int, b: int) -> tuple:
        words = min(len(x) for x in self.bitmaps[a:b])
        rows = folded(self.bitmaps[a:b], words)
        return a, b, words, np.bitwise_or.reduce(rows, axis=0), int((self.sizes[a:b] - np.bitwise_count(rows).sum(axis=1)).max()), rows

    def _join(self, nodes: list[tuple]) -> tuple:
        words = min(n[2] for n in nodes)
        rows = folded([n[3] for n in nodes], words)
        slack = max(int((self.sizes[n[0] : n[1]] - np.bitwise_count(folded(self.bitmaps[n[0] : n[1]], words)).sum(axis=1)).max()) if n[2] != words else n[4] for n in nodes)
        return nodes[0][0], nodes[-1][1], words, np.bitwise_or.reduce(rows, axis=0), slack, None


class Forest:
    """Components of numbered sets; merges keep the smaller label."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)

    def merge(self, a: int, b: int) -> bool:
        x, y = self.label[a], self.label[b]
        if x == y:
            return False
        self.label[self.label == max(x, y)] = min(x, y)
        return True

    def one(self, some: np.ndarray) -> bool:
        found = self.label[some]
        return bool((found == found[0]).all())


def linked_pairs(left: Tree, right: Tree, left_ids: np.ndarray, right_ids: np.ndarray, forest: Forest, link: Callable[[int, int], bool] | None, percent: int) -> list[tuple[int, int]]:
    """Pairs (numbers of sets) that join components of the forest, one pair a join.

    left_ids, right_ids: the sets' numbers in the forest.  link: the exact test; without it every pair
    that the signatures cannot exclude counts.  right may be left itself.
    """
    same, out = left is right, []
    lid, rid = left_ids[left.order], right_ids[right.order]
    if not len(lid) or not len(rid):
        return out
    # 100 I >= p U holds just if (100 + p) |x ^ y| <= (100 - p) (|x| + |y|)
    up, down = 100 + percent, 100 - percent
    stack = [(len(left.levels) - 1, 0, len(right.levels) - 1, 0)]
    while stack:
        la, a, lb, b = stack.pop()
        x, y = left.levels[la][a], right.levels[lb][b]
        low_x, high_x, low_y, high_y = left.sizes[x[0]], left.sizes[x[1] - 1], right.sizes[y[0]], right.sizes[y[1] - 1]
        if 100 * high_x < percent * low_y or 100 * high_y < percent * low_x:
            continue
        if forest.one(np.concatenate((lid[x[0] : x[1]], rid[y[0] : y[1]]))):
            continue
        words = min(x[2], y[2])
        if not (same and la == lb and a == b) and x[2] == y[2]:
            room = int(np.bitwise_count(x[3] & y[3]).sum()) + min(x[4], y[4])
            if up * room < percent * (low_x + low_y):
                continue
        if la or lb:
            if same and la == lb and a == b:
                kids = range(FAN * a, min(FAN * a + FAN, len(left.levels[la - 1])))
                stack += [(la - 1, i, la - 1, j) for i in kids for j in kids if i <= j]
            elif la >= lb:
                stack += [(la - 1, i, lb, b) for i in range(FAN * a, min(FAN * a + FAN, len(left.levels[la - 1])))]
            else:
                stack += [(la, a, lb - 1, j) for j in range(FAN * b, min(FAN * b + FAN, len(right.levels[lb - 1])))]
            continue
        rows_x = x[5] if x[2] == words else folded(left.bitmaps[x[0] : x[1]], words)
        rows_y = y[5] if y[2] == words else folded(right.bitmaps[y[0] : y[1]], words)
        apart = np.bitwise_count(rows_x[:, None, :] ^ rows_y[None, :, :]).sum(axis=2, dtype=np.int64)
        total = left.sizes[x[0] : x[1], None] + right.sizes[None, y[0] : y[1]]
        fits = up * apart <= down * total
        fits &= 100 * np.minimum(left.sizes[x[0] : x[1], None], right.sizes[None, y[0] : y[1]]) >= percent * np.maximum(left.sizes[x[0] : x[1], None], right.sizes[None, y[0] : y[1]])
        if same and la == lb and a == b:
            fits &= np.triu(np.ones(fits.shape, bool), 1)
        found = np.argwhere(fits)
        found = found[np.argsort(apart[fits], kind="stable")]
        for i, j in found:
            p, q = int(lid[x[0] + i]), int(rid[y[0] + j])
            if forest.label[p] != forest.label[q] and (link is None or link(p, q)):
                forest.merge(p, q)
                out.append((p, q))
    return out
