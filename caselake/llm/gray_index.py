"""Hierarchical index over 64-bit fingerprints in Gray order, on arrays.

Fingerprints sorted by Gray rank lie next to others that differ in few bits. A
leaf groups neighbours; a node keeps the bits all of its fingerprints share (a
mask and a pattern). Two nodes are compared on the bits both share: what differs
there differs for every pair below, and is carried down, so whole groups drop out
once it exceeds the radius. Children only look at the bits new to them.

Within a bucket the result is a spanning forest, never all pairs: pairs of groups
that are already in one component are left out, too.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

LEAF = 32
FANOUT = 8

#: Whether pairs of positions, near enough in their codes, are links.
Accept = Callable[[np.ndarray, np.ndarray], np.ndarray]


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence."""
    rank = codes.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank ^ (rank >> np.uint64(shift))
    return rank


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class Forest:
    """Union-find whose roots are the smallest members."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        while True:
            up = self.parent[x]
            if np.array_equal(up, x):
                return x
            x = up

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join all pairs at once: each larger root hangs itself below a smaller one."""
        while len(a):
            a, b = self.roots(a), self.roots(b)
            apart = a != b
            low, high = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
            np.minimum.at(self.parent, high, low)
            a, b = low, high
        self.parent = self.roots(self.parent)


def _levels(codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """From the leaves up to one root level: (first code, mask of shared bits, their pattern)."""
    first = np.arange(0, len(codes), LEAF)
    every, some = np.bitwise_and.reduceat(codes, first), np.bitwise_or.reduceat(codes, first)
    levels = [(first, ~(every ^ some), every)]
    while len(first) > FANOUT:
        group = np.arange(0, len(first), FANOUT)
        every, some = np.bitwise_and.reduceat(every, group), np.bitwise_or.reduceat(some, group)
        first = first[group]
        levels.append((first, ~(every ^ some), every))
    return levels


def _leaf_links(codes: np.ndarray, ends: np.ndarray, radius: int, forest: Forest, accept: Accept | None) -> None:
    """Links between fingerprints of one leaf; ``ends`` is where the leaf of each stops."""
    at = np.arange(len(codes))
    left, right = [], []
    for step in range(1, LEAF):
        a = at[at + step < ends]
        if not len(a):
            break
        a = a[differing(codes[a], codes[a + step]) <= radius]
        if accept:
            a = a[accept(a, a + step)]
        left.append(a)
        right.append(a + step)
    if left:
        forest.join(np.concatenate(left), np.concatenate(right))


def components(codes: np.ndarray, buckets: np.ndarray, radius: int, accept: Accept | None = None) -> np.ndarray:
    """For codes sorted by bucket and Gray rank: the index of the first code of its component inside its bucket.

    Without ``accept`` all codes within the radius are links, else those of them it accepts.
    """
    n = len(codes)
    forest = Forest(n)
    if not n:
        return forest.parent
    starts = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]]))
    sizes = np.diff(np.append(starts, n))
    bucket_start = np.repeat(starts, sizes)
    at = np.arange(n)
    leaf_end = np.minimum(bucket_start + ((at - bucket_start) // LEAF + 1) * LEAF, np.repeat(starts + sizes, sizes))
    _leaf_links(codes, leaf_end, radius, forest, accept)
    for start, size in zip(starts[sizes > LEAF], sizes[sizes > LEAF]):
        _descend(codes[start : start + size], int(start), radius, forest, accept)
    return forest.parent


def _descend(codes: np.ndarray, offset: int, radius: int, forest: Forest, accept: Accept | None) -> None:
    """Links between different leaves of one bucket."""
    levels = _levels(codes)
    top = len(levels) - 1
    nodes = np.arange(len(levels[top][0]))
    a, b = (x.ravel() for x in np.meshgrid(nodes, nodes, indexing="ij"))
    a, b = a[a <= b], b[a <= b]
    acc, known = np.zeros(len(a), np.int64), np.zeros(len(a), np.uint64)
    for level in range(top, -1, -1):
        first, mask, pattern = levels[level]
        shared = mask[a] & mask[b]
        acc = acc + np.bitwise_count((pattern[a] ^ pattern[b]) & shared & ~known)
        keep = acc <= radius
        single = _single_roots(first, len(codes), offset, forest)
        keep &= ~((single[a] >= 0) & (single[a] == single[b]))
        a, b, acc, known = a[keep], b[keep], acc[keep], shared[keep]
        if level:
            a, b, acc, known = _children(a, b, acc, known, len(levels[level - 1][0]))
    _across(codes, a[a < b], b[a < b], offset, radius, forest, accept)


def _single_roots(first: np.ndarray, n: int, offset: int, forest: Forest) -> np.ndarray:
    """The component of each node if all below it are in one, else -1."""
    roots = forest.parent[offset : offset + n]
    low, high = np.minimum.reduceat(roots, first), np.maximum.reduceat(roots, first)
    return np.where(low == high, low, -1)


def _children(a, b, acc, known, n: int):
    step = np.arange(FANOUT)
    i = (a[:, None, None] * FANOUT + step[None, :, None] + 0 * step[None, None, :]).ravel()
    j = (b[:, None, None] * FANOUT + 0 * step[None, :, None] + step[None, None, :]).ravel()
    acc, known = np.repeat(acc, FANOUT**2), np.repeat(known, FANOUT**2)
    keep = (i < n) & (j < n) & (i <= j)
    return i[keep], j[keep], acc[keep], known[keep]


def _across(codes: np.ndarray, a: np.ndarray, b: np.ndarray, offset: int, radius: int, forest: Forest, accept: Accept | None, batch: int = 512) -> None:
    """Compare surviving pairs of leaves code by code, a batch at a time.

    Pairs that earlier batches have put into one component are left out; all that
    remain are looked through again whenever as many batches have passed as before.
    """
    n, step = len(codes), np.arange(LEAF)
    first = np.arange(0, n, LEAF)
    done, look = 0, 0
    while len(a):
        if done >= look:
            single = _single_roots(first, n, offset, forest)
            apart = (single[a] < 0) | (single[a] != single[b])
            a, b, look = a[apart], b[apart], 2 * done + 1
        i, j, a, b, done = a[:batch], b[:batch], a[batch:], b[batch:], done + 1
        x, y = np.minimum(i[:, None] * LEAF + step, n - 1), np.minimum(j[:, None] * LEAF + step, n - 1)
        near = differing(codes[x][:, :, None], codes[y][:, None, :]) <= radius
        p, q, r = np.nonzero(near)
        left, right = offset + x[p, q], offset + y[p, r]
        if accept:
            kept = accept(left, right)
            left, right = left[kept], right[kept]
        forest.join(left, right)
