"""Canonical, length-limited Huffman coding of ids, on arrays.

Code lengths come from counts by package-merge, so no code is longer than the
limit and the decoding table has 2^limit entries. A block of ids is coded by
itself; the bit position of every ``STRIDE``-th id is kept, and decoding runs
from all of these positions side by side.
"""

from __future__ import annotations

import numpy as np

#: Longest code in bits; a vocabulary may have 2^LIMIT ids.
LIMIT = 18
#: Ids between two kept bit positions.
STRIDE = 64


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Bits per id (0 for ids that don't occur), of least total under the limit."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) > 1 << limit:
        raise ValueError("more ids than codes of this length")
    if len(used) == 1:
        lengths[used] = 1
    if len(used) < 2:
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.int64)
    n = len(order)
    # Each level holds the ids and the packages (pairs) of the level before, by weight.
    levels, packages = [], np.zeros(0, np.int64)
    for _ in range(limit):
        both = np.concatenate([weights, packages])
        level = np.argsort(both, kind="stable")
        levels.append(level)
        both = both[level]
        pairs = len(both) // 2
        packages = both[: 2 * pairs : 2] + both[1 : 2 * pairs : 2]
    taken, depth = 2 * n - 2, np.zeros(n, np.int64)
    for level in reversed(levels):
        chosen = level[:taken]
        leaves = chosen < n
        depth[chosen[leaves]] += 1
        taken = 2 * int((~leaves).sum())
    lengths[order] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id): the lengths alone determine them."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    codes = np.zeros(len(lengths), np.uint64)
    if len(order):
        limit = int(lengths.max())
        step = np.uint64(1) << (limit - lengths[order].astype(np.uint64))
        at = np.concatenate([[np.uint64(0)], np.cumsum(step)[:-1].astype(np.uint64)])
        codes[order] = at >> (limit - lengths[order].astype(np.uint64))
    return codes


def decoding_table(lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """Entry per ``limit`` bits: id and code length as id << 8 | length; and the limit."""
    limit = int(lengths.max()) if len(lengths) else 0
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    spans = np.int64(1) << (limit - lengths[order].astype(np.int64))
    table = np.zeros(1 << limit, np.int64)
    filled = np.repeat((order.astype(np.int64) << 8) | lengths[order], spans)
    table[: len(filled)] = filled
    return table, limit


def encode(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Bits of the ids, first bit highest, and the bit position of every STRIDE-th id."""
    bits = lengths[ids].astype(np.int64)
    ends = np.cumsum(bits)
    starts = ends - bits
    total = int(ends[-1]) if len(ends) else 0
    # Each code lies in at most two words of 32 bits: add its parts to both.
    words = np.zeros(total // 32 + 2, np.uint64)
    shifted = codes[ids] << (np.uint64(64) - bits.astype(np.uint64) - (starts & 31).astype(np.uint64))
    at = starts >> 5
    first = np.flatnonzero(np.diff(at, prepend=-1))
    if len(at):
        # parts of one word share no bit, so their sum is their union
        words[at[first]] += np.add.reduceat(shifted >> np.uint64(32), first)
        words[at[first] + 1] += np.add.reduceat(shifted & np.uint64(0xFFFFFFFF), first)
    return words.astype(">u4").tobytes()[: (total + 7) // 8], starts[::STRIDE].astype(np.uint32)


def decode(data: bytes, checkpoints: np.ndarray, n: int, table: np.ndarray, limit: int) -> np.ndarray:
    """The ``n`` ids of a block: all runs between checkpoints advance together."""
    if not n:
        return np.zeros(0, np.uint32)
    padded = np.frombuffer(data + b"\0" * 8, np.uint8)
    # 32 bits from every byte on
    wide = (padded[:-3].astype(np.uint32) << 24) | (padded[1:-2].astype(np.uint32) << 16) | (padded[2:-1].astype(np.uint32) << 8) | padded[3:]
    lanes = len(checkpoints)
    out = np.zeros((STRIDE, lanes), np.uint32)
    at = checkpoints.astype(np.int64)
    last = len(wide) - 1
    mask, shift = (1 << limit) - 1, 32 - limit
    for i in range(min(STRIDE, n)):
        # the last run may be shorter: what it reads beyond its end is cut off below
        window = wide[np.minimum(at >> 3, last)].astype(np.int64)
        entry = table[(window >> (shift - (at & 7))) & mask]
        out[i] = entry >> 8
        at += entry & 255
    return np.ascontiguousarray(out.T).reshape(-1)[:n]
