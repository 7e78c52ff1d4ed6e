"""Benchmark decontamination by q-gram filtering and banded alignment.

A text holds an item within ``k`` edits only if some band of diagonals holds at
least ``L + 1 - q - k * q`` of their common q-grams (q-gram lemma; L the item's
length). Common q-grams are counted in overlapping bands, twice as wide as the
budget needs; regions that reach the bound are verified by a banded alignment.

Texts are compared in lower case with white space collapsed. The benchmark is
dealt into blocks of bounded size; the q-gram index of a block is broadcast and
all documents pass it, so a benchmark of any size takes more passes, not more
memory.

Defined results: null and empty texts match nothing; items shorter than q + 1
characters cannot be told from chance and match nothing; repeated rows and items
match one by one; either table empty gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Q = 12
#: Edits allowed, as a share of the item's length.
EDITS = 0.05
#: Characters of benchmark text in one broadcast index.
BLOCK_CHARS = 4_000_000
#: Characters of documents hashed at once: a slice takes some 60 bytes a character while it is hashed.
SLICE_CHARS = 250_000
#: Common q-grams expanded at once.
HITS = 1_000_000
FILTER_BITS = 22

PRIME = 0x9E3779B97F4A7C15
#: Powers of the prime by which one, two and four characters are shifted.
P1, P2, P4 = (np.uint64(pow(PRIME, n, 1 << 64)) for n in (1, 2, 4))

SCHEMA = "doc_id long, item_id long, start long, end long, edits int"
SCANNED = f"text_key long, {SCHEMA}"
MATCHES = pa.schema([("text_key", pa.int64()), ("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32())])


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget(length: int) -> int:
    """Edits allowed: a share of the length, as far as the lemma still filters."""
    return max(0, min(int(length * EDITS), (length - Q) // Q))


def gram_hashes(chars: np.ndarray) -> np.ndarray:
    """A hash of the Q characters from each position on."""
    x = chars.astype(np.uint64)
    pairs = x[:-1] * P1 + x[1:]
    fours = pairs[:-2] * P2 + pairs[2:]
    eights = fours[:-4] * P4 + fours[4:]
    twelves = eights[:-4] * P4 + fours[8:]
    return (twelves ^ (twelves >> np.uint64(29))) * P1


def chars_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


class Index:
    """q-grams of a block of items: sorted hashes, and where each occurs."""

    def __init__(self, items: list[tuple[int | None, str]]):
        self.items = [(i, t) for i, t in items if len(t) > Q]
        hashes = [gram_hashes(chars_of(t)) for _, t in self.items]
        sizes = [len(h) for h in hashes]
        every = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(every, kind="stable")
        self.item = np.repeat(np.arange(len(sizes)), sizes)[order]
        self.at = (np.concatenate([np.arange(s) for s in sizes]) if sizes else np.zeros(0, np.int64))[order]
        self.hashes, self.first, self.count = np.unique(every[order], return_index=True, return_counts=True)
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.hashes >> np.uint64(64 - FILTER_BITS)] = True
        self.length = np.array([len(t) for _, t in self.items], np.int64)
        self.edits = np.array([budget(n) for n in self.length.tolist()], np.int64)
        self.least = self.length + 1 - Q - self.edits * Q

    def hits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions whose q-gram occurs in an item, and which of the sorted hashes it is."""
        maybe = np.flatnonzero(self.filter[hashes >> np.uint64(64 - FILTER_BITS)])
        found = np.searchsorted(self.hashes, hashes[maybe])
        found = np.minimum(found, len(self.hashes) - 1)
        same = self.hashes[found] == hashes[maybe]
        return maybe[same], found[same]

    def regions(self, position: np.ndarray, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, band) pairs with enough common q-grams, for the hits of one text."""
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        ends = np.cumsum(self.count[gram])
        start = 0
        while start < len(gram):
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + HITS, "right")))
            n = self.count[gram[start:stop]]
            which = np.repeat(self.first[gram[start:stop]], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            item = self.item[which]
            diagonal = np.repeat(position[start:stop], n) - self.at[which] + self.length[item]
            band = diagonal // (self.edits[item] + 1)
            # each diagonal lies in two bands
            key = np.concatenate([(item << 40) + band, (item << 40) + np.maximum(band - 1, 0)])
            key, inverse = np.unique(np.concatenate([keys, key]), return_inverse=True)
            counts = np.bincount(inverse, np.concatenate([counts, np.ones(len(inverse) - len(counts), np.int64)])).astype(np.int64)
            keys, start = key, stop
        item = keys >> 40
        enough = counts >= self.least[item]
        return item[enough], (keys & ((1 << 40) - 1))[enough]


def banded_alignment(item: np.ndarray, region: np.ndarray, edits: int) -> tuple[int, int] | None:
    """(edits, end) of the best place for the whole item in the region, if within the budget.

    Row i of the table is the item's first i characters; only the diagonals from 0
    to len(region) - len(item), widened by the budget, are computed.
    """
    n, m = len(item), len(region)
    width = m - n + 2 * edits + 1
    if width < 1:
        return None
    far = n + m + 1
    step = np.arange(width)
    # column j of row i stands at j - i + edits
    row = np.where((step - edits >= 0) & (step - edits <= m), 0, far)
    for i in range(1, n + 1):
        j = step + i - edits
        inside = (j >= 1) & (j <= m)
        same = np.zeros(width, bool)
        same[inside] = region[j[inside] - 1] == item[i - 1]
        best = np.where(inside, row + ~same, far)
        best[:-1] = np.minimum(best[:-1], row[1:] + 1)
        best = np.where((j >= 0) & (j <= m), best, far)
        # insertions run along the row: a running minimum of best - step
        row = np.minimum.accumulate(best - step) + step
        if row.min() > edits:
            return None
    at = int(row.argmin())
    return (int(row[at]), at + n - edits) if row[at] <= edits else None


def matches(text: str, position: np.ndarray, gram: np.ndarray, index: Index) -> Iterator[tuple[int, int, int, int]]:
    """(item number, start, end, edits) of the items in one normal text: all places of an item that do not overlap."""
    item, band = index.regions(position, gram)
    chars, last = None, (-1, -1)
    for i, b in zip(item.tolist(), band.tolist()):
        k, length, known = int(index.edits[i]), int(index.length[i]), index.items[i][1]
        low = max(0, b * (k + 1) - length - k)
        high = min(len(text), (b + 2) * (k + 1) + 2 * k)
        before = last[1] if last[0] == i else 0  # where the item's last place ends: the next one lies behind it
        at = text.find(known, max(low, before), high)  # no edits: the alignment is the diagonal itself
        if at >= 0:
            yield i, at, at + length, 0
            last = (i, at + length)
            continue
        low = max(low, before - k)  # an edited place may have taken up to k characters of its neighbour
        if high - low < length - k:
            continue
        chars = chars_of(text) if chars is None else chars
        found = banded_alignment(chars_of(known), chars[low:high], k)
        if found:
            end = low + found[1]
            yield i, max(low, before, end - length), end, found[0]
            last = (i, end)


def blocks(benchmark: DataFrame, chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int | None, str]]]:
    """Items in normal form, a bounded number of characters at a time."""
    held, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("long"), "text").toLocalIterator():
        text = normal(row["text"])
        held.append((row["item_id"], text))
        size += len(text)
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


def scan(docs: DataFrame, items: list[tuple[int | None, str]]) -> DataFrame:
    """Matches of one block of items in all documents; text_key (Spark's xxhash64) tells texts of one doc_id apart."""
    shared = docs.sparkSession.sparkContext.broadcast(Index(items))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            rows = []
            for ids, texts in _slices(batch):
                for doc, text, position, gram in _doc_hits(ids, texts, index):
                    rows += [(*doc, index.items[i][0], s, e, k) for i, s, e, k in matches(text, position, gram, index)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), MATCHES.types)], MATCHES.names)

    return docs.select(F.xxhash64("text").alias("text_key"), F.col("doc_id").cast("long"), "text").mapInArrow(found, SCANNED)


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    ids, texts, size = [], [], 0
    for key, doc, text in zip(batch.column("text_key"), batch.column("doc_id"), batch.column("text")):
        text = normal(text.as_py())
        ids.append((key.as_py(), doc.as_py()))
        texts.append(text)
        size += len(text)
        if size >= SLICE_CHARS:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _doc_hits(ids: list, texts: list[str], index: Index) -> Iterator[tuple]:
    """The texts that share a q-gram with an item, with their hits. All texts are hashed as one."""
    mark = "\0" * Q  # no text in normal form that holds it matters less: the verification decides
    joined = mark.join(texts)
    if len(joined) < Q or not len(index.hashes):
        return
    position, gram = index.hits(gram_hashes(chars_of(joined)))
    starts = np.cumsum([0] + [len(t) + Q for t in texts[:-1]])
    owner = np.searchsorted(starts, position, "right") - 1
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    for a, b in zip(first, np.append(first[1:], len(owner))):
        k = int(owner[a])
        yield ids[k], texts[k], position[a:b] - starts[k], gram[a:b]


def contaminated(docs: DataFrame, benchmark: DataFrame, chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, start, end, edits: where documents hold benchmark items.

    Positions are those of the text in normal form.
    """
    return _scanned(docs, benchmark, chars).drop("text_key")


def contaminated_texts(docs: DataFrame, benchmark: DataFrame, chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, text_key of the rows that hold an item: rows of one doc_id are told apart by their texts."""
    return _scanned(docs, benchmark, chars).select("doc_id", "text_key").distinct()


def _scanned(docs: DataFrame, benchmark: DataFrame, chars: int) -> DataFrame:
    found = None
    for items in blocks(benchmark, chars):
        part = scan(docs, items)
        found = part if found is None else found.union(part)
    return found if found is not None else _none(docs.sparkSession)


def _none(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCANNED)
