"""SimHash near-duplicates: fingerprints of word shingles, linked in Gray order.

Tables. Two fingerprints within the radius r differ in at most r of r + 4 blocks,
so at least four blocks agree; the tables take triples of blocks so chosen that
any four agreeing blocks hold one of them. Rows of a table that agree in its
triple form a bucket. Only distinct fingerprints are dealt out.

Buckets. A bucket of more than ``PAGE`` fingerprints is dealt by hash into pages,
and each pair of pages is a unit of its own, so no task holds more than two
pages. Within a unit the hierarchical index (``gray_index``) finds the components
and gives one row per linked fingerprint, never all pairs.

Defined results: a null or empty text has fingerprint zero and is linked like any
other; texts shorter than a shingle hash whole; repeated rows and equal texts
share a component; a null doc_id never is a component's id unless all are null;
an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.llm import gray_index
from caselake.llm.components import connected
from caselake.llm.storage import materialized

SHINGLE = 4
SEED = 42
RADIUS = 4
#: Most distinct fingerprints of one bucket that a task takes at once.
PAGE = 50_000
#: Shingles whose bits are counted at once.
VOTES = 65_536


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit i is 1 if it is set in over half the hashes of the text's shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only ASCII space cuts
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    spans = zip(starts[:n].tolist(), ends[-n:].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[s:e], SEED) for s, e in spans), np.uint64, n)
    votes = np.zeros(64, np.int64)
    for k in range(0, n, VOTES):
        votes += _bit_counts(hashes[k : k + VOTES])
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have bit i, for each i."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.add.reduce(bits, axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp: the fingerprint's 64 bits as a long."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column("text")), np.uint64, len(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(hashed, "doc_id long, fp long")


def triples(blocks: int) -> list[tuple[int, int, int]]:
    """Triples such that any four of the blocks hold one: three classes, and all triples
    inside a class or with two blocks in one class and the third in the next."""
    kind = [b % 3 for b in range(blocks)]
    chosen = []
    for t in combinations(range(blocks), 3):
        held = [sum(kind[b] == c for b in t) for c in range(3)]
        if 3 in held or any(held[c] == 2 and held[(c + 1) % 3] == 1 for c in range(3)):
            chosen.append(t)
    return chosen


def masks(radius: int) -> list[int]:
    """The bits each table agrees on."""
    blocks = radius + 4
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    bits = [((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in range(blocks)]
    return [bits[a] | bits[b] | bits[c] for a, b, c in triples(blocks)]


def gray(fp: Column) -> Column:
    """Gray rank, shifted so that signed order is rank order."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))


def table_masks(radius: int) -> list[int]:
    """``masks`` as signed longs."""
    return [m - (1 << 64) if m >> 63 else m for m in masks(radius)]


def paged(dealt: DataFrame, page: int, carried: list[str]) -> DataFrame:
    """bucket, i, j, fp and ``carried`` of rows (t, key, fp, carried) whose bucket holds another one.

    ``carried`` tells rows apart; rows of a large bucket are dealt into pages by its
    first column, or by fp without any, and every pair of pages (i, j) is a unit.
    """
    pages = dealt.groupBy("t", "key").agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 1")
    pages = pages.select("t", "key", F.ceil(F.col("cnt") / page).cast("int").alias("pages"))
    mine = F.pmod(F.xxhash64((carried or ["fp"])[0], F.lit(1)), F.col("pages")).cast("int")
    rows = dealt.join(pages, ["t", "key"]).select(F.xxhash64("t", "key").alias("bucket"), "fp", *carried, "pages", mine.alias("mine"))
    rows = rows.select("bucket", "fp", *carried, "mine", F.explode(F.sequence(F.lit(0), F.col("pages") - 1)).alias("other"))
    return rows.select("bucket", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "fp", *carried)


def links(distinct: DataFrame, radius: int = RADIUS, page: int = PAGE) -> DataFrame:
    """Links (a, b) between fingerprints whose components are those of all pairs within ``radius``."""
    spark = distinct.sparkSession
    tables = F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in table_masks(radius)])).alias("t", "key")
    rows = paged(distinct.select("fp", tables), page, [])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for units, fps in whole_units(batches, ["fp"]):
            codes = fps.view(np.uint64)
            first = gray_index.components(codes, units, radius)
            linked = np.flatnonzero(first != np.arange(len(first)))
            yield pa.RecordBatch.from_pydict({"a": codes[linked].view(np.int64), "b": codes[first[linked]].view(np.int64)}, LINKS)

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    units = rows.repartition(n, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", gray(F.col("fp")))
    return units.mapInArrow(find, "a long, b long")


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def whole_units(batches: Iterator[pa.RecordBatch], columns: list[str], least: int = 100_000) -> Iterator[list[np.ndarray]]:
    """Unit numbers and the columns of whole units, some at a time; a unit is at most two pages."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0
    for batch in batches:
        held.append(tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("bucket", "i", "j", *columns)))
        size += len(batch)
        if size < least:
            continue
        bucket, i, j, *rest = (np.concatenate(c) for c in zip(*held))
        last = (bucket == bucket[-1]) & (i == i[-1]) & (j == j[-1])
        cut = size - int(last[::-1].argmin()) if not last.all() else 0
        if cut:
            yield [_numbered(bucket[:cut], i[:cut], j[:cut]), *(c[:cut] for c in rest)]
        held, size = [(bucket[cut:], i[cut:], j[cut:], *(c[cut:] for c in rest))], size - cut
    if size:
        bucket, i, j, *rest = (np.concatenate(c) for c in zip(*held))
        yield [_numbered(bucket, i, j), *rest]


def _numbered(*keys: np.ndarray) -> np.ndarray:
    new = np.zeros(len(keys[0]), bool)
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.cumsum(new)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id reachable) for every document."""
    marked = materialized(fingerprints(docs, shingle), "fingerprints")
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    found = connected(links(distinct.select("fp"), radius))
    # fingerprints without a link are their own component
    rooted = distinct.join(found.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    # written, so that both sides of the join are plain exchanges, which Spark splits at a root with very many members
    rooted = materialized(rooted, "roots")
    least = materialized(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "components")
    members = rooted.join(least, "root").select("fp", "component_id")
    return marked.join(members, "fp").select("doc_id", "fp", "component_id")


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
