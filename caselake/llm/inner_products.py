"""Exact top-k by inner product: vectors by descending length, pruned on rotated partial sums.

Every vector becomes whole numbers, floor(64 * x) of each component, so a score is
an integer and comparisons are exact. No vector of a query set is compared with one
that cannot enter its result:

1. All vectors are ranged by descending length into blocks. A rotation (the right
   singular vectors of all of them, from their summed outer products) moves most of
   the length into the first coordinates and keeps inner products.
2. The ``SEEDS`` longest vectors give each query a first threshold, the k-th best
   score among them. A vector shorter than threshold / query length is out of reach
   (Cauchy-Schwarz), so a query block only meets the blocks it can need.
3. In a unit (query block, vector block) vectors stream by descending length. Partial
   sums over the first rotated coordinates, plus the product of the remaining lengths,
   bound the score; only pairs whose bound reaches the threshold are carried on to the
   next coordinates, and those left at the end are scored exactly. Thresholds rise as
   results come in.

A unit holds at most a query block and a slice of vectors in memory. Each unit returns
its best k per query; a window over those gives the result.

Defined results: null vectors and vectors with a null, NaN or infinite component take
no part; a shorter vector counts as padded with zeros, so an empty one scores zero
with everything; a null vec_id is never a query and comes last among ties; a repeated
vec_id is a row of its own and each such row a query of its own, which meets all other
rows; scores beyond 64 bits count as the nearest long; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselake.llm.storage import materialized

SCALE = 64
K = 20
#: Rows a unit holds of its queries, and rows of a block of vectors.
QUERIES = 8_192
VECTORS = 65_536
#: Longest vectors that give the first thresholds.
SEEDS = 4_096
#: Scores computed at once.
CELLS = 1 << 21
#: Shares of the coordinates after which pairs are pruned.
CUTS = (0.25, 0.5, 0.75)
#: Components beyond this are scored exactly, without bounds.
HUGE = float(1 << 40)
LONG = np.iinfo(np.int64)

TABLE = "vec_id long, norm double, v binary"
UNIT = "unit long, kind int, row long, vec_id long, norm double, tau long, v binary"
FOUND = pa.schema([("query", pa.int64()), ("query_id", pa.int64()), ("row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, v (array of double) of the vectors that take part."""
    v = F.col(f"`{vector}`").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(F.col(f"`{key}`").cast("long").alias("vec_id"), v.alias("v")).where(F.col("v").isNotNull() & ~bad)


def scaled(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, norm, v: whole numbers as packed doubles, and their length (infinite for huge ones)."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            offsets = np.asarray(lists.offsets) - lists.offsets[0].as_py()
            with np.errstate(over="ignore"):
                whole = np.clip(np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False)), -1e300, 1e300)
            owner = np.repeat(np.arange(len(lists)), np.diff(offsets))
            squares = np.bincount(owner, np.minimum(np.abs(whole), HUGE) ** 2, len(lists))
            norm = np.sqrt(squares)
            norm[owner[np.abs(whole) > HUGE]] = np.inf
            packed = pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer((offsets * 8).astype("<i4")), pa.py_buffer(whole.astype("<f8"))])
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(norm), packed], ["vec_id", "norm", "v"])

    return rows.mapInArrow(convert, TABLE)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Packed vectors as rows, padded with zeros."""
    lengths = np.diff(np.asarray(pa.Array.from_buffers(pa.int32(), len(column) + 1, [None, column.buffers()[1]], offset=column.offset))) // 8
    out = np.zeros((len(column), width))
    flat = np.frombuffer(b"".join(column.to_pylist()), "<f8")
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def rotation(table: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of all rows, by descending singular value.

    Outer products are summed in each task and then in a few; width squared numbers
    of those few reach the driver.
    """

    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            m = np.clip(matrix(batch.column("v"), width), -HUGE, HUGE)
            total += m.T @ m
        yield pa.RecordBatch.from_pydict({"g": pa.array([total.tobytes()], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width * width)
        for batch in batches:
            for g in batch.column("g"):
                total += np.frombuffer(g.as_buffer(), "<f8")
        yield pa.RecordBatch.from_pydict({"g": pa.array([total.tobytes()], pa.binary())})

    sums = table.select("v").mapInArrow(outer, "g binary").repartition(8).mapInArrow(add, "g binary").collect()
    gram = sum((np.frombuffer(r["g"], "<f8") for r in sums), np.zeros(width * width)).reshape(width, width)
    return np.linalg.eigh(gram)[1][:, ::-1].copy()


@dataclass
class Rows:
    """Some vectors; ``known`` says which ids are not null."""

    row: np.ndarray
    vec_id: np.ndarray
    known: np.ndarray
    norm: np.ndarray
    v: np.ndarray
    tau: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch, width: int) -> Rows:
        ids = batch.column("vec_id")
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        tau = batch.column("tau").fill_null(LONG.min).to_numpy() if "tau" in batch.schema.names else np.full(len(batch), LONG.min)
        return cls(batch.column("row").to_numpy(), ids.fill_null(LONG.max).to_numpy(), known, batch.column("norm").to_numpy(), matrix(batch.column("v"), width), tau)

    def take(self, which) -> Rows:
        return Rows(*(getattr(self, c)[which] for c in ("row", "vec_id", "known", "norm", "v", "tau")))

    @classmethod
    def joined(cls, parts: list[Rows]) -> Rows:
        return cls(*(np.concatenate([getattr(p, c) for p in parts]) for c in ("row", "vec_id", "known", "norm", "v", "tau")))


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row, as longs."""
    top = (np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if top[0] * top[1] * max(1, a.shape[1]) < float(1 << 53):
        return np.einsum("ij,ij->i", a, b).astype(np.int64)  # every partial sum is a whole number a double holds
    whole = (sum(int(x) * int(y) for x, y in zip(p, q)) for p, q in zip(a, b))
    return np.fromiter((min(max(s, LONG.min), LONG.max) for s in whole), np.int64, len(a))


@dataclass
class Best:
    """The best k of each query so far; ``tau`` is the score that a newcomer must reach."""

    queries: Rows
    k: int
    tau: np.ndarray = field(init=False)
    held: list[tuple[np.ndarray, ...]] = field(default_factory=list)
    size: int = 0

    def __post_init__(self):
        self.tau = self.queries.tau.copy()

    def add(self, q: np.ndarray, score: np.ndarray, found: Rows) -> None:
        reach = (score >= self.tau[q]) & (found.row != self.queries.row[q])
        if reach.any():
            self.held.append((q[reach], score[reach], found.known[reach], found.vec_id[reach], found.row[reach]))
            self.size += int(reach.sum())
            if self.size > 4 * self.k * len(self.tau) + CELLS // 8:
                self.prune()

    def prune(self) -> None:
        if not self.held:
            return
        q, score, known, vec_id, row = (np.concatenate(c) for c in zip(*self.held))
        order = np.lexsort((row, vec_id, ~known, ~score, q))  # ~ turns the order round without overflow
        by_query = q[order]
        first = np.flatnonzero(np.diff(by_query, prepend=-1))
        rank = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
        keep, last = order[rank < self.k], order[rank == self.k - 1]
        self.tau[q[last]] = np.maximum(self.tau[q[last]], score[last])
        self.held = [(q[keep], score[keep], known[keep], vec_id[keep], row[keep])]
        self.size = len(keep)

    def rows(self) -> Iterator[pa.RecordBatch]:
        self.prune()
        for q, score, known, vec_id, row in self.held:
            for s in range(0, len(q), 65_536):
                e = slice(s, s + 65_536)
                own = self.queries
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own.row[q[e]]), pa.array(own.vec_id[q[e]]), pa.array(row[e]), pa.array(vec_id[e], mask=~known[e]), pa.array(score[e])], schema=FOUND
                )


class Search:
    """One query block against vectors that come by descending length."""

    def __init__(self, queries: Rows, turned: np.ndarray, k: int):
        need = needed(queries.tau, queries.norm)
        self.queries = queries.take(np.argsort(need, kind="stable"))
        self.best, self.turn = Best(self.queries, k), turned
        width = turned.shape[0]
        self.cuts = sorted({round(width * c) for c in CUTS} | {0, width})
        self.rotated, self.rests = self._parts(self.queries)

    def _parts(self, rows: Rows) -> tuple[np.ndarray, list[np.ndarray]]:
        """Rotated vectors, and the length of what lies behind each cut."""
        rotated = np.clip(rows.v, -HUGE, HUGE) @ self.turn
        squares = np.concatenate([np.cumsum(rotated[:, ::-1] ** 2, axis=1)[:, ::-1], np.zeros((len(rotated), 1))], axis=1)
        return rotated, [np.sqrt(squares[:, c]) for c in self.cuts]

    def meet(self, found: Rows) -> None:
        """Score a slice of vectors against all queries that can still need one of them."""
        longest = found.norm.max(initial=0)
        live = np.flatnonzero(needed(self.best.tau, self.queries.norm) <= longest)
        step = max(1, CELLS // max(1, len(found.row)))
        rotated, rests = self._parts(found)
        for s in range(0, len(live), step):
            self._meet(live[s : s + step], found, rotated, rests)

    def _meet(self, live: np.ndarray, found: Rows, rotated: np.ndarray, rests: list[np.ndarray]) -> None:
        plain = np.isfinite(found.norm).all() and np.isfinite(self.queries.norm[live]).all()
        n = len(found.row)
        if not plain:
            q, c = np.repeat(live, n), np.tile(np.arange(n), len(live))
        else:
            tau = self.best.tau[live].astype(np.float64)
            slack = 1 + 1e-9 * self.queries.norm[live] * found.norm.max(initial=0)
            floor = (tau - slack)[:, None]
            sums = np.zeros((len(live), n))
            at, q = 0, None
            for i, cut in enumerate(self.cuts[1:], 1):
                if q is None:  # all pairs, block-wise
                    sums += self.rotated[live, at:cut] @ rotated[:, at:cut].T
                    left = sums + self.rests[i][live][:, None] * rests[i] >= floor
                    if np.count_nonzero(left) * 8 < left.size or cut == self.cuts[-1]:
                        at_q, c = np.nonzero(left)
                        q, part = live[at_q], sums[at_q, c]
                else:  # the few left, pair by pair
                    part = part + np.einsum("ij,ij->i", self.rotated[q, at:cut], rotated[c, at:cut])
                    left = part + self.rests[i][q] * rests[i][c] >= floor[at_q, 0]
                    q, c, part, at_q = q[left], c[left], part[left], at_q[left]
                at = cut
            if q is None:  # vectors without any component
                q, c = np.repeat(live, n), np.tile(np.arange(n), len(live))
        for s in range(0, len(q), CELLS // 16):
            a, b = q[s : s + CELLS // 16], c[s : s + CELLS // 16]
            self.best.add(a, exact(self.queries.v[a], found.v[b]), found.take(b))


def needed(tau: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """Length below which no vector reaches the threshold of a query; the least that rounding allows."""
    with np.errstate(divide="ignore", invalid="ignore"):
        need = tau.astype(np.float64) * (1 - 1e-9) / norm
    return np.where((tau <= 0) | (norm == 0) | ~np.isfinite(norm), -np.inf, need)


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of largest inner product for every row that ``is_query``
    (a condition on the column vec_id), all other rows being candidates."""
    spark = vectors.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = usable(vectors, key, vector)
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width")).first()
    width, blocks = max(1, size["width"] or 0), max(n, -(-size["n"] // VECTORS))
    ranged = scaled(rows, scale).repartitionByRange(blocks, F.desc("norm"), F.xxhash64("vec_id", "v"))
    ordered = ranged.sortWithinPartitions(F.desc("norm")).withColumn("row", F.monotonically_increasing_id())
    table = materialized(ordered.withColumn("block", F.shiftright("row", 33).cast("int")), "vectors")
    lengths = table.groupBy("block").agg(F.max("norm").alias("norm")).orderBy("block").collect()  # a row per VECTORS rows
    turned = rotation(table, width)
    asked = materialized(_with_thresholds(table, is_query, turned, k, n), "queries")
    # a query block needs the blocks up to its smallest need; a row per QUERIES queries
    needs = asked.groupBy("part").agg(F.min("need").alias("need")).orderBy("part").collect()
    if not lengths or not needs:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    parts = F.array(*[F.struct(F.lit(r["part"]).alias("part"), F.lit(r["need"]).alias("need")) for r in needs])
    spans = F.array(*[F.struct(F.lit(r["block"]).alias("block"), F.lit(r["norm"]).alias("norm")) for r in lengths])
    meeting = F.filter(parts, lambda p: p["need"] <= F.col("norm"))
    met = F.filter(spans, lambda b: b["norm"] >= F.col("need"))
    unit = (F.col("part").cast("long") * blocks + F.col("block")).alias("unit")
    given = table.select("*", F.explode(F.transform(meeting, lambda p: p["part"])).alias("part"))
    given = given.select(unit, F.lit(1).alias("kind"), "row", "vec_id", "norm", F.lit(None).cast("long").alias("tau"), "v")
    asking = asked.select("*", F.explode(F.transform(met, lambda b: b["block"])).alias("block"))
    asking = asking.select(unit, F.lit(0).alias("kind"), "row", "vec_id", "norm", "tau", "v")
    units = asking.unionByName(given).repartitionById(n, F.pmod(F.col("unit"), F.lit(n)).cast("int")).sortWithinPartitions("unit", "kind", F.desc("norm"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, waiting, run = None, [], None
        for u, kind, rows in _slices(batches, width):
            if u != unit:
                if run is not None:
                    yield from run.best.rows()
                unit, waiting, run = u, [], None
            if kind == 0:
                waiting.append(rows)
                continue
            if run is None and waiting:
                run = Search(Rows.joined(waiting), turned, k)
            if run is not None:
                run.meet(rows)
        if run is not None:
            yield from run.best.rows()

    found = units.mapInArrow(search, "query long, query_id long, row long, vec_id long, score long")
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _slices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[int, int, Rows]]:
    """Stretches of one unit and kind, as they come."""
    for batch in batches:
        unit, kind = batch.column("unit").to_numpy(), batch.column("kind").to_numpy()
        edges = np.flatnonzero((np.diff(unit) != 0) | (np.diff(kind) != 0)) + 1
        for s, e in zip([0, *edges.tolist()], [*edges.tolist(), len(batch)]):
            if e > s:
                yield int(unit[s]), int(kind[s]), Rows.of(batch.slice(s, e - s), width)


def _with_thresholds(table: DataFrame, is_query: Column, turned: np.ndarray, k: int, n: int) -> DataFrame:
    """The queries with the k-th best score among the ``SEEDS`` longest vectors (tau), the length they need
    of a vector, and their block (part)."""
    spark, width = table.sparkSession, turned.shape[0]
    seeds = table.orderBy("row").limit(SEEDS).select("row", "vec_id", "norm", "v").toArrow().combine_chunks()
    shared = spark.sparkContext.broadcast(Rows.of(seeds.to_batches()[0], width) if seeds.num_rows else None)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            rows = Rows.of(batch, width)
            run = Search(rows, turned, k)
            for s in range(0, len(shared.value.row), 512):
                run.meet(shared.value.take(slice(s, s + 512)))
            run.best.prune()
            tau = np.empty(len(batch), np.int64)
            tau[np.argsort(needed(rows.tau, rows.norm), kind="stable")] = run.best.tau
            kept = [batch.column(c) for c in ("row", "vec_id", "norm", "v")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(tau), pa.array(needed(tau, rows.norm))], ["row", "vec_id", "norm", "v", "tau", "need"])

    queries = table.where(is_query).select("row", "vec_id", "norm", "v").repartition(n)
    asked = materialized(queries.mapInArrow(ask, "row long, vec_id long, norm double, v binary, tau long, need double"), "asked")
    parts = max(1, -(-asked.count() // QUERIES))
    return asked.repartitionByRange(parts, "need", "row").withColumn("part", F.spark_partition_id())


SQL = """
WITH part AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM part q JOIN part c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 20
"""
