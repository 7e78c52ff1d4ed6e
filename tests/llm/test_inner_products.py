"""Exact top-k by inner product against all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from caselake.llm import inner_products


def plain(rows, every, k=20):
    used = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (q, qv) in enumerate(used):
        if q is None or q % every:
            continue
        scores = [(-min(max(sum(x * y for x, y in zip(qv, cv)), -(2**63)), 2**63 - 1), c is None, c or 0) for b, (c, cv) in enumerate(used) if a != b]
        out += [(q, r + 1, None if null else c, -s) for r, (s, null, c) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def found(spark, rows, every, k=20):
    df = spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows], "vec_id long, embedding array<double>, row string, norm double")
    got = inner_products.top_k(df.repartition(3), F.col("vec_id") % every == 0, k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("spread,k", [(0.05, 20), (1.0, 3), (0.0, 5)])
def test_equals_all_pairs(spark, monkeypatch, spread, k):
    monkeypatch.setattr(inner_products, "SEEDS", 40)
    monkeypatch.setattr(inner_products, "QUERIES", 16)
    monkeypatch.setattr(inner_products, "CELLS", 700)
    rng = np.random.default_rng(int(spread * 100))
    v = rng.normal(size=(700, 24)) * np.geomspace(1, 0.05, 24) * (1 + spread * rng.pareto(1.5, (700, 1)))
    rows = [(i, x.tolist()) for i, x in enumerate(np.round(v, 2))]
    assert found(spark, rows, 7, k) == plain(rows, 7, k)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (5, [1.0, 2.0]), (5, [1.0, 2.0]), (None, [9.0, 9.0]), (7, None), (10, []), (20, [1.0]), (3, [0.0, None]), (4, [0.0, float("nan")])]
    rows += [(6, [float("inf"), 0.0]), (40, [-0.01, -5.0]), (60, [0.0, 0.0]), (8, [1e17, 1.0]), (9, [-1e17, 1.0]), (80, [3e16, 2.0])]
    assert found(spark, rows, 10, 4) == plain(rows, 10, 4)
    assert found(spark, [], 10) == [] and found(spark, [(1, [1.0])], 10) == [] and found(spark, [(10, [1.0])], 10) == []


def test_pruning_leaves_few_pairs(spark):
    """Lengths that differ: most pairs never reach the exact score."""
    rng = np.random.default_rng(1)
    v = rng.normal(size=(4000, 16)) * np.geomspace(1, 0.01, 16) * rng.pareto(1.2, (4000, 1))
    rows = inner_products.Rows(np.arange(4000), np.arange(4000), np.ones(4000, bool), *(lambda w: (np.sqrt((w**2).sum(1)), w))(np.floor(64 * v)), np.full(4000, np.iinfo(np.int64).min))
    rows = rows.take(np.argsort(-rows.norm))
    run = inner_products.Search(rows.take(slice(0, None, 20)), np.linalg.eigh(rows.v.T @ rows.v)[1][:, ::-1], 10)
    scored = []
    exact = inner_products.exact
    inner_products.exact = lambda a, b: scored.append(len(a)) or exact(a, b)
    try:
        for s in range(0, 4000, 100):
            run.meet(rows.take(slice(s, s + 100)))
            run.best.prune()
    finally:
        inner_products.exact = exact
    assert sum(scored) < 0.2 * 4000 * 200
