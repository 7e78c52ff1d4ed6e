"""Toxicity by cumulative-link ordinal regression on words and word beginnings.

P(grade > k) = sigmoid(w . x - t_k): one weight per feature, shared by all ordered
thresholds t_1 < t_2. The expected severity is the sum of these probabilities.

The labels only say toxic or not. Grades are made inside the sample: clean
documents are grade 0; toxic ones are grade 1 or 2 by whether they hold at most
or more than the median number of marked words.

Fitting uses a bounded sample, ``SAMPLE`` labelled documents of each class (those
with the smallest hash of their id), and ``FEATURES`` features, those that tell the
classes apart best in the sample. Scoring reads every whole text; the weights it
broadcasts are bounded by ``FEATURES``.

Defined results: a null or empty text has no word and gets the severity of the
thresholds alone; with no toxic or no clean label every severity is 0; labels
without a document and documents without a label are fine; repeated labels of a
document count as one, the toxic one; an empty table gives no row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most labelled documents of each class the model is fitted on.
SAMPLE = 4_000
#: Most words and beginnings that get a weight.
FEATURES = 512
#: Documents of the sample a word must occur in.
LEAST = 5
GRADES = 3
L2 = 1e-3
STEPS = 400
#: P(grade > 0) from which a document is rejected.
REJECT = 0.5

#: Letters of a beginning: inflected and compound words share it.
STEMS = (5, 7)
WORD = re.compile(r"\w+")


def features(text: str | None) -> set[str]:
    """The different words of a text, and the beginnings of longer ones, marked by a star."""
    found = set(WORD.findall((text or "").lower()))
    for n in STEMS:
        found |= {w[:n] + "*" for w in found if len(w) > n and w[-1] != "*"}
    return found


@dataclass(frozen=True)
class Ordinal:
    """Weights by word, and thresholds in ascending order."""

    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def exceed(self, text: str | None) -> list[float]:
        """P(grade > k) for each threshold."""
        get = self.weights.get
        s = sum(get(w, 0.0) for w in features(text))
        return [float(1 / (1 + np.exp(np.clip(t - s, -500, 500)))) for t in self.thresholds]


def sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """doc_id, toxic, text of at most ``size`` labelled documents of each class."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL")
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.join(ids, "doc_id", "left_semi")
    chosen = None
    for toxic in (0, 1):
        part = known.where((F.col("toxic") != 0) == bool(toxic)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
        part = part.select("doc_id", F.lit(toxic).alias("toxic"))
        chosen = part if chosen is None else chosen.union(part)
    # at most 2 * size rows of two numbers: small enough to be sent everywhere
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE, most: int = FEATURES) -> Ordinal:
    """The model of the sample. Only chosen words and their places in the sample reach the driver."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, toxic, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "toxic", "text"))):
                held = list(features(text))
                yield pa.RecordBatch.from_arrays([pa.array([doc] * len(held), pa.int64()), pa.array([toxic] * len(held), pa.int32()), pa.array(held, pa.string())], ["doc_id", "toxic", "word"])

    drawn = sample(docs, labels, size).persist()
    try:
        n = {r["toxic"]: r["n"] for r in drawn.groupBy("toxic").agg(F.countDistinct("doc_id").alias("n")).collect()}
        if len(n) < 2:
            return Ordinal({}, ())
        pairs = drawn.mapInArrow(cut, "doc_id long, toxic int, word string").distinct()
        counts = pairs.groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")).where(F.col("t") + F.col("c") >= LEAST)
        # difference of the two shares over its spread
        a, b = F.col("t") / n[1], F.col("c") / n[0]
        spread = F.sqrt((F.col("t") + F.col("c") + 1) / F.lit(n[0] + n[1]) * (1 / n[0] + 1 / n[1]))
        best = counts.orderBy((F.abs(a - b) / spread).desc(), "word").limit(most).select("word", (a > b).alias("marked"))
        chosen = {r["word"]: (i, r["marked"]) for i, r in enumerate(best.collect())}
        # documents without any of the features count, too
        present = pairs.join(F.broadcast(best), "word").groupBy("doc_id").agg(F.collect_list("word").alias("words"))
        held = drawn.select("doc_id", "toxic").distinct().join(present, "doc_id", "left").collect()
    finally:
        drawn.unpersist()
    x, toxic = np.zeros((len(held), len(chosen)), np.float32), np.zeros(len(held), np.int64)
    for i, row in enumerate(sorted(held, key=lambda r: r["doc_id"])):
        x[i, [chosen[w][0] for w in row["words"] or ()]] = 1
        toxic[i] = row["toxic"]
    marked = x[:, [i for i, m in chosen.values() if m]].sum(axis=1)
    grades = toxic + (toxic * (marked > np.median(marked[toxic == 1]))) if toxic.any() else toxic
    weights, thresholds = _descend(x, grades)
    return Ordinal({w: float(weights[i]) for w, (i, _) in chosen.items()}, tuple(thresholds.tolist()))


def _descend(x: np.ndarray, grades: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Adam on the summed logistic losses of all thresholds, classes balanced; the first threshold
    is free, further ones are it plus positive steps."""
    above = (grades[:, None] > np.arange(GRADES - 1)[None, :]).astype(np.float64)
    balance = np.where(grades > 0, 0.5 / max(1, (grades > 0).sum()), 0.5 / max(1, (grades == 0).sum()))
    p = np.zeros(x.shape[1] + GRADES - 1)
    p[x.shape[1] :] = [1.0] + [0.0] * (GRADES - 2)
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, STEPS + 1):
        w, raw = p[: x.shape[1]], p[x.shape[1] :]
        gaps = np.log1p(np.exp(raw[1:]))
        t = np.concatenate([raw[:1], raw[0] + np.cumsum(gaps)])
        s = (x @ w.astype(np.float32)).astype(np.float64)
        error = (1 / (1 + np.exp(np.clip(t[None, :] - s[:, None], -500, 500))) - above) * balance[:, None]
        by_threshold = -error.sum(axis=0)
        slope = 1 / (1 + np.exp(-raw[1:]))
        tail = np.cumsum(by_threshold[::-1])[::-1]
        g = np.concatenate([x.T @ error.sum(axis=1).astype(np.float32) + L2 * w, tail[:1], tail[1:] * slope])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    raw = p[x.shape[1] :]
    return p[: x.shape[1]], np.concatenate([raw[:1], raw[0] + np.cumsum(np.log1p(np.exp(raw[1:])))])


def scored(docs: DataFrame, model: Ordinal, reject: float = REJECT, into: str = "_tox") -> DataFrame:
    """``docs`` with a struct ``into``: expected_severity, grade (most likely) and toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in texts:
            rows = []
            for text in array:
                p = shared.value.exceed(text.as_py())
                at_least = [1.0, *p, 0.0]
                rows.append({"expected_severity": sum(p), "grade": int(np.argmax(np.diff(at_least) * -1)), "toxic": bool(p) and p[0] >= reject})
            yield pa.array(rows, pa.struct([("expected_severity", pa.float64()), ("grade", pa.int32()), ("toxic", pa.bool_())]))

    return docs.withColumn(into, F.arrow_udf(score, "expected_severity double, grade int, toxic boolean")(F.col("text")))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, expected_severity, grade, toxic for every document."""
    rows = scored(docs.select(F.col("doc_id").cast("long"), "text"), fit(docs, labels))
    return rows.select("doc_id", F.col("_tox.expected_severity"), F.col("_tox.grade"), F.col("_tox.toxic"))
