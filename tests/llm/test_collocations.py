"""Collocations against counts of every phrase."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from caselake.llm import collocations


def plain(rows, longest, least, first):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            words = tuple(re.findall("[^ \t]+", piece))
            n[lang or "und"] += len(words)
            for m in range(1, longest + 1):
                f[lang or "und"].update(words[i : i + m] for i in range(len(words) - m + 1))
    out = set()
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in candidates.items()):
                continue
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out |= {(lang, r + 1, p.decode(), -a, left, right, n[lang], -s) for r, (s, a, p, left, right) in enumerate(sorted(scored)[:first])}
    return out


def documents(spark, rows, parts=3):
    df = spark.createDataFrame([(lang, text, 1, "x") for lang, text in rows], "lang string, text string, code int, word string")
    return df.repartition(parts)


def found(spark, rows, longest=5, least=4, first=50):
    got = collocations.collocations(documents(spark, rows), longest, least, first)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return {tuple(r) for r in got.collect()}


@pytest.mark.parametrize("seed,stream", [(1, 1 << 24), (2, 300), (3, 60)])
def test_equals_counts_of_all_phrases(spark, monkeypatch, seed, stream):
    monkeypatch.setattr(collocations, "STREAM", stream)
    rng = random.Random(seed)
    rows = []
    for i in range(120):
        words = rng.choices(["a", "B", "é", "Éa", "x-y", "it's"], [6, 4, 2, 1, 1, 1], k=rng.randint(0, 60))
        if i % 3 == 0:
            words[len(words) // 2 :] = ["new", "york", "stock", "exchange", "news", "today"]
        rows.append((rng.choice(["en", "de", None, "und"]), "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "\x0b", ":"]) for w in words)))
    assert found(spark, rows) == plain(rows, 5, 4, 50)
    assert found(spark, rows, 3, 9, 2) == plain(rows, 3, 9, 2)


def test_odd_texts(spark):
    rows = [("en", None), (None, ""), ("en", " \t "), ("en", "...\n!"), ("de", "w " * 30_000 + "v" * 70_000), ("fr", "ein wort   z\x1cy z\x1cy"), ("en", "same again same again")]
    assert found(spark, rows * 3, least=2) == plain(rows * 3, 5, 2, 50)
    assert found(spark, [], least=2) == set() and found(spark, [("en", "")], least=2) == set()


def test_scores_beyond_64_bits(spark):
    """Products of counts as large as a great corpus has them."""
    row = spark.createDataFrame([(9_000_000_000, 90_000_000_000_000, [9_100_000_000, 9_000_000_001], [9_200_000_000, 10_000_000_000])], "a long, n long, lefts array<long>, rights array<long>")
    cut = row.selectExpr(f"{collocations.WORST} AS c").first()["c"]
    a, n = 9_000_000_000, 90_000_000_000_000
    assert (cut["score"], cut["k"]) == min((1000 * a * n // (9_100_000_000 * 10_000_000_000), 1), (1000 * a * n // (9_000_000_001 * 9_200_000_000), 2))
