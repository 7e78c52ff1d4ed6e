"""Spelling variants against all pairs of words."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import combinations, product
from zlib import crc32

import pytest

from caselake.llm import spelling


def edits_of_one(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_words(rows):
    found = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if doc is None else doc}:{run}".encode())
            found[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def plain(rows):
    words = plain_words(rows)
    near = {w: [] for w in words}
    for a, b in combinations(words, 2):
        if abs(len(a) - len(b)) < 2 and edits_of_one(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def made(seed, size, letters="abé"):
    rng = random.Random(seed)
    words = ["".join(rng.choices(letters, k=rng.choice([5, 5, 6, 7]))) for _ in range(size)]
    return [(i if i % 5 else None, " ".join(rng.choices(words, k=60)) + ",X÷" + rng.choice(words).upper()) for i in range(200)]


@pytest.mark.parametrize("seed,letters", [(1, "ab"), (2, "abé"), (3, "abcdefÿ")])
def test_equals_all_pairs(spark, docs, seed, letters):
    rows = made(seed, 300, letters)
    got = spelling.spelling_variants(docs(rows))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(set(got)) and set(got) == plain(rows)
    assert any(r[1] for r in got) and (seed != 1 or any(r[2] != r[1] and r[1] for r in got))


def test_odd_rows(spark, docs, odd, nothing):
    assert spelling.spelling_variants(nothing).count() == 0
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert {tuple(r) for r in spelling.spelling_variants(odd).collect()} == plain(rows)
    long = "z" * 50_000
    rows = [(1, f"{long} " * 4 + f"{long}a " * 9 + "HOUSE house House houses houses HOUSES " * 3)]
    assert {tuple(r) for r in spelling.spelling_variants(docs(rows)).collect()} == plain(rows)


def test_pivots_are_disjoint_and_cheapest():
    rng = random.Random(4)
    for _ in range(500):
        word = "".join(rng.choices("abc", k=rng.randint(4, 12)))
        counts = [rng.randint(1, 9) if rng.random() < 0.5 else 3 for _ in range(spelling.BUCKETS)]
        grams = spelling.prefix(word, counts)
        cost = {p: c for c, _, p in grams}
        chosen = spelling.pivots(grams)
        least = min(cost[a] + cost[b] for a, b in product(cost, cost) if b - a >= 2)
        assert len(chosen) == 2 and chosen[1] - chosen[0] >= 2 and sum(cost[p] for p in chosen) == least
