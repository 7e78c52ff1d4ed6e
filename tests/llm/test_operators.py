"""Each operator against a plain version of its rule, and on odd rows."""

from __future__ import annotations

import hashlib
import io
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from caselake.llm import decontaminate, fingerprints, gray_index, huffman, mixing, pii, secret_scan, simhash, token_counts, token_files, tokens, toxicity, warc
from caselake.llm.components import connected
from caselake.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"


def sample_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


# --- WARC -----------------------------------------------------------------------


def test_warc_roundtrip_and_revisits(spark):
    big = "é" * 600
    rows = [(1, "u", big), (5, "u", big), (3, None, big), (2, "u", "small"), (4, "u", "small"), (6, "u", None), (None, "u", big), (7, "a\r\nb", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r["page_id"]: r for r in warc.roundtrip(spark, pages).collect()}
    assert len(got) == len(rows)
    for page, _, html in rows:
        payload = (html or "").encode()
        r = got[page]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(payload), hashlib.sha1(payload).hexdigest())
        revisit = len(payload) >= 1000 and page != 5
        assert (r["record_type"], r["refers_to"]) == (("revisit", 5) if revisit else ("response", None))
    assert warc.roundtrip(spark, pages.where("page_id < 0")).count() == 0


def test_warc_repeated_rows_keep_their_number(spark):
    pages = spark.createDataFrame([(9, "u", "z" * 2000)] * 3 + [(8, "u", "z" * 2000)] * 2, "page_id long, url string, html string")
    got = Counter((r["page_id"], r["record_type"], r["payload_bytes"]) for r in warc.roundtrip(spark, pages).collect())
    assert got == {(9, "response", 2000): 3, (8, "revisit", 2000): 2}


def test_warc_reader_notices_damage():
    payload = random.Random(0).randbytes(200_000)
    data = warc.record(1, "u", payload, hashlib.sha1(payload).hexdigest(), None) * 2
    rows = list(warc.read_archive(io.BytesIO(data)))
    assert [r["payload_bytes"] for r in rows] == [200_000] * 2 and rows[1]["offset"] == len(data) // 2
    with pytest.raises(warc.WarcError):
        list(warc.read_archive(io.BytesIO(data[:-40])))
    with pytest.raises(warc.WarcError):
        list(warc.read_archive(io.BytesIO(warc.record(1, "u", payload, "00" * 20, None))))


# --- token files ------------------------------------------------------------------


@pytest.mark.parametrize("n,vocabulary", [(0, 9), (1, 5), (257, 3), (1000, 1), (70_000, 49_408)])
def test_huffman_roundtrip(n, vocabulary):
    rng = np.random.default_rng(n)
    ids = np.minimum((rng.pareto(0.6, n) * 3).astype(np.int64), vocabulary - 1).astype(np.uint32)
    lengths = huffman.code_lengths(np.bincount(ids, minlength=vocabulary))
    assert lengths.max(initial=0) <= huffman.LIMIT
    table, limit = huffman.decoding_table(lengths)
    data, checkpoints = huffman.encode(ids, huffman.canonical_codes(lengths), lengths)
    assert (huffman.decode(data, checkpoints, n, table, limit) == ids).all()


def test_huffman_lengths_are_optimal_when_the_limit_does_not_bind():
    import heapq

    counts = np.random.default_rng(1).integers(1, 500, 60)
    heap = [(int(c), i, (i,)) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    depth = Counter()
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        depth.update(a[2] + b[2])
        heapq.heappush(heap, (a[0] + b[0], min(a[1], b[1]), a[2] + b[2]))
    lengths = huffman.code_lengths(counts)
    assert (lengths * counts).sum() == sum(depth[i] * c for i, c in enumerate(counts))


def reference_tokens(rows):
    tokenizer, start = tokens.load(tokenizer_path()), 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [token_files.END]
        yield doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_token_files_hold_every_id(spark, odd, nothing):
    for df in (odd, sample_docs(spark)):
        got = [tuple(r) for r in token_files.roundtrip(spark, df, tokenizer_path(), 4).orderBy("start").collect()]
        # equal documents have equal ids, so their order among themselves doesn't show
        assert got == list(reference_tokens(texts_of(df)))
    assert token_files.roundtrip(spark, nothing, tokenizer_path(), 4).count() == 0


def test_pieces_give_the_librarys_ids():
    import pyarrow as pa

    rnd, encoder, tokenizer = random.Random(5), tokens.PieceEncoder(tokenizer_path(), remembered=2000), tokens.load(tokenizer_path())
    parts = ["a", "B", "'s", " ", "\n", " ", "\x1c", "<|endoftext|>", "<|ENDOFTEXT|>", "Σ", "İ", "é", "́", "1", "²", "漢", "😀", ".", ",", "Don't", "\x0b", "ſ"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12))) for _ in range(3000)] + ["", None]
    n = 0
    for per_text, codes, per_entry, flat in encoder.slices(pa.array(texts)):
        ids, at = tokens.gathered(codes, per_entry, flat), 0
        for k in per_text:
            assert ids[at : at + k].tolist() == tokenizer.encode(texts[n] or "", add_special_tokens=False).ids
            at, n = at + k, n + 1
    assert n == len(texts)


# --- token counts -------------------------------------------------------------------


def test_chunks_splice_to_the_whole():
    tokenizer, rnd = tokens.load(tokenizer_path()), random.Random(2)
    offsets = lambda s: tokenizer.encode(s, add_special_tokens=False).offsets
    for _ in range(60):
        words = ["ab", "thing", "é" * rnd.randint(1, 90), "x" * rnd.randint(1, 300), "1234", "don't", "<|endoftext|>"]
        text = "".join(rnd.choice(words) + rnd.choice(["", " ", "  ", "\n"]) for _ in range(rnd.randint(1, 200)))
        assert token_counts.chunked_count(text, offsets, chunk=97, overlap=11) == len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_token_counts(spark, odd, nothing):
    tokenizer = tokens.load(tokenizer_path())
    for df in (odd, sample_docs(spark)):
        want = Counter((d, len(t.encode()), len(tokenizer.encode(t, add_special_tokens=False).ids)) for d, t in texts_of(df))
        rows = token_counts.token_counts(df, tokenizer_path(), huge=3000).collect()
        assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in rows) == want
        assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in rows)
    assert token_counts.token_counts(nothing, tokenizer_path()).count() == 0


# --- SimHash in Gray order ------------------------------------------------------------


def plain_components(codes, radius):
    parent = list(range(len(codes)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, c in enumerate(codes):
        for j in np.flatnonzero(np.bitwise_count(codes ^ c) <= radius):
            a, b = root(i), root(int(j))
            parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(codes))]


def clustered(n, seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, size=12, dtype=np.uint64)
    codes = base[rng.integers(0, len(base), n)]
    for _ in range(6):
        codes = codes ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
    return np.unique(codes)


@pytest.mark.parametrize("seed", range(4))
def test_gray_index_finds_the_components(seed):
    codes = clustered(900, seed)
    codes = codes[np.argsort(gray_index.gray_rank(codes))]
    assert gray_index.components(codes, np.zeros(len(codes)), 4).tolist() == plain_components(codes, 4)


def test_tables_leave_no_pair_out():
    from itertools import combinations

    for radius in (1, 3, 4, 8):
        chosen = [set(t) for t in simhash.triples(radius + 4)]
        assert all(any(t <= set(agreeing) for t in chosen) for agreeing in combinations(range(radius + 4), 4))


@pytest.mark.parametrize("page", [50, 50_000])
def test_links_give_the_components_whatever_the_page(spark, page):
    codes = clustered(500, 9)
    df = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "fp long")
    found = {r["node"]: r["root"] for r in connected(simhash.links(df, 4, page)).collect()}
    labels = [found.get(int(c), int(c)) for c in codes.view(np.int64)]
    want = plain_components(codes, 4)
    assert len(set(zip(labels, want))) == len(set(labels)) == len(set(want))


def plain_fingerprint(text, shingle=4):
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())) if w]
    grams = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates(spark, odd, nothing):
    for df in (odd, sample_docs(spark)):
        rows = simhash.near_duplicates(df).collect()
        assert len(rows) == df.count()
        want = {d: plain_fingerprint(t) for d, t in texts_of(df)}
        assert all(r["fp"] & (2**64 - 1) == want[r["doc_id"]] for r in rows)
        codes = np.array([r["fp"] for r in rows], np.int64).view(np.uint64)
        least = {}
        groups = plain_components(codes, 4)
        for r, g in zip(rows, groups):
            if r["doc_id"] is not None:
                least[g] = min(least.get(g, r["doc_id"]), r["doc_id"])
        assert [r["component_id"] for r in rows] == [least.get(g) for g in groups]
    assert simhash.near_duplicates(nothing).count() == 0


# --- document fingerprints --------------------------------------------------------------


def test_edited_texts_and_fingerprints(spark, odd, nothing):
    for df in (sample_docs(spark), odd):
        rows = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("th")).collect()
        order = sorted({(r["doc_id"], r["th"], r["text"]) for r in rows}, key=lambda k: (k[0] is not None, k[0] or 0, k[1]), reverse=True)
        want = Counter()
        for i, (doc, th, text) in enumerate(order):
            k = len(text) // 3
            edited = text[: len(text) - k] + order[(i + 1) % len(order)][2][:k]
            want[doc, len(text), hashlib.sha256(edited.encode()).hexdigest()] = sum(r["doc_id"] == doc and r["th"] == th for r in rows)
        got = fingerprints.edited_fingerprints(df).collect()
        assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == want
        assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert fingerprints.edited_fingerprints(nothing).count() == 0
    real = fingerprints.edited_fingerprints(sample_docs(spark)).agg(F.avg("near_edited"), F.avg("near_next")).first()
    assert real[0] > real[1] + 0.15


def test_votes_are_those_of_all_hashes(spark, odd):
    for r in odd.select(fingerprints.term_hashes(F.col("text")).alias("h"), fingerprints.simhash(F.coalesce("text", F.lit(""))).alias("fp")).collect():
        hashes = [h & (2**64 - 1) for h in r["h"] or []]
        assert r["fp"] & (2**64 - 1) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_block_tables_find_all_within_the_radius(spark):
    codes = clustered(400, 3).view(np.int64)
    every = spark.createDataFrame([(int(c),) for c in codes], "fp long")
    asked = every.where("pmod(fp, 7) = 0")
    got = {(r["fp"], r["near"], r["distance"]) for r in fingerprints.within_radius(asked, every, 3).collect()}
    want = {(int(a), int(b), int(np.bitwise_count(np.uint64(a ^ b & (2**64 - 1)) if a >= 0 and b >= 0 else np.int64(a ^ b).view(np.uint64)))) for a in codes.tolist() if a % 7 == 0 for b in codes.tolist()}
    assert got == {x for x in want if x[2] <= 3}


# --- toxicity -----------------------------------------------------------------------------


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    known, held = labels.where("doc_id % 3 <> 0"), labels.where("doc_id % 3 = 0")
    scored = toxicity.toxicity(docs, known).join(held.select("doc_id", F.col("toxic").alias("label")), "doc_id").collect()
    caught = [r["toxic"] for r in scored if r["label"] == 1]
    false = [r["toxic"] for r in scored if r["label"] == 0]
    assert sum(caught) / len(caught) > 0.9 and sum(false) / len(false) < 0.03
    assert all(0 <= r["expected_severity"] <= 2 and r["grade"] in (0, 1, 2) for r in scored)


def test_toxicity_on_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(5, 1, 1), (6, 1, 0), (None, 1, 1), (99, 0, None)], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(odd, labels).count() == odd.count()
    assert toxicity.toxicity(nothing, labels).count() == 0
    assert not any(r["toxic"] for r in toxicity.toxicity(odd, labels.where("toxic = 0")).collect())


# --- decontamination ------------------------------------------------------------------------


def edits_inside(item, text):
    """Least edits between the item and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        before, row = row, [i] + [0] * len(text)
        for j, d in enumerate(text, 1):
            row[j] = min(before[j - 1] + (c != d), before[j] + 1, row[j - 1] + 1)
    return min(row)


def test_decontamination_keeps_the_edit_budget(spark, docs):
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7))) for _ in range(400)]
    prose = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    items = [(i, prose(rnd.randint(12, 30))) for i in range(8)] + [(90, "tiny"), (91, None)]
    rows = []
    for n in range(60):
        item = list(items[n % 8][1])
        for _ in range(rnd.randint(0, 12)):
            at = rnd.randrange(len(item))
            item[at : at + rnd.randint(0, 1)] = rnd.choice(["", "z", "q"])
        rows.append((n, f"{prose(rnd.randint(0, 40))} {''.join(item).upper()}\n {prose(rnd.randint(0, 40))}"))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for chars in (100, decontaminate.BLOCK_CHARS):
        got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs(rows), benchmark, chars).collect()}
        want = set()
        for doc, text in rows:
            for item, known in items[:8]:
                if edits_inside(decontaminate.normal(known), decontaminate.normal(text)) <= decontaminate.budget(len(known)):
                    want.add((doc, item))
        assert got == want and 10 < len(want) < 60


def test_every_place_of_an_item_is_told(spark, docs):
    rng = random.Random(4)
    item = "".join(rng.choices("abcdefghij ", k=231)).replace("  ", " b").strip()
    item = decontaminate.normal(item + "xyz")
    edited = item[:100] + "Q" + item[103:]
    k, n = decontaminate.budget(len(item)), len(item)
    assert k > 5
    benchmark = spark.createDataFrame([(1, item), (2, "ab" * 100)], "item_id long, text string")
    texts = {1: " ".join([item] * 5), 2: " ".join([edited, item, edited, edited]), 3: f"{item} {'z' * k} {item}", 4: item * 3, 5: "ab" * 300, 6: edited}
    found = decontaminate.contaminated(docs(list(texts.items())), benchmark).orderBy("doc_id", "start").collect()
    assert Counter(r["doc_id"] for r in found) == {1: 5, 2: 4, 3: 2, 4: 3, 5: 3, 6: 1}
    for a, b in zip(found, found[1:]):
        assert a["doc_id"] != b["doc_id"] or a["end"] <= b["start"]
    assert [(r["start"], r["end"]) for r in found if r["doc_id"] == 1] == [(i * (n + 1), i * (n + 1) + n) for i in range(5)]


def test_banded_alignment_agrees_with_the_whole_table():
    rnd = random.Random(8)
    for _ in range(200):
        item = "".join(rnd.choice("ab c") for _ in range(rnd.randint(13, 40)))
        region = list(" x" + item + "y ")
        for _ in range(rnd.randint(0, 3)):
            region[rnd.randrange(len(region))] = rnd.choice(["", "a", "bb"])
        region = "".join(region)
        found = decontaminate.banded_alignment(decontaminate.chars_of(item), decontaminate.chars_of(region), 2)
        least = edits_inside(item, region)
        assert (found is not None) == (least <= 2) and (found is None or found[0] == least)


def test_decontamination_on_odd_rows(spark, odd, nothing):
    benchmark = spark.createDataFrame([(1, "same text again and more"), (1, "same text again and more")], "item_id long, text string")
    assert Counter(r["doc_id"] for r in decontaminate.contaminated(odd, benchmark).collect()) == {5: 2, 6: 4}
    assert decontaminate.contaminated(nothing, benchmark).count() == 0
    assert decontaminate.contaminated(odd, benchmark.where("item_id = 0")).count() == 0


# --- personal data ----------------------------------------------------------------------------


def luhn(digits):
    twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in twice) % 10 == 0


def plain_base(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(digits(m)) <= 15]
    return sorted(out)


def test_personal_data_base_spans(spark, docs, odd, nothing):
    rnd = random.Random(3)
    bits = ["a@b.c", "x%y", "@", "1.2.3.4", ".", "256", "007", "+1 (234) 555-6789", "4539 1488 0343 6467", "4111111111111111", "-", " ", "é", "😀", "a.b", "+", "9" * 22, "q", "\n", "0", "(", ")"]
    mixed = docs([(i, "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 9)))) for i in range(1500)])
    for df in (mixed, sample_docs(spark), odd):
        texts = Counter((d, hashlib.sha256(",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in plain_base(t)).encode()).hexdigest()) for d, t in texts_of(df))
        rows = pii.personal_data(df).collect()
        assert Counter((r["doc_id"], r["base_sha256"]) for r in rows) == texts
    assert pii.personal_data(nothing).count() == 0


def test_terms_that_give_an_entity_away(spark, docs):
    rnd = random.Random(6)
    common = ["and", "the", "of", "to", "house", "tree"]
    prose = lambda: " ".join(rnd.choice(common) for _ in range(12))
    rows = [(i, f"{prose()} Hotline{i % 2 * ' '} call +1 (234) 555-{1000 + i} {prose()}") for i in range(20)]
    rows += [(100 + i, prose()) for i in range(80)] + [(200 + i, "copied unicorn +1 (234) 555-9999") for i in range(9)]
    got = {r["doc_id"]: r for r in pii.personal_data(docs(rows)).collect()}
    text = dict(rows)
    cut = lambda d: [(k, text[d][int(s) : int(e)].lower()) for k, s, e in (x.split(":") for x in got[d]["spans"].split(","))]
    assert set(cut(3)) == {("term", "hotline"), ("term", "call"), ("phone", text[3][text[3].index("+1") :][:17])}
    assert "[phone]" in got[3]["sanitised"] and "otline" not in got[3]["sanitised"] and "call" not in got[3]["sanitised"]
    # copies of one text support nothing by themselves; documents without an entity stay as they are
    assert ("term", "unicorn") not in cut(200)
    assert got[150]["spans"] == "" and got[150]["sanitised"] is None


def test_disclosing_terms_equal_a_plain_count(spark, docs):
    """Terms in exactly the least number of different texts are found, copies count once towards it."""
    rng = random.Random(9)
    entities = {0: "a@b.example", 1: "10.0.0.1", 3: "+1 (234) 555-6789"}
    texts = []
    for i in range(400):
        kind = rng.choice([None, None, 0, 1, 3])
        words = rng.choices([f"w{chr(97 + j)}{chr(97 + k)}" for j in range(12) for k in range(12)], k=6)
        texts.append((" ".join(words) + (f" {entities[kind]} " if kind is not None else " "), kind))
    texts += [(f"rare {'x' * (i % n + 1)}y {entities[0]} ", 0) for n in (4, 5) for i in range(9)]
    texts += [(f"{t} {n * 'z'}q", k) for n, (t, k) in enumerate(texts[:40])]
    want = {}
    for kind in entities:
        holding = [t for t, k in texts if k == kind]
        own = math.log2(len(texts) / len(holding))
        for term in {w for t in holding for w in re.findall(r"(?<![\w@.+-])[a-z]{2,}(?![\w@+-]|\.\w)", t)}:
            def holds(t):
                return term in re.findall(r"(?<![\w@.+-])[a-z]{2,}(?![\w@+-]|\.\w)", t)

            both = [t for t in holding if holds(t)]
            n = sum(holds(t) for t, _ in texts)
            if len(set(both)) >= pii.SUPPORT and math.log2(len(both) * len(texts) / (n * len(holding))) >= pii.DISCLOSE * own:
                want[kind, term] = len(set(both))
    assert pii.SUPPORT in want.values()
    df = docs([(i, t) for i, (t, _) in enumerate(texts)])
    assert {(r["kind"], r["term"]) for r in pii.disclosing_terms(df).collect()} == set(want)


def test_personal_data_runs_no_python(spark):
    plan = pii.personal_data(sample_docs(spark))._jdf.queryExecution().executedPlan().toString()
    plan += fingerprints.edited_fingerprints(sample_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- mixing -------------------------------------------------------------------------------------


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight, target, capped = {s: i % 3 + 1 for i, s in enumerate(names)}, {}, set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in capped)
        level = left / max(1, sum(weight[s] for s in names if s not in capped))
        over = {s for s in names if s not in capped and level * weight[s] > 3 * sizes[s] * (1 + 1e-12)}
        if not over:
            return {s: 3 * sizes[s] if s in capped else level * weight[s] for s in names}
        capped |= over


def test_mix_meets_its_targets(spark, odd, nothing):
    rnd = random.Random(1)
    rows = [(i, " ".join(["w"] * rnd.randint(0, 60)), rnd.choice(["a", "b", "big", "big", "big", None, "é"])) for i in range(4000)] + [(9000, "x y", "tiny")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(df.repartition(7)).collect()))
    source, sizes, taken = {d: s for d, _, s in rows}, Counter(), Counter()
    for r in got:
        sizes[source[r["doc_id"]]] += r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
        assert r["taken"] <= 3 * r["size"]
    want = plain_targets(sizes)
    for r in got:
        assert r["target"] == pytest.approx(want[source[r["doc_id"]]]) and r["source_size"] == sizes[source[r["doc_id"]]]
    assert all(abs(taken[s] - want[s]) <= 120 for s in want)
    assert mixing.mix(odd).count() == odd.count() and mixing.mix(nothing).count() == 0


# --- secrets --------------------------------------------------------------------------------------


def test_secret_base_spans(spark, docs, odd, nothing):
    rnd = random.Random(7)
    bits = ["password", "API_KEY", "apikey", "ſecret", "toKen", "=", ": ", '"', "'", " ", "abcdef12", "AKIA", "ABCD1234EFGH", "0123456789abcdef", "é", "\n", "/", "+", "x"]
    mixed = docs([(i, "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 10)))) for i in range(1500)])
    shapes = [r"""(?a)(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", r"AKIA[A-Z0-9]+", r"[0-9a-f]+"]
    for df in (mixed, sample_docs(spark), odd):
        want = Counter()
        for doc, text in texts_of(df):
            spans = []
            for k, shape in enumerate(shapes):
                for m in re.finditer(shape, text):
                    if len(m[2] if k == 0 else m[0]) >= (8, 16, 32)[k]:
                        spans.append((m.start(), k, m.end()))
            text_spans = ",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))
            want[doc, hashlib.sha256(text_spans.encode()).hexdigest()] += 1
        assert Counter((r["doc_id"], r["base_sha256"]) for r in secret_scan.secrets(df).collect()) == want
    assert secret_scan.secrets(nothing).count() == 0


@pytest.mark.parametrize(
    "text,found",
    [
        ('db_pwd = "Tr0ub4dor&3xyz"', ["Tr0ub4dor&3xyz"]),
        ('k = "kJ8s-92hXq!z"\nauth_token = k', ["kJ8s-92hXq!z"]),
        ('private_key := "a8Fk2" + "9sLq!x7"', ["a8Fk2", "9sLq!x7"]),
        ("<clientSecret>9f!Kq27zLm</clientSecret>", ["9f!Kq27zLm"]),
        ('title = "A long harmless sentence 12"', []),
        ("Note: the key point is this", []),
        ('pwd = "changeme"', []),
    ],
)
def test_literals_assigned_to_sensitive_names(text, found):
    assert [text[s:e] for s, k, e in secret_scan.scan(text) if k == 3] == found


def sensitive_literals(text):
    return [text[s:e] for s, e in sorted(secret_scan.assigned_literals(text))]


def test_a_constant_of_any_number_of_pieces():
    rng = random.Random(2)
    pieces = ["".join(rng.choices("abcXYZ0123456789", k=5)) for _ in range(3000)]
    whole = "blob = " + " + ".join(f"'{p}'" for p in pieces) + "\nmy_secret = blob"
    lines = "blob = ''\n" + "".join(f"blob = blob + '{p}'\n" for p in pieces) + "my_secret = blob"
    for text in (whole, lines):
        assert sensitive_literals(text) == pieces


def test_adjacent_literals_are_one_value():
    assert sensitive_literals("secret_key = 'abcd' 'efgh1234XYZ98'") == ["abcd", "efgh1234XYZ98"]
    assert sensitive_literals("secret_key = 'abcd' \\\n  'efgh1234XYZ98'") == ["abcd", "efgh1234XYZ98"]
    assert sensitive_literals("secret_key: 'abcd1234XYZ98' 'other': 'plain words'") == ["abcd1234XYZ98"]


@pytest.mark.parametrize("word", sorted(secret_scan.SENSITIVE))
def test_every_sensitive_name_can_be_reported(word):
    assert sensitive_literals(f"{word} = 'aB3$xY9!kL2#qW7&'") == ["aB3$xY9!kL2#qW7&"]
    if word == "pin":
        assert sensitive_literals("pin = '48150623'") == ["48150623"]


KEY = "aB3$xY9!kL2#qW7&"


@pytest.mark.parametrize(
    "text,found",
    [
        (f"pwd = `{KEY}\nmore`", [f"{KEY}\nmore"]),
        (f'x = """{KEY}"""\nauth_key = x', [KEY]),
        (f"r = {{'pwd': b'{KEY}'}}", [KEY]),
        (f'login(user="bob", passwd="{KEY}")', [KEY]),
        (f'set_password("{KEY}")', [KEY]),
        (f'setenv("API_KEY", "{KEY}")', [KEY]),
        (f'd["pwd"] = "{KEY}"', [KEY]),
        (f'pwd: str = "{KEY}"', [KEY]),
        (f'pwd += "{KEY}"', [KEY]),
        (f'pwd = ("{KEY}"\n  "zz9X")', [KEY, "zz9X"]),
        (f'<add key="clientSecret" value="{KEY}"/>', [KEY]),
        (f"private_key: |\n  {KEY}\n  abcDEF123\nother: 1", [f"{KEY}\n  abcDEF123"]),
        (f'private_key: >-\nother: "{KEY}"', []),
        (f'secret_key = K\nK = L\nL = "{KEY}"', [KEY]),
        (f'K = "{KEY}"\nK = "x"\nsecret_key = K', []),
        ("a = b\nb = a\npwd = a", []),
        ('conn = "Server=x;pwd=aB3xY9kL2qW7;"', ["aB3xY9kL2qW7"]),
        ("don't; pwd = 'aB3$xY9!kL2' it's", ["aB3$xY9!kL2"]),
        (f'token_type = "{KEY}"\npassword_hint = "{KEY}"', []),
        ("auth = request.headers", []),
        (f'pwd = read("{KEY}")', []),
        (f'pwd = "open {KEY}', []),
        ("", []),
    ],
)
def test_lexed_pairs(text, found):
    assert sensitive_literals(text) == found


@pytest.mark.parametrize(
    "text",
    ["x = 1 " + "0123456789abcdef" * 65536, "k: " + "aZ_-9" * 200_000, '\\"' * 300_000 + "=", "'" * 500_000 + "=", "a'" * 300_000 + "=", "`" * 499_999 + "=", "<a>" * 200_000, "a=(" * 100_000, "k: |\n" * 100_000, ": " * 250_000, "a = b + " * 50_000]
    + ["".join(f"p{i} = p{i + 1}\n" for i in range(50_000)), "k: |\n" + "".join(" " * (i % 900) + "k: |\n" for i in range(1000)), "".join(f"password = 'aB3x{i}Y9kL2qW7'\n" for i in range(50_000))],
    ids=lambda t: t[:6].replace("\n", " "),
)
def test_a_scan_takes_time_in_proportion(text):
    """Texts that cost the square of their length where starts inside runs are tried or literals left open are read again."""
    began = time.process_time()
    secret_scan.scan(text)
    assert time.process_time() - began < 5


def test_literals_inside_base_spans_are_not_told_again():
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choices(["password", "pwd", "=", ": ", "'", '"', " ", "\n", "aB3xY9kL2q", "AKIA" + "Z" * 14, "0123456789abcdef" * 2, "+", "(", ")", "`"], k=25))
        spans = secret_scan.scan(text)
        base = [(s, e) for s, k, e in spans if k < 3]
        want = {(s, e) for s, e in secret_scan.assigned_literals(text) if not any(a <= s and e <= b for a, b in base)}
        assert {(s, e) for s, k, e in spans if k == 3} == want


def test_decontamination_slices_are_small():
    """A slice of documents is hashed with dozens of bytes a character; items are found in every slice."""
    import pyarrow as pa

    texts = ["some plain words of a document " * 1000] * 40
    batch = pa.RecordBatch.from_pydict({"text_key": list(range(40)), "doc_id": list(range(40)), "text": texts})
    slices = [held for _, held in decontaminate._slices(batch)]
    assert sum(len(s) for s in slices) == 40 and max(sum(map(len, s)) for s in slices) < 300_000
