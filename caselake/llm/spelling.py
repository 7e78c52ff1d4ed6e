"""Spelling variants: words one edit apart, found through pivotal bigrams.

A word's bigrams are ranked by how rare they are over all words (summed in a fixed
number of hash buckets, so the ranking is one bounded list at any size). Its prefix is
its three rarest bigrams by (count, bigram, place). Two of them that do not overlap and are
rarest together are its pivots (dynamic programming over places); three always hold two such.

One edit touches at most one of two disjoint pivots. So of two near words, that whose
prefix ends earlier in the ranking has a pivot that the other has in its prefix, one place
off at most, and all that lies on one side of it is equal. (The other may have it just
behind its prefix's end, if that is the same bigram one place before; that occurrence is
indexed too.) Pivots are therefore joined with prefix bigrams on a hash of the word's
length (plus or minus one) and the whole left part up to the pivot, or the whole right part
from it: place and bigram are part of both. The edit distance decides in the join itself,
so only near words leave it. A word has at most 20 index rows, however long it is.

Defined results: a null text has no word; a null doc_id counts as an empty one in the
damaging rule; repeated rows count as often as they occur; a word without near words has
n_near 0, no form, and itself as root; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import nsmallest
from zlib import crc32

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.llm.storage import discard, materialized

#: What is no letter of a run: all but A-Z, a-z and U+00C0 to U+00FF.
NO_RUN = "[^A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One run in so many loses a letter.
DAMAGED = 97
#: Code points and occurrences that make a word.
LEAST_LENGTH = 5
LEAST_COUNT = 3
#: Edits between near words; the prefix holds one more bigram than they can touch.
EDITS = 1
GRAM = 2
#: Buckets in which bigrams are counted.
BUCKETS = 65_536
#: Characters of words that an arrow batch of index rows holds.
BATCH = 1 << 21

INDEX = pa.schema([("pivot", pa.bool_()), ("key", pa.int64()), ("word", pa.string()), ("n", pa.int64()), ("last", pa.string())])


def runs(docs: DataFrame, least: int = 1) -> DataFrame:
    """run: maximal runs of letters, lower-cased, one in ``DAMAGED`` with a letter less, that have ``least`` code points then.

    Short runs go before anything is computed for them; only those of ``least`` code points
    need their hash to know whether they stay.
    """
    found = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.split(F.coalesce("text", F.lit("")), NO_RUN)).alias("run"))
    # a run without letters beyond ASCII needs no table
    ascii_only = F.octet_length("run") == F.length("run")
    lowered = F.when(ascii_only, F.lower("run")).otherwise(F.translate("run", UPPER, LOWER))
    found = found.where(F.length("run") >= least).select("id", lowered.alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run"))
    at = (h % F.length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    stays = (F.length("run") > least) | (h % DAMAGED != 0)
    return found.where(stays).select(F.when(h % DAMAGED == 0, less).otherwise(F.col("run")).alias("run"))


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n: the words and how often they occur; counted in each task before the shuffle."""
    words = runs(docs, least_length).groupBy(F.col("run").alias("word")).agg(F.count(F.lit(1)).alias("n"))
    return words.where(F.col("n") >= least_count)


def bucket(gram: str) -> int:
    return crc32(gram.encode("utf-8", "surrogatepass")) % BUCKETS


def gram_counts(words: DataFrame) -> list[int]:
    """How many bigrams of the words fall into each bucket: at most ``BUCKETS`` rows reach the driver."""
    places = F.sequence(F.lit(1), F.length("word") - (GRAM - 1))
    grams = words.select(F.explode(F.transform(places, lambda i: F.substring("word", i, F.lit(GRAM)))).alias("gram"))
    counts = [0] * BUCKETS
    for r in grams.groupBy((F.crc32("gram") % BUCKETS).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r["b"]] = r["n"]
    return counts


def prefix(word: str, counts: list[int], size: int = GRAM * EDITS + 1) -> list[tuple[int, str, int]]:
    """(count, bigram, place) of the ``size`` rarest bigrams."""
    return nsmallest(size, ((counts[bucket(g)], g, i) for i, g in ((i, word[i : i + GRAM]) for i in range(len(word) - GRAM + 1))))


def pivots(grams: list[tuple[int, str, int]], number: int = EDITS + 1) -> list[int]:
    """Places of ``number`` bigrams that do not overlap, of least total count.

    ``best[k]`` holds, for the bigrams up to a place, the cheapest choice of k of them; a
    bigram extends the choices that end ``GRAM`` or more places before it.
    """
    ordered = sorted((place, cost) for cost, _, place in grams)
    best: list[list[tuple[int, tuple[int, ...]] | None]] = [[(0, ())] + [None] * number]
    for i, (place, cost) in enumerate(ordered):
        before = max((j for j in range(i) if ordered[j][0] + GRAM <= place), default=-1)
        row = list(best[-1])
        for k in range(1, number + 1):
            shorter = best[before + 1][k - 1]
            if shorter is not None:
                choice = (shorter[0] + cost, (*shorter[1], place))
                if row[k] is None or choice < row[k]:
                    row[k] = choice
        best.append(row)
    chosen = best[-1][number]
    if chosen is None:
        raise ValueError("a word this short has no disjoint bigrams")
    return list(chosen[1])


def key(length: int, side: str, part: str) -> int:
    return xxhash.xxh64_intdigest(f"{length}{side}{part}".encode()) - (1 << 63)


def index_rows(word: str, counts: list[int]) -> Iterator[tuple[bool, int, str]]:
    """(is a pivot, key, last of the prefix) for a word's pivots and prefix bigrams."""
    grams = prefix(word, counts)
    count, last, end = grams[-1]
    order = f"{count:010x}{last}{end:08x}"
    for place in pivots(grams):
        for length in range(len(word) - EDITS, len(word) + EDITS + 1):
            yield True, key(length, "<", word[: place + GRAM]), order
            yield True, key(length, ">", word[place:]), order
    behind = [end + 1] if word[end + 1 : end + 1 + GRAM] == last else []
    for place in [*(g[2] for g in grams), *behind]:
        yield False, key(len(word), "<", word[: place + GRAM]), order
        yield False, key(len(word), ">", word[place:]), order


def near_words(words: DataFrame) -> DataFrame:
    """a, a_n, b, b_n: every pair of words one edit apart, once, a before b.

    ``words`` (word, n) are distinct and of at least ``LEAST_LENGTH`` code points.
    """
    shared = words.sparkSession.sparkContext.broadcast(gram_counts(words))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple] = []
        size = 0
        for batch in batches:
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                rows = [(pivot, k, word, n, last) for pivot, k, last in index_rows(word, shared.value)]
                kept += rows
                size += len(rows) * len(word)
                if size >= BATCH:
                    yield _batch(kept)
                    kept, size = [], 0
        if kept:
            yield _batch(kept)

    table = materialized(words.select("word", "n").mapInArrow(index, "pivot boolean, key long, word string, n long, last string"), "grams")
    pivot = table.where("pivot").select("key", F.col("word").alias("p"), F.col("n").alias("p_n"), F.col("last").alias("p_last"))
    other = table.where("NOT pivot").select("key", F.col("word").alias("o"), F.col("n").alias("o_n"), F.col("last").alias("o_last"))
    near = pivot.join(other, (pivot["key"] == other["key"]) & (F.col("p_last") <= F.col("o_last")) & (F.levenshtein("p", "o", EDITS) == EDITS))
    first = F.col("p") < F.col("o")

    def pick(x: str, y: str) -> Column:
        return F.when(first, F.col(x)).otherwise(F.col(y))

    return near.select(pick("p", "o").alias("a"), pick("p_n", "o_n").alias("a_n"), pick("o", "p").alias("b"), pick("o_n", "p_n").alias("b_n")).distinct()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), INDEX)], schema=INDEX)


def forms(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n of every word."""
    # each pair is turned both ways after it is found, so the search runs once
    both = [F.struct(F.col(x).alias("word"), F.col(y).alias("near"), F.col(f"{y}_n").alias("near_n")) for x, y in ("ab", "ba")]
    directed = pairs.select(F.inline(F.array(*both)))
    best = directed.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best"))
    known = words.join(best, "word", "left")
    n = -F.col("best.less")
    follows = n >= 2 * F.col("n")
    return known.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(follows, F.col("best.near")).alias("form"), F.when(follows, n).alias("form_n")
    )


def roots(formed: DataFrame) -> DataFrame:
    """word, root of the words that have a form: each step doubles how far a word has followed."""
    steps = materialized(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "forms")
    while not steps.where("moved").isEmpty():
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = steps.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        further = materialized(further, "forms")
        discard(steps)
        steps = further
    return steps.select("word", "root")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the documents."""
    words = materialized(vocabulary(docs), "words")
    formed = materialized(forms(words, near_words(words)), "word-forms")
    joined = formed.join(roots(formed), "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


SQL = """
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY i) AS t
  FROM (SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS c FROM range(256) r(i))
), runs AS (
  SELECT id, run, count(*) AS cnt FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents
  ) GROUP BY 1, 2
), hashed AS (
  SELECT run, cnt, xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(id || ':' || run, ''), lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [195::BIGINT, ord(c)::BIGINT - 64] END)),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295::BIGINT) AS h FROM runs CROSS JOIN crc
), words AS (
  SELECT word, CAST(sum(cnt) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 97 = 0 THEN substring(run, 1, CAST(h % length(run) AS INTEGER)) || substring(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word, cnt FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(cnt) >= 3
), cut AS (
  SELECT word, substring(word, 1, i - 1) AS l, substring(word, i + 1) AS r FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.l = b.l AND a.r = b.r AND a.word <> b.word
  UNION SELECT c.word, w.word FROM cut c JOIN words w ON w.word = c.l || c.r
  UNION SELECT w.word, c.word FROM cut c JOIN words w ON w.word = c.l || c.r
), ranked AS (
  SELECT near.word, other, o.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near, row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, other) AS rank
  FROM near JOIN words o ON o.word = near.other
), formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * w.n THEN other END AS form, CASE WHEN other_n >= 2 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND rank = 1
), chain AS (
  SELECT word, word AS at, form AS next FROM formed
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON f.word = c.next
)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n FROM formed f JOIN chain c ON c.word = f.word AND c.next IS NULL
"""
