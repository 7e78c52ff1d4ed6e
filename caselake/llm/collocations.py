"""Phrase collocations: counts of word sequences as sorted streams, merged and joined in step.

Texts become streams of word codes, a few megabytes of one language at a time. Counting goes
order by order. Each stream writes what it holds, sorted, as packed runs, one for every part
of the keys; the runs of a part are merged and summed, what occurs often enough gets an id, and
the ids go back to the places of the runs they came from. Two neighbouring ids are a phrase one
word longer: a phrase can only be frequent if its first part and its last part are. So each
order counts pairs of ids, and the streams shrink as the phrases grow.

The counted phrases of an order are kept in two layouts. In prefix order (by the id of all
but the last word) they are merge-joined with the shorter phrases for the counts of all their
first parts, and the largest count that extends a phrase to the right is read off the same
order; in suffix order (by the id of all but the first word) likewise for the last parts and
the extension to the left. Both joins are Spark's sort-merge joins, which it splits where a
part is very common; nothing is kept in a hash table.

A phrase is dropped if a longer one that holds it is about as frequent. A phrase between the
two is then as frequent too, so comparing with one more word on either side decides.

Defined results: a null text is empty, a null lang counts as ``und``; repeated rows count as
often as they occur; a text is never cut, whatever its length; ties in score are broken by
count and phrase, which is unique in its language; other columns are not read; an empty table
gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselake.llm.storage import discard, materialized

#: Characters that end a piece; words are what lies between white space.
BREAKS = "[.,;:!?\n\x0b\x0c\r]+"
#: Words of the longest phrase, least count of a phrase, rows for each language.
LONGEST = 5
LEAST = 100
FIRST = 2_000
#: A phrase goes if a longer one has this percentage of its count.
SHARE = 100
#: Bytes of texts in a stream; a longer text is a stream of its own.
STREAM = 16 << 20
#: Words of the corpus for each part of the keys, which bounds what a task merges.
PART = 8_000_000
#: Code of what is no word or no frequent phrase.
NONE = -1

#: A run: ``keys`` (words, or the ids of heads and tails) in order, ``counts``, and the code of the first one.
#: A row with ``codes`` is the stream itself, ``total`` the words it was made of.
RUNS = pa.schema([("stream", pa.int64()), ("lang", pa.string()), ("part", pa.int32()), ("first", pa.int32()), ("keys", pa.binary()), ("tails", pa.binary()), ("counts", pa.binary()), ("codes", pa.binary()), ("total", pa.int64())])
RUN_SCHEMA = "stream long, lang string, part int, first int, keys binary, tails binary, counts binary, codes binary, total long"
#: Merged: frequent phrases by ``id``, and for each run the ids of its frequent ``codes``.
MERGED = pa.schema([("lang", pa.string()), ("id", pa.int64()), ("word", pa.string()), ("head", pa.int64()), ("tail", pa.int64()), ("a", pa.int64()), ("stream", pa.int64()), ("codes", pa.binary()), ("ids", pa.binary())])
MERGED_SCHEMA = "lang string, id long, word string, head long, tail long, a long, stream long, codes binary, ids binary"


def coded(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct tokens of the texts and the code of each token; pieces end with a full stop."""
    ended = pc.binary_join_element_wise(pc.ascii_lower(texts), "", "\n")  # a text ends a piece
    tokens = pc.ascii_split_whitespace(pc.replace_substring_regex(ended, BREAKS, " . ")).flatten().dictionary_encode()
    return tokens.dictionary, tokens.indices.to_numpy(zero_copy_only=False).astype(np.int32)


def without_repeated_breaks(codes: np.ndarray) -> np.ndarray:
    gap = codes == NONE
    return codes[~(gap & np.concatenate([[True], gap[:-1]]))] if len(codes) else codes


def word_streams(docs: DataFrame, parts: int) -> DataFrame:
    """Streams of all texts, and the runs of their words."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for texts in _stretches(batches):
            for lang in pc.unique(texts["lang"]).to_pylist():
                tokens, codes = coded(texts["text"].filter(pc.equal(texts["lang"], lang)))
                words = tokens.to_pylist()
                part = np.array([NONE if w in ("", ".") else crc32(w.encode("utf-8", "surrogatepass")) % parts for w in words], np.int64)
                order = np.argsort(part, kind="stable")
                order = order[np.searchsorted(part[order], 0) :]
                counts = np.bincount(codes, minlength=len(words))[order]
                for p, s, e in _runs(part[order]):
                    yield _batch(RUNS, stream=number, lang=lang, part=p, first=s, keys=" ".join([words[i] for i in order[s:e].tolist()]).encode("utf-8", "surrogatepass"), counts=_packed(counts[s:e]))
                new = np.full(len(words), NONE, np.int64)
                new[order] = np.arange(len(order))
                yield _batch(RUNS, stream=number, lang=lang, codes=without_repeated_breaks(new[codes]).astype("<i4").tobytes(), total=int(counts.sum()))
                number += 1

    lang = F.coalesce("lang", F.lit("und")).alias("lang")
    return docs.select(lang, F.coalesce("text", F.lit("")).alias("text")).mapInArrow(read, RUN_SCHEMA)


def _runs(part: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, start, end) of the stretches of equal values."""
    edges = np.flatnonzero(np.diff(part)) + 1
    for s, e in zip([0, *edges.tolist()], [*edges.tolist(), len(part)]):
        if e > s:
            yield int(part[s]), s, e


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers in the narrowest width that holds them, the width first."""
    width = next(w for w in ("<u1", "<u2", "<u4", "<u8") if not len(values) or int(values.max()) <= np.iinfo(w).max)
    return width[2:].encode() + values.astype(width).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[:1].decode()}", offset=1).astype(np.int64)


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of about ``STREAM`` bytes of text at a time."""
    held, size = [], 0

    def joined() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        bytes_ = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < len(batch):
            before = bytes_[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(bytes_, before + STREAM - size, "right")))
            held.append(batch.slice(start, end - start))
            size += int(bytes_[end - 1] - before)
            start = end
            if size >= STREAM or start < len(batch):
                yield joined()
                held, size = [], 0
    if held:
        yield joined()


def _batch(schema: pa.Schema, **values) -> pa.RecordBatch:
    """One row; columns without a value are null."""
    return pa.RecordBatch.from_arrays([pa.array([values.get(f.name)], f.type) for f in schema], schema=schema)


def merged(runs: DataFrame, least: int, parts: int) -> DataFrame:
    """What occurs at least ``least`` times in the runs of a part, with an id, and where in each run it stands."""
    n = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _by_part(batches):
            given = 0
            for lang in dict.fromkeys(r["lang"] for r in rows):
                held = [r for r in rows if r["lang"] == lang]
                names, of = _joined(held)
                total = np.bincount(of, np.concatenate([_unpacked(r["counts"]) for r in held]).astype(np.float64), len(names[0])).astype(np.int64)
                frequent = np.flatnonzero(total >= least)
                ids = np.full(len(total), NONE, np.int64)
                ids[frequent] = (given + np.arange(len(frequent))) * parts + part
                given += len(frequent)
                if len(frequent):
                    columns = {"lang": pa.array([lang] * len(frequent)), "id": ids[frequent], "a": total[frequent]}
                    columns |= {"word": names[0].take(pa.array(frequent))} if len(names) == 1 else {"head": names[0][frequent], "tail": names[1][frequent]}
                    yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(len(frequent), f.type) for f in MERGED], schema=MERGED)
                at = 0
                for r in held:
                    own = ids[of[at : at + (size := r["size"])]]
                    at += size
                    places = np.flatnonzero(own != NONE)
                    if len(places):
                        yield _batch(MERGED, stream=r["stream"], codes=_packed(r["first"] + places), ids=_packed(own[places]))

    dealt = runs.where("part IS NOT NULL").repartitionById(n, F.pmod("part", F.lit(n)).cast("int")).sortWithinPartitions("part", "lang")
    return materialized(dealt.select("stream", "lang", "part", "first", "keys", "tails", "counts").mapInArrow(merge, MERGED_SCHEMA), "merged")


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    rows: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and rows[0]["part"] != row["part"]:
                yield rows[0]["part"], rows
                rows = []
            rows.append(row)
    if rows:
        yield rows[0]["part"], rows


def _joined(runs: list[dict]) -> tuple[tuple, np.ndarray]:
    """The different keys of some runs, and which of them each entry is; sets the ``size`` of each run."""
    if runs[0]["tails"] is None:
        lists = pc.split_pattern(pa.array([r["keys"].decode("utf-8", "surrogatepass") for r in runs], pa.large_string()), " ")
        for r, size in zip(runs, pc.list_value_length(lists).to_pylist()):
            r["size"] = size
        words = lists.flatten().dictionary_encode()
        return (words.dictionary.cast(pa.string()),), words.indices.to_numpy(zero_copy_only=False)
    heads, tails = [], []
    for r in runs:
        heads.append(np.cumsum(_unpacked(r["keys"])))
        tails.append(_unpacked(r["tails"]))
        r["size"] = len(tails[-1])
    head, tail = np.concatenate(heads), np.concatenate(tails)
    if max(int(head.max()), int(tail.max())) < 1 << 31:
        keys, of = np.unique((head << 32) | tail, return_inverse=True)
        return (keys >> 32, keys & 0xFFFFFFFF), of
    keys, of = np.unique(np.stack([head, tail]), axis=1, return_inverse=True)
    return (keys[0], keys[1]), of.reshape(-1)


def longer(streams: DataFrame, found: DataFrame, parts: int) -> DataFrame:
    """The next order: streams in which codes are replaced by ids and neighbours paired, and the runs of the pairs.

    Codes without an id are not frequent and end a phrase.
    """

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, codes, ids = None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                if row["stream"] != stream:
                    stream, codes, ids = row["stream"], [], []
                if row["kind"] == 0:
                    codes.append(_unpacked(row["codes"]))
                    ids.append(_unpacked(row["ids"]))
                elif codes:
                    yield from _pairs(stream, row["lang"], np.frombuffer(row["codes"], "<i4"), np.concatenate(codes), np.concatenate(ids), parts)

    n = int(streams.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    given = found.where("ids IS NOT NULL").select("stream", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("lang"), "codes", "ids")
    rows = streams.select("stream", F.lit(1).alias("kind"), "lang", "codes", F.lit(None).cast("binary").alias("ids"))
    return given.unionByName(rows).repartitionById(n, _dealt("stream", n)).sortWithinPartitions("stream", "kind").mapInArrow(pair, RUN_SCHEMA)


def _dealt(stream: str, n: int) -> Column:
    """Streams of one task go to neighbouring partitions, those of the next task behind them."""
    return F.pmod(F.shiftright(stream, 32) * 4 + F.col(stream).bitwiseAND(F.lit(0xFFFFFFFF)), F.lit(n)).cast("int")


def _pairs(stream: int, lang: str, codes: np.ndarray, known: np.ndarray, ids: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """Stream and runs of the neighbouring frequent phrases of one stream."""
    table = np.full(int(max(known.max(), codes.max(initial=0))) + 2, NONE, np.int64)  # the last entry answers for NONE
    table[known] = ids
    at = table[codes]
    both = np.flatnonzero((at[:-1] != NONE) & (at[1:] != NONE))
    if not len(both):
        return
    names = np.unique(ids)
    local = np.searchsorted(names, at)
    pairs, of, counts = np.unique(local[both] * len(names) + local[both + 1], return_inverse=True, return_counts=True)
    head, tail = names[pairs // len(names)], names[pairs % len(names)]
    part = ((head.astype(np.uint64) * MIX + tail.astype(np.uint64)) * MIX >> np.uint64(33)).astype(np.int64) % parts
    order = np.argsort(part, kind="stable")
    for p, s, e in _runs(part[order]):
        run = order[s:e]  # in order of head and tail, as the pairs are
        yield _batch(RUNS, stream=stream, lang=lang, part=p, first=s, keys=_packed(np.diff(head[run], prepend=0)), tails=_packed(tail[run]), counts=_packed(counts[run]))
    code = np.empty(len(order), np.int64)
    code[order] = np.arange(len(order))
    out = np.full(len(at) - 1, NONE, np.int64)
    out[both] = code[of]
    yield _batch(RUNS, stream=stream, lang=lang, codes=without_repeated_breaks(out).astype("<i4").tobytes())


#: Odd multiplier that spreads pairs of ids over the parts.
MIX = np.uint64(0x9E3779B97F4A7C15)


def phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, part: int = PART) -> tuple[DataFrame, list[DataFrame]]:
    """Word occurrences per language, and the frequent phrases of each order:
    lang, id, head, tail, phrase, a, lefts (counts of its first 1, 2, ... words), rights (of its last 1, 2, ...)."""
    spark = docs.sparkSession
    size = docs.select(F.sum(F.length("text"))).first()[0] or 0
    # at least two characters a word: an upper bound of the words of a part
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // (2 * part)))
    table = materialized(word_streams(docs, parts), "streams")
    totals = materialized(table.where("total IS NOT NULL").groupBy("lang").agg(F.sum("total").alias("n")), "totals")
    found = merged(table, least, parts)
    none = F.array().cast("array<long>")
    words = found.where("a IS NOT NULL").select("lang", "id", "head", "tail", F.col("word").alias("phrase"), "a", none.alias("lefts"), none.alias("rights"))
    orders = [materialized(words, "phrases")]
    for _ in range(longest - 1):
        following = materialized(longer(table.where("codes IS NOT NULL"), found, parts), "streams")
        discard(table)
        discard(found)
        table = following
        found = merged(table, least, parts)
        counts = found.where("a IS NOT NULL").select("lang", "id", "head", "tail", "a")
        orders.append(materialized(_extended(counts, orders[-1]), "phrases"))
    discard(table)
    discard(found)
    return totals, orders


def _extended(counts: DataFrame, shorter: DataFrame) -> DataFrame:
    """Counts of one order (lang, head, tail, a, id) with their words and the counts of their parts."""
    first = shorter.select(F.col("id").alias("head"), F.col("phrase").alias("h_phrase"), F.col("a").alias("h_a"), F.col("lefts").alias("h_lefts"))
    last = shorter.select(F.col("id").alias("tail"), F.col("phrase").alias("t_phrase"), F.col("a").alias("t_a"), F.col("rights").alias("t_rights"))
    in_prefix_order = counts.join(first.hint("merge"), "head")
    both = in_prefix_order.join(last.hint("merge"), "tail")
    return both.select(
        "lang",
        "id",
        "head",
        "tail",
        F.concat("h_phrase", F.lit(" "), F.substring_index("t_phrase", " ", -1)).alias("phrase"),
        "a",
        F.concat("h_lefts", F.array("h_a")).alias("lefts"),
        F.concat("t_rights", F.array("t_a")).alias("rights"),
    )


def standing(order: DataFrame, following: DataFrame | None, share: int = SHARE) -> DataFrame:
    """Phrases that no phrase one word longer covers."""
    if following is None:
        return order
    right = following.groupBy(F.col("head").alias("id")).agg(F.max("a").alias("to_right"))
    left = following.groupBy(F.col("tail").alias("id")).agg(F.max("a").alias("to_left"))
    known = order.join(right.hint("merge"), "id", "left").join(left.hint("merge"), "id", "left")
    covered = 100 * F.greatest(F.coalesce("to_right", F.lit(0)), F.coalesce("to_left", F.lit(0))) >= share * F.col("a")
    return known.where(~covered).select(*order.columns)


#: The worst cut of a phrase: products of counts need 38 digits.
WORST = """array_min(transform(sequence(1, size(lefts)), k -> struct(
  (cast(1000 * a AS decimal(19, 0)) * cast(n AS decimal(19, 0))) div (cast(lefts[k - 1] AS decimal(19, 0)) * cast(rights[size(lefts) - k] AS decimal(19, 0))) AS score,
  k AS k, lefts[k - 1] AS l, rights[size(lefts) - k] AS r)))"""


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, first: int = FIRST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the first phrases of each language."""
    totals, orders = phrases(docs, longest, least)
    kept = [standing(o, f) for o, f in zip(orders[1:], [*orders[2:], None])]
    scored = reduce(DataFrame.unionByName, kept).join(totals, "lang").withColumn("cut", F.expr(WORST))
    rows = scored.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    by_score = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(by_score).cast("long")).where(F.col("rank") <= first)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = """
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^ \\t]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)
), f AS (
  SELECT lang, m, phrase, count(*) AS a FROM (
    SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM pieces, range(1, 6) o(m)))
  GROUP BY 1, 2, 3
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM pieces GROUP BY 1
), candidates AS (
  SELECT * FROM f WHERE m >= 2 AND a >= 100
), standing AS (
  SELECT c.* FROM candidates c WHERE NOT EXISTS (
    SELECT 1 FROM candidates x WHERE x.lang = c.lang AND x.m > c.m AND x.a >= c.a AND contains(' ' || x.phrase || ' ', ' ' || c.phrase || ' '))
), cuts AS (
  SELECT lang, phrase, m, a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head, array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, m)) AS k FROM standing)
), scored AS (
  SELECT c.lang, c.phrase, c.a, h.a AS l, t.a AS r, n, (1000 * CAST(c.a AS HUGEINT) * n) // (CAST(h.a AS HUGEINT) * t.a) AS score, c.k
  FROM cuts c JOIN f h ON h.lang = c.lang AND h.m = c.k AND h.phrase = c.head JOIN f t ON t.lang = c.lang AND t.m = c.m - c.k AND t.phrase = c.tail JOIN totals o ON o.lang = c.lang
), worst AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM worst QUALIFY rank <= 2000
"""
