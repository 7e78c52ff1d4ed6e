"""Token counts of whole texts; huge texts by overlapping chunks.

A text longer than ``HUGE`` characters is cut into overlapping chunks. Each chunk
is encoded with offsets, and two neighbours are spliced at a boundary both have:
a place inside the overlap right after white space where in either encoding one
token ends and the next begins. No token and no normalisation of this kind of
tokenizer reaches over white space, so what follows such a place is the same as
in the whole text. Where the overlap has none, the next chunk starts earlier in
its neighbour and ends later, until it has one or the text ends.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows are
counted one by one; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselake.llm import tokens

#: Characters from which a text is cut, the length of a chunk, and the first overlap.
HUGE = 65_536
CHUNK = 32_768
OVERLAP = 1_024
LIMIT = 2_048

SPACE = frozenset(" \t\n\v\f\r")


def boundaries(text: str, low: int, high: int, starts: set[int]) -> list[int]:
    """Positions in [low, high) right after white space where a token starts."""
    return [p for p in range(max(low, 1), high) if text[p - 1] in SPACE and p in starts]


def chunked_count(text: str, encode, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of ``text``; ``encode`` gives the (start, end) offsets of a string's tokens."""
    total, start, end = 0, 0, min(chunk, len(text))
    left = _offsets(encode, text, start, end)
    while end < len(text):
        reach = overlap
        while True:
            # the whole left chunk is the widest overlap; beyond it the left chunk itself grows
            begin = max(start, end - reach)
            stop = min(len(text), begin + max(chunk, 2 * reach))
            right = _offsets(encode, text, begin, stop)
            shared = set(left[:, 0].tolist()) & set(right[:, 0].tolist())
            # the last piece of the left chunk and the first of the right one may be cut
            common = boundaries(text, begin + 1, end, shared)
            if common:
                break
            if begin == start:
                end = min(len(text), end + reach)
                left = _offsets(encode, text, start, end)
                if end == len(text):
                    return total + len(left)
            reach *= 2
        at = common[-1]
        total += int((left[:, 0] < at).sum())
        left, start, end = right[right[:, 0] >= at], at, stop
    return total + len(left)


def _offsets(encode, text: str, start: int, end: int) -> np.ndarray:
    return np.asarray(encode(text[start:end]), np.int64).reshape(-1, 2) + start


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT, huge: int = HUGE) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every document."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(tokenizer)

        def offsets(piece: str) -> list[tuple[int, int]]:
            return encoder.tokenizer.encode(piece, add_special_tokens=False).offsets

        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            long = pc.greater(pc.utf8_length(texts), huge)
            short = pc.if_else(long, "", texts)
            counts = [per_text for per_text, *_ in encoder.slices(short)]
            n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            for i in np.flatnonzero(long.to_numpy(zero_copy_only=False)):
                n[i] = chunked_count(texts[i].as_py(), offsets)
            size = pc.cast(pc.binary_length(texts), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), size, pa.array(n)], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
