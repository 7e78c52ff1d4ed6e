"""Token files: ids of all documents in id order, Huffman-coded in blocks.

Two passes. The first ranges the texts by doc_id, encodes them, counts the ids and
writes blocks of at most ``BLOCK`` ids; the counts of all tasks give the global code.
The second codes each block and writes one file per range. A document may span blocks,
so neither a block nor a file ever holds more than a bounded number of ids in memory.
Rows of one doc_id, or without any, are dealt over ranges by the start of their text
and by where they come from, so that a common id is not one task and one file.

File: magic, JSON header with its length (code lengths, first token of the
file), then blocks, each with its length: number of ids and of checkpoints,
documents that end or go on in it, bit checkpoints, code bits. Every file is
read by itself, every block decoded by itself.

Defined results: a null text has only the end id; a null doc_id comes first;
repeated rows are written as often as they occur, equal ids in order of the first
``PREFIX`` characters of their text; a text may be of any length; other columns are
not read; an empty table gives no file and no row.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.llm import huffman, tokens
from caselake.llm.storage import discard, fresh, materialized, reading, writing

MAGIC = b"CLTOKEN2"
#: Ids in a block.
BLOCK = 65_536
#: Id appended to each document.
END = 1
#: Rows an arrow batch of results holds.
ROWS = 2_000
#: Characters of a text that order rows of one doc_id, and parts over which rows that agree in these are dealt.
PREFIX, DEALT = 64, 1_024

#: A document's part in a block: id, whether that is null, its first token in the file, ids in this block, whether it ends here.
DOC = np.dtype([("doc", "<i8"), ("null", "?"), ("first", "<i8"), ("n", "<u4"), ("ends", "?")])
#: ``counts`` stands in one further row of each task: occurrences of each id.
BLOCKS = pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("docs", pa.binary()), ("ids", pa.binary()), ("n", pa.int32()), ("counts", pa.binary())])
BLOCK_SCHEMA = "part int, seq long, docs binary, ids binary, n int, counts binary"


class Cutter:
    """Cuts a run of documents into blocks of ids."""

    def __init__(self, part: int):
        self.part, self.seq, self.start, self.end = part, 0, 0, 0  # tokens before what is held, and with it
        self.ids: list[np.ndarray] = []
        self.docs = np.zeros(0, DOC)
        self.counts = np.zeros(0, np.int64)

    def add(self, docs: pa.Array, per_text: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Take documents with their ids, each of which gets the end id."""
        lengths = per_text + 1
        ends = np.cumsum(lengths)
        ended = np.full(int(ends[-1]) if len(ends) else 0, END, np.uint32)
        inside = np.ones(len(ended), bool)
        inside[ends - 1] = False
        ended[inside] = ids
        new = np.zeros(len(docs), DOC)
        new["doc"], new["null"] = docs.fill_null(0).to_numpy(), docs.is_null().to_numpy(zero_copy_only=False)
        new["first"] = self.end + ends - lengths
        self.docs = np.concatenate([self.docs, new])
        self.ids.append(ended)
        self.end += len(ended)
        if self.end - self.start >= BLOCK:
            yield from self.blocks(BLOCK)

    def blocks(self, least: int) -> Iterator[pa.RecordBatch]:
        """Blocks of what is held, as long as that is ``least`` ids or more."""
        if self.end == self.start:
            return
        ids = np.concatenate(self.ids)
        firsts = self.docs["first"]
        ends = np.append(firsts[1:], self.end)
        while self.end - self.start >= least and self.end > self.start:
            stop = min(self.start + BLOCK, self.end)
            low, high = np.searchsorted(ends, self.start, "right"), np.searchsorted(firsts, stop, "left")
            spans = self.docs[low:high].copy()
            spans["n"] = np.minimum(ends[low:high], stop) - np.maximum(firsts[low:high], self.start)
            spans["ends"] = ends[low:high] <= stop
            block, ids = ids[: stop - self.start], ids[stop - self.start :]
            self.count(block)
            row = {"part": [self.part], "seq": [self.seq], "docs": [spans.tobytes()], "ids": [block.astype("<u4").tobytes()], "n": [len(block)], "counts": [None]}
            yield pa.RecordBatch.from_pydict(row, BLOCKS)
            self.seq, self.start = self.seq + 1, stop
        self.ids, self.docs = [ids.copy()], self.docs[np.searchsorted(ends, self.start, "right") :]

    def count(self, ids: np.ndarray) -> None:
        got = np.bincount(ids)
        if len(got) > len(self.counts):
            self.counts = np.pad(self.counts, (0, len(got) - len(self.counts)))
        self.counts[: len(got)] += got

    def counted(self) -> pa.RecordBatch:
        row = {"part": [self.part], "seq": [-1], "docs": [None], "ids": [None], "n": [0], "counts": [self.counts.tobytes()]}
        return pa.RecordBatch.from_pydict(row, BLOCKS)


def blocks(docs: DataFrame, tokenizer: str, partitions: int) -> DataFrame:
    """Blocks of ids in doc_id order, part and seq give their place; and the counts of each part."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, encoder = Cutter(TaskContext.get().partitionId()), tokens.encoder(tokenizer)
        for batch in batches:
            at = 0
            for per_text, codes, per_entry, flat in encoder.slices(batch.column("text")):
                yield from cutter.add(batch.column("doc_id").slice(at, len(per_text)), per_text, tokens.gathered(codes, per_entry, flat))
                at += len(per_text)
        yield from cutter.blocks(1)
        yield cutter.counted()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dealt = F.pmod(F.monotonically_increasing_id(), F.lit(DEALT))
    ranged = rows.repartitionByRange(partitions, "doc_id", F.substring("text", 1, PREFIX), dealt)
    return ranged.sortWithinPartitions("doc_id", "text").mapInArrow(encode, BLOCK_SCHEMA)


def id_counts(table: DataFrame) -> np.ndarray:
    """Occurrences of each id: the parts' counts are summed in a few tasks, of which each sends one row of the vocabulary's size."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _added(c.as_buffer() for batch in batches for c in batch.column("counts"))
        yield pa.RecordBatch.from_pydict({"counts": pa.array([total.tobytes()], pa.binary())})

    parts = table.where("seq = -1").select("counts").repartition(8).mapInArrow(add, "counts binary").collect()
    return _added(r["counts"] for r in parts)


def _added(packed) -> np.ndarray:
    total = np.zeros(0, np.int64)
    for one in packed:
        counts = np.frombuffer(one, "<i8")
        total = np.pad(total, (0, max(0, len(counts) - len(total))))
        total[: len(counts)] += counts
    return total


def write_files(table: DataFrame, folder: str) -> DataFrame:
    """Code and write all blocks, one file per part: part, file, ids.

    What reaches the driver is bounded: a row per id of the vocabulary, and a row
    per file.
    """
    spark = table.sparkSession
    counts = id_counts(table)
    sizes = {r["part"]: r["n"] for r in table.where("seq >= 0").groupBy("part").agg(F.sum("n").alias("n")).collect()}
    first, running = {}, 0
    for part in sorted(sizes):
        first[part], running = running, running + sizes[part]
    lengths = huffman.code_lengths(counts)
    shared = spark.sparkContext.broadcast((huffman.canonical_codes(lengths), lengths, first))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, lengths, _ = shared.value
        for batch in batches:
            for part, seq, docs, ids in zip(*(batch.column(c) for c in ("part", "seq", "docs", "ids"))):
                values = np.frombuffer(ids.as_buffer(), "<u4")
                bits, checkpoints = huffman.encode(values, codes, lengths)
                docs = docs.as_py()
                head = struct.pack("<III", len(values), len(checkpoints), len(docs) // DOC.itemsize)
                body = head + docs + checkpoints.astype("<u4").tobytes() + bits
                yield pa.RecordBatch.from_pydict({"part": [part.as_py()], "seq": [seq.as_py()], "body": [body]}, CODED)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, lengths, first = shared.value
        rows = ((p.as_py(), b) for x in batches for p, b in zip(x.column("part"), x.column("body")))
        row = next(rows, None)
        while row is not None:
            part = row[0]
            with writing(folder, ".tok") as (uri, out):
                head = json.dumps({"first_token": first[part], "part": part, "stride": huffman.STRIDE}).encode()
                packed = zlib.compress(lengths.tobytes())
                out.write(MAGIC + struct.pack("<II", len(head), len(packed)) + head + packed)
                while row is not None and row[0] == part:
                    body = row[1].as_buffer()
                    out.write(struct.pack("<I", len(body)))
                    out.write(body)
                    row = next(rows, None)
            yield pa.RecordBatch.from_pydict({"part": [part], "file": [uri]}, FILES)

    coded = table.where("seq >= 0").select("part", "seq", "docs", "ids").mapInArrow(code, "part int, seq long, body binary")
    ranged = coded.repartition(max(1, len(sizes)), "part").sortWithinPartitions("part", "seq")
    return materialized(ranged.mapInArrow(write, "part int, file string"), "token-files")


CODED = pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("body", pa.binary())])
FILES = pa.schema([("part", pa.int32()), ("file", pa.string())])


def read_file(source) -> Iterator[tuple[int | None, int, np.ndarray, bool]]:
    """(doc_id, first token, ids, whether they are the document's last) in file order.

    A long document comes in several pieces; a block is decoded at a time.
    """

    def take(n: int) -> bytes:
        got = source.read(n)
        if len(got) != n:
            raise ValueError("token file is cut short")
        return bytes(got)

    if take(len(MAGIC)) != MAGIC:
        raise ValueError("not a token file")
    n_head, n_packed = struct.unpack("<II", take(8))
    head = json.loads(take(n_head))
    if head["stride"] != huffman.STRIDE:
        raise ValueError("other checkpoint distance")
    table, limit = huffman.decoding_table(np.frombuffer(zlib.decompress(take(n_packed)), np.uint8))
    while size := source.read(4):
        body = take(struct.unpack("<I", size)[0])
        n, n_checkpoints, n_docs = struct.unpack_from("<III", body)
        at = 12 + n_docs * DOC.itemsize
        checkpoints = np.frombuffer(body, "<u4", n_checkpoints, at)
        ids = huffman.decode(body[at + 4 * n_checkpoints :], checkpoints, n, table, limit)
        used = 0
        for doc, null, first, here, ends in np.frombuffer(body, DOC, n_docs, 12).tolist():
            yield None if null else doc, head["first_token"] + first, ids[used : used + here], ends
            used += here


def read_documents(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files, one task per file."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple] = []

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*kept)], ["doc_id", "start", "n_tokens", "ids_crc32"])

        for uri in (u for b in batches for u in b.column("file").to_pylist()):
            n = crc = 0
            with reading(uri) as source:
                for doc, first, ids, ends in read_file(source):
                    n, crc = n + len(ids), zlib.crc32(ids.astype("<u4", copy=False), crc)
                    if ends:
                        kept.append((doc, first, n, crc))
                        n = crc = 0
                        if len(kept) >= ROWS:
                            yield flush()
                            kept = []
        if kept:
            yield flush()

    n = files.count()
    return files.select("file").repartition(max(1, n)).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def partitions_for(spark: SparkSession) -> int:
    """As many ranges, and so files, as the session has shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def roundtrip(spark: SparkSession, docs: DataFrame, tokenizer: str, partitions: int | None = None) -> DataFrame:
    """Write the documents as token files and read them back."""
    table = materialized(blocks(docs, tokenizer, partitions or partitions_for(spark)), "token-blocks")
    files = write_files(table, fresh(spark, "tokens"))
    discard(table)
    return read_documents(files)
