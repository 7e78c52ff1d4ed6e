"""WARC archives: a writer, and a sequential reader that checks what it reads.

Each record is one gzip member. The reader inflates members one after the other
in pieces, takes the block's length from the record header, and verifies block
and payload digests while the bytes pass, so neither an archive nor a record is
ever held whole.

Of records with equal payloads of at least ``REVISIT_BYTES`` the one with the
largest page_id is a ``response``; the others are ``revisit`` records that name
it and carry no payload.

Defined results: a null html is an empty payload; a null page_id is written and
read as null and is never the largest; rows repeated under the largest page_id
are all responses; an empty table gives no archive and no row.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.llm.storage import fresh, materialized, reading, writing

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 64 << 20  # an archive is closed once it is this long
PIECE = 64 << 10
EPOCH = "2020-01-01T00:00:00Z"  # the tables hold no fetch time; a fixed one keeps archives reproducible
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

READ_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, archive string, offset long"


class WarcError(ValueError):
    """An archive is cut short or a digest or length does not hold."""


def planned(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, refers_to: what is to be written of each page.

    Only groups with several rows are joined back, and of each only its digest and
    largest id, aggregated before the shuffle: a payload that a third of all pages
    share is one row there.
    """
    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    groups = (
        rows.where(F.octet_length("payload") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("cnt"))
        .where((F.col("cnt") > 1) & F.col("largest").isNotNull())
        .select("digest", "largest")
    )
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest"))
    return rows.join(groups, "digest", "left").select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def _base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(record_id: str) -> int | None:
    number = record_id.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as one gzip member."""
    http = HTTP.format(len(payload)).encode()
    block = http + (payload if refers_to is None else b"")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _record_id(page_id)),
        ("WARC-Date", EPOCH),
        ("WARC-Payload-Digest", f"sha1:{_base32(digest)}"),
        ("WARC-Block-Digest", f"sha1:{_base32(hashlib.sha1(block).hexdigest())}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.insert(3, ("WARC-Target-URI", "".join(url.splitlines())))
    if refers_to is not None:
        fields[-2:-2] = [("WARC-Refers-To", _record_id(refers_to)), ("WARC-Profile", PROFILE)]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(head.encode()) + pack.compress(block) + pack.compress(b"\r\n\r\n") + pack.flush()


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write every page and return the committed table of archives: archive, records, bytes."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to"))))
        row = next(rows, None)
        while row is not None:
            with writing(folder, ".warc.gz") as (uri, out):
                records = length = 0
                while row is not None and length < archive_bytes:
                    length += out.write(record(*(x.as_py() for x in row)))
                    records += 1
                    row = next(rows, None)
            yield pa.RecordBatch.from_pydict({"archive": [uri], "records": [records], "bytes": [length]})

    return materialized(planned(pages).mapInArrow(write, "archive string, records long, bytes long"), "archives")


class _Member:
    """Sequential reader over the gzip members of one stream."""

    def __init__(self, source):
        self.source, self.waiting, self.offset, self.unread = source, b"", 0, b""
        self.inflate = None

    def open(self) -> bool:
        """Start the next member; False at the end of the archive."""
        self.waiting = self.waiting or self.source.read(PIECE)
        self.inflate, self.unread = zlib.decompressobj(31), b""
        return bool(self.waiting)

    def piece(self) -> bytes:
        """Some inflated bytes; empty at the end of the member."""
        while not self.unread and not self.inflate.eof:
            self.waiting = self.waiting or self.source.read(PIECE)
            if not self.waiting:
                raise WarcError("archive ends inside a record")
            fed = len(self.waiting)
            self.unread = self.inflate.decompress(self.waiting, PIECE)
            self.waiting = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            self.offset += fed - len(self.waiting)
        got, self.unread = self.unread, b""
        return got

    def until(self, mark: bytes, limit: int = 1 << 20) -> bytes:
        """Bytes up to and with ``mark``; what follows stays unread."""
        got = b""
        while mark not in got:
            more = self.piece()
            if not more or len(got) > limit:
                raise WarcError("no end of header")
            got += more
        end = got.index(mark) + len(mark)
        self.unread = got[end:] + self.unread
        return got[:end]

    def exactly(self, n: int) -> Iterator[bytes]:
        while n:
            more = self.piece()
            if not more:
                raise WarcError("record is shorter than its Content-Length")
            part, self.unread = more[:n], more[n:]
            n -= len(part)
            yield part


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}


def read_archive(source, archive: str = "") -> Iterator[dict]:
    """The records of one archive in order; raises ``WarcError`` where a check fails."""
    member = _Member(source)
    while member.open():
        at = member.offset
        fields = _fields(member.until(b"\r\n\r\n"))
        length = int(fields["content-length"])
        http = member.until(b"\r\n\r\n")
        if len(http) > length:
            raise WarcError("HTTP header exceeds the block")
        block, payload, size = hashlib.sha1(http), hashlib.sha1(), 0
        for part in member.exactly(length - len(http)):
            block.update(part)
            payload.update(part)
            size += len(part)
        rest = b"".join(iter(member.piece, b""))
        if rest != b"\r\n\r\n":
            raise WarcError("record does not end after its Content-Length")
        if fields["warc-block-digest"] != f"sha1:{_base32(block.hexdigest())}":
            raise WarcError("block digest differs")
        revisit = fields["warc-type"] == "revisit"
        digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
        if not revisit and digest != payload.hexdigest():
            raise WarcError("payload digest differs")
        yield {
            "page_id": _page_id(fields["warc-record-id"]),
            "payload_bytes": None if revisit else size,
            "payload_digest": digest,
            "record_type": fields["warc-type"],
            "refers_to": _page_id(fields["warc-refers-to"]) if revisit else None,
            "url": fields.get("warc-target-uri"),
            "archive": archive,
            "offset": at,
        }


def read_archives(archives: DataFrame, batch: int = 2000) -> DataFrame:
    """Records of the archives named in ``archives``; each archive is read by one task.

    A revisit takes the length of its payload from the response it names, whose
    digest must be its own.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[dict] = []
        for uri in (u for b in batches for u in b.column("archive").to_pylist()):
            with reading(uri) as source:
                for row in read_archive(source, uri):
                    kept.append(row)
                    if len(kept) >= batch:
                        yield pa.RecordBatch.from_pylist(kept, READ)
                        kept = []
        if kept:
            yield pa.RecordBatch.from_pylist(kept, READ)

    files = archives.count()
    records = archives.select("archive").repartition(max(1, files)).mapInArrow(read, READ_SCHEMA)
    records = materialized(records, "records")
    named = records.where(F.col("record_type") == "revisit").select(F.col("refers_to").alias("page_id"), "payload_digest").distinct()
    lengths = (
        records.where(F.col("record_type") == "response")
        .join(named, ["page_id", "payload_digest"], "left_semi")
        .groupBy(F.col("page_id").alias("refers_to"), "payload_digest")
        .agg(F.max("payload_bytes").alias("referred_bytes"))
    )
    return records.join(lengths, ["refers_to", "payload_digest"], "left").select(
        "page_id", F.coalesce("payload_bytes", "referred_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to", "url", "archive", "offset"
    )


READ = pa.schema(
    [
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("url", pa.string()),
        ("archive", pa.string()),
        ("offset", pa.int64()),
    ]
)


def roundtrip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write the pages as archives and read them back."""
    return read_archives(write_archives(pages, fresh(spark, "warc")))
