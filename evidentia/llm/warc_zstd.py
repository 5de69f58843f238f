"""WARC archives under Zstandard with a dictionary, written and read as plain files in a shared folder.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the dictionary; each record is one Zstandard frame
that needs it, so records can be read one by one. The dictionary is trained on the first payloads of the archive (at
most ``TRAIN_BYTES``), or is their raw content where there is too little to train on. The reader takes the dictionary
from that frame, decodes frame by frame in bounded memory, and checks each record's version line, named fields, content
length, end marks, HTTP head, and the payload's digest and length.

Of records with equal payloads of at least ``LEAST_BYTES`` bytes, that with the smallest page_id is the response; the
others are revisits, which hold the HTTP head alone and refer to it.

Defined cases: a null html is an empty payload; a null page_id is always a response, as are all rows that share the
smallest page_id of their payload; rows that repeat are written one by one; a null url is written as ``about:blank``; an
empty table writes no archive and gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch, has_columns, sized

#: Fixed values of the format.
DICTIONARY_MAGIC = 0x184D2A5D
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Shorter payloads are never revisits.
LEAST_BYTES = 100

#: Bytes of payload after which an archive is closed; bytes that its dictionary is trained on; the dictionary's size.
ARCHIVE_BYTES, TRAIN_BYTES, DICTIONARY_BYTES = 64 << 20, 2 << 20, 64 << 10

#: Archives are read by at most so many tasks.
READERS = 2_000

#: A time for all records, since the pages have none.
DATE = "1970-01-01T00:00:00Z"

_FIELD = re.compile(rb"([!#$%&'*+.^_`|~0-9A-Za-z-]+): ?(.*)")


class BadArchive(ValueError):
    """A header or a length that is not right."""


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response, or where it refers to another record a revisit."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'null' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        *([("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)] if refers_to is not None else []),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The parts of one record, all of them checked."""

    def need(good: bool, what: str) -> None:
        if not good:
            raise BadArchive(what)

    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    need(bool(gap) and lines[0] == VERSION, "version line")
    fields: dict[bytes, bytes] = {}
    for line in lines[1:]:
        m = _FIELD.fullmatch(line)
        need(m is not None, "named field")
        need(m[1].lower() not in fields, "repeated field")
        fields[m[1].lower()] = m[2]
    for name in (b"warc-type", b"warc-record-id", b"warc-date", b"content-length"):
        need(name in fields, f"no {name.decode()}")
    need(re.fullmatch(rb"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", fields[b"warc-date"]) is not None, "date")
    need(fields[b"content-length"].isdigit(), "content length")
    n = int(fields[b"content-length"])
    need(len(rest) == n + 4 and rest[n:] == b"\r\n\r\n", "content length")
    kind = fields[b"warc-type"].decode()
    need(kind in ("response", "revisit"), "record type")
    http, gap, payload = rest[:n].partition(b"\r\n\r\n")
    need(bool(gap) and http.startswith(b"HTTP/1."), "HTTP head")
    size = re.search(rb"(?mi)^content-length: *(\d+)\r?$", http)
    need(size is not None, "payload length")
    digest = fields.get(b"warc-payload-digest", b"").decode()
    need(re.fullmatch(r"sha256:[0-9a-f]{64}", digest) is not None, "digest field")

    def page(name: bytes) -> int | None:
        m = re.fullmatch(rb"<urn:page:(null|-?\d+)>", fields.get(name, b""))
        need(m is not None, name.decode())
        return None if m[1] == b"null" else int(m[1])

    if kind == "response":
        need(len(payload) == int(size[1]), "payload length")
        need(hashlib.sha256(payload).hexdigest() == digest[7:], "payload digest")
    else:
        need(not payload and fields.get(b"warc-profile", b"").decode() == REVISIT_PROFILE, "revisit")
    return {
        "page_id": page(b"warc-record-id"), "url": fields.get(b"warc-target-uri", b"").decode(), "payload": payload if kind == "response" else None,
        "payload_bytes": int(size[1]), "payload_digest": digest[7:], "record_type": kind, "refers_to": page(b"warc-refers-to") if kind == "revisit" else None,
    }


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples' own first bytes where training has too little to go by."""
    import zstandard

    if len(samples) >= 16:
        try:
            return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"".join(samples)[:DICTIONARY_BYTES]


class ArchiveWriter:
    def __init__(self, out):
        self.out, self.waiting, self.held, self.bytes, self.records = out, [], 0, 0, 0
        self.compress = None

    def add(self, raw: bytes) -> None:
        self.bytes += len(raw)
        self.records += 1
        if self.compress:
            self.out.write(self.compress(raw))
            return
        self.waiting.append(raw)
        self.held += len(raw)
        if self.held >= TRAIN_BYTES:
            self._start()

    def _start(self) -> None:
        import zstandard

        content = dictionary(self.waiting)
        self.out.write(DICTIONARY_MAGIC.to_bytes(4, "little") + len(content).to_bytes(4, "little") + content)
        self.compress = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(content), write_checksum=True).compress
        for raw in self.waiting:
            self.out.write(self.compress(raw))
        self.waiting = []

    def close(self) -> None:
        if not self.compress:
            self._start()
        self.out.close()


def read_archive(source, chunk: int = 1 << 16) -> Iterator[dict]:
    """The records of an archive; ``source`` is a readable binary stream."""
    import zstandard

    head = source.read(8)
    if len(head) != 8 or int.from_bytes(head[:4], "little") != DICTIONARY_MAGIC:
        raise BadArchive("no leading dictionary frame")
    size = int.from_bytes(head[4:], "little")
    content = source.read(size)
    if len(content) != size:
        raise BadArchive("dictionary length")
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
    rest = source.read(chunk)
    while rest:
        frame, parts = reader.decompressobj(), []
        while True:
            try:
                parts.append(frame.decompress(rest))
            except zstandard.ZstdError as e:
                raise BadArchive(str(e)) from e
            if frame.eof:
                rest = frame.unused_data or source.read(chunk)
                break
            rest = source.read(chunk)
            if not rest:
                raise BadArchive("frame is cut short")
        yield parse(b"".join(parts))


def write_archives(scratch: Scratch, pages: DataFrame, folder: str) -> DataFrame:
    """Writes a record for every page; a row (path, records) for each archive.

    Archives are named anew by each attempt of a task, and only those that a finished attempt reports are ever read.
    """
    pages = has_columns(pages, page_id="long", url="string", html="string")
    pages = pages.withColumn("payload", F.coalesce("html", F.lit("")).cast("binary")).drop("html")
    pages = pages.withColumn("digest", F.unhex(F.sha2("payload", 256)))
    long_enough = F.octet_length("payload") >= LEAST_BYTES
    first = pages.filter(long_enough).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "first_id")
    first = scratch.keep(first, "first")
    told = pages.withColumn("long_enough", long_enough).join(sized(first, first.count()), "digest", "left")
    refers = F.when(F.col("long_enough") & (F.col("page_id") > F.col("first_id")), F.col("first_id"))
    told = told.select("page_id", "url", "payload", F.lower(F.hex("digest")).alias("digest"), refers.alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        writer, done = None, []
        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*(batch.column(i) for i in range(5)), strict=True):
                if writer is None:
                    path = f"{base}/pages-{TaskContext.get().partitionId():06d}-{len(done):04d}-{uuid.uuid4().hex}.warc.zst"
                    writer = ArchiveWriter(store.open_output_stream(path, compression=None))
                writer.add(record(page_id.as_py(), url.as_py(), payload.as_py(), digest.as_py(), refers_to.as_py()))
                if writer.bytes >= ARCHIVE_BYTES:
                    writer.close()
                    done.append((path, writer.records))
                    writer = None
        if writer:
            writer.close()
            done.append((path, writer.records))
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())], ["path", "records"])

    return scratch.keep(told.mapInArrow(write, "path string, records long"), "archives")


def read_archives(spark: SparkSession, archives: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to (and url, payload) of every record."""
    fields = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    fields += [("url", pa.string()), ("payload", pa.binary())] if payloads else []

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        def out(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in fields], [k for k, _ in fields])

        store = fs.FileSystem.from_uri(folder)[0]
        for batch in batches:
            for path, records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows, n = [], 0
                with store.open_input_stream(path, compression=None) as source:
                    for r in read_archive(source):
                        rows.append(r)
                        n += 1
                        if len(rows) >= 500:
                            yield out(rows)
                            rows = []
                if n != records:
                    raise BadArchive(f"{path}: {n} of {records} records")
                yield out(rows)

    types = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", url string, payload binary" * payloads
    return archives.repartition(max(1, min(READERS, archives.count()))).mapInArrow(read, types)


def warc_round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Writes a record for every page and gives what reading the archives back finds."""
    scratch = Scratch(spark, "warc")
    folder = scratch.path("files")
    return read_archives(spark, write_archives(scratch, pages, folder), folder)
