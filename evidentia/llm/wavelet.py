"""Token ids in wavelet matrices: one compressed file that gives access, counts and occurrences.

A shard file holds blocks of about ``BLOCK_TOKENS`` ids. A block is a wavelet matrix: one bit-plane for each bit of an
id, from the highest down, each plane a stable split of the one above, with the count of ones before every 512 bits.
rank and select on the planes give the token at a place, the count of a token in a range, and the place of its n-th
occurrence, without decoding the rest.

File: ``EVWM0001``; blocks; a footer of JSON with each block's offset, sizes and zeros; its length in 8 bytes. A block is
doc_ids (int64) and a null flag each, documents' lengths (uint32), then for every plane its bits and its counts. Parts
are Zstandard frames where that makes them smaller. Documents lie in ascending doc_id order; null doc_ids come first.

Defined cases: a null text counts as empty; an empty document is its end id alone; rows that repeat are written one by
one; an empty table writes no file and gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import bisect
import json
import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scratch import Scratch, has_columns
from .tokens import default_path, encoder, together

MAGIC = b"EVWM0001"

#: Ids after which a block is closed, at the end of a document, and blocks in a file.
BLOCK_TOKENS, FILE_BLOCKS = 1 << 18, 128

#: The id that ends each document.
END = 0

#: Texts that are looked up at a time, by number and by bytes, and the pieces that a worker remembers for that.
ROWS, BYTES = 8_000, 8 << 20
KEPT, MOST = 1_000_000, 1_500_000

#: Files are read by at most so many tasks.
READERS = 2_000

#: Bits between two counts of ones, in bytes.
_SPAN = 64


class Plane:
    """A bit vector with rank and select."""

    def __init__(self, bits: np.ndarray, n: int, before: np.ndarray | None = None):
        self.bits, self.n = bits, n
        if before is None:
            ones = np.bitwise_count(np.pad(bits, (0, -len(bits) % _SPAN)).reshape(-1, _SPAN)).sum(axis=1, dtype=np.uint32)
            before = np.concatenate((np.zeros(1, np.uint32), np.cumsum(ones, dtype=np.uint32)))
        self.before = before

    def __getitem__(self, i: int) -> int:
        return int(self.bits[i >> 3] >> (i & 7) & 1)

    def rank(self, i: int, bit: int = 1) -> int:
        """How many of the first ``i`` bits equal ``bit``."""
        span, byte = i // (8 * _SPAN), i >> 3
        ones = int(self.before[span]) + int(np.bitwise_count(self.bits[span * _SPAN : byte]).sum())
        if i & 7:
            ones += int(self.bits[byte] & ((1 << (i & 7)) - 1)).bit_count()
        return ones if bit else i - ones

    def select(self, k: int, bit: int = 1) -> int:
        """Where the k-th (from 0) bit equal to ``bit`` is."""
        # the last span before which there are at most k such bits
        span, after = 0, len(self.before)
        while after - span > 1:
            mid = (span + after) // 2
            span, after = (mid, after) if self._seen(mid, bit) <= k else (span, mid)
        inside = np.unpackbits(self.bits[span * _SPAN : (span + 1) * _SPAN], bitorder="little")
        return span * 8 * _SPAN + int(np.flatnonzero(inside == bit)[k - self._seen(span, bit)])

    def _seen(self, span: int, bit: int) -> int:
        """How many bits equal to ``bit`` stand before a span."""
        ones = int(self.before[span])
        return ones if bit else min(span * 8 * _SPAN, self.n) - ones


class WaveletMatrix:
    def __init__(self, n: int, planes: Sequence[Plane], zeros: list[int]):
        self.n, self.planes, self.zeros = n, planes, zeros

    @classmethod
    def build(cls, ids: np.ndarray, width: int) -> WaveletMatrix:
        row, planes, zeros = ids.astype(np.uint16 if width <= 16 else np.uint32), [], []
        for shift in range(width - 1, -1, -1):
            bits = np.packbits((row & row.dtype.type(1 << shift)).astype(bool), bitorder="little")
            planes.append(Plane(bits, len(row)))
            # a plane's bits are an Arrow bitmap as they stand
            one = pa.BooleanArray.from_buffers(pa.bool_(), len(row), [None, pa.py_buffer(bits)])
            held = pa.array(row)
            low = held.filter(pc.invert(one)).to_numpy()
            zeros.append(len(low))
            row = np.concatenate((low, held.filter(one).to_numpy()))
        return cls(len(ids), planes, zeros)

    def decode(self) -> np.ndarray:
        """All ids, from the lowest plane up."""
        row = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for level in range(len(self.planes) - 1, -1, -1):
            bit = np.unpackbits(self.planes[level].bits, count=self.n, bitorder="little").view(bool)
            # a plane's split undone: its zeros lie first, in order, then its ones; by places, which are quicker than masks
            above, zeros = np.empty_like(row), self.zeros[level]
            above[np.flatnonzero(~bit)] = row[:zeros]
            above[np.flatnonzero(bit)] = row[zeros:] | row.dtype.type(1 << (len(self.planes) - 1 - level))
            row = above
        return row.astype(np.uint32)

    def access(self, i: int) -> int:
        out = 0
        for plane, zeros in zip(self.planes, self.zeros, strict=True):
            bit = plane[i]
            out = out << 1 | bit
            i = zeros + plane.rank(i) if bit else plane.rank(i, 0)
        return out

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        if token >> len(self.planes):
            return 0, 0
        for level, zeros in enumerate(self.zeros):
            if lo >= hi:  # lower planes aren't asked
                return 0, 0
            plane, bit = self.planes[level], token >> (len(self.planes) - 1 - level) & 1
            lo, hi = (zeros + plane.rank(lo), zeros + plane.rank(hi)) if bit else (plane.rank(lo, 0), plane.rank(hi, 0))
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """How often a token stands in [lo, hi)."""
        a, b = self._range(token, lo, self.n if hi is None else hi)
        return b - a

    def occurrence(self, token: int, k: int) -> int:
        """Where the k-th (from 0) occurrence of a token stands; -1 if there are fewer."""
        a, b = self._range(token, 0, self.n)
        if k >= b - a:
            return -1
        at = a + k
        for level in range(len(self.planes) - 1, -1, -1):
            bit = token >> (len(self.planes) - 1 - level) & 1
            at = self.planes[level].select(at - self.zeros[level] if bit else at, bit)
        return at


def _packed(part: bytes) -> tuple[bytes, int]:
    import zstandard

    small = zstandard.ZstdCompressor(level=1).compress(part)
    return (small, 1) if len(small) < 0.95 * len(part) else (part, 0)


class ShardWriter:
    """One file; documents come in order."""

    def __init__(self, out, width: int):
        self.out, self.width, self.at, self.blocks = out, width, 0, []
        self.docs: list[int | None] = []
        self.rows: list[np.ndarray] = []
        self.held = self.tokens = 0
        self._put(MAGIC)

    def _put(self, part: bytes) -> None:
        self.out.write(part)
        self.at += len(part)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.rows.append(ids)
        self.held += len(ids)
        if self.held >= BLOCK_TOKENS:
            self.flush()

    def flush(self) -> None:
        if not self.docs:
            return
        matrix = WaveletMatrix.build(np.concatenate(self.rows), self.width)
        parts = [np.array([x or 0 for x in self.docs], "<i8").tobytes(), bytes(x is None for x in self.docs), np.array([len(x) for x in self.rows], "<u4").tobytes()]
        for plane in matrix.planes:
            parts += [plane.bits.tobytes(), plane.before.astype("<u4").tobytes()]
        start, sizes = self.at, []
        for part in parts:
            packed, how = _packed(part)
            sizes.append((len(packed), how))
            self._put(packed)
        self.blocks.append({"at": start, "n": matrix.n, "docs": len(self.docs), "zeros": matrix.zeros, "parts": sizes})
        self.tokens += matrix.n
        self.docs, self.rows, self.held = [], [], 0

    def close(self) -> None:
        self.flush()
        footer = json.dumps({"width": self.width, "blocks": self.blocks}).encode()
        self._put(footer + len(footer).to_bytes(8, "little"))
        self.out.close()


class _StoredPlanes(Sequence):
    """A block's planes, each read when it is first asked for."""

    def __init__(self, reader: ShardReader, block: dict):
        self.reader, self.block, self.held = reader, block, {}

    def __len__(self) -> int:
        return len(self.block["zeros"])

    def __getitem__(self, level: int) -> Plane:
        if not 0 <= level < len(self):
            raise IndexError(level)
        if level not in self.held:
            bits, before = (self.reader.part(self.block, 3 + 2 * level + i) for i in (0, 1))
            self.held[level] = Plane(np.frombuffer(bits, np.uint8), self.block["n"], np.frombuffer(before, "<u4"))
        return self.held[level]


class ShardReader:
    """Reads one file; ``source`` is a pyarrow random-access file.

    access, count and occurrence answer for the whole file, by places from 0 to ``n`` - 1, and read only the planes of
    the blocks that they need; iterating gives block after block.
    """

    def __init__(self, source):
        self.source = source
        size = source.size()
        if source.read_at(8, 0) != MAGIC:
            raise ValueError("not a shard of wavelet matrices")
        n = int.from_bytes(source.read_at(8, size - 8), "little")
        self.footer = json.loads(source.read_at(n, size - 8 - n))
        self.blocks = self.footer["blocks"]
        #: The first place of each block, and the number of ids in all.
        self.starts = np.cumsum([0, *(b["n"] for b in self.blocks)]).tolist()
        self.n = self.starts[-1]

    def part(self, block: dict, i: int) -> bytes:
        import zstandard

        size, how = block["parts"][i]
        raw = self.source.read_at(size, block["at"] + sum(s for s, _ in block["parts"][:i]))
        return zstandard.ZstdDecompressor().decompress(raw) if how else raw

    def matrix(self, block: dict) -> WaveletMatrix:
        return WaveletMatrix(block["n"], _StoredPlanes(self, block), block["zeros"])

    def access(self, i: int) -> int:
        """The id at a place of the file."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at = bisect.bisect_right(self.starts, i) - 1
        return self.matrix(self.blocks[at]).access(i - self.starts[at])

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """How often a token stands in [lo, hi)."""
        hi, out = self.n if hi is None else min(hi, self.n), 0
        for start, block in zip(self.starts, self.blocks, strict=False):
            if start < hi and start + block["n"] > lo:
                out += self.matrix(block).count(token, max(lo - start, 0), min(hi - start, block["n"]))
        return out

    def occurrence(self, token: int, k: int) -> int:
        """Where the k-th (from 0) occurrence of a token stands; -1 if there are fewer."""
        for start, block in zip(self.starts, self.blocks, strict=False):
            matrix = self.matrix(block)
            n = matrix.count(token)
            if k < n:
                return start + matrix.occurrence(token, k)
            k -= n
        return -1

    def __iter__(self) -> Iterator[tuple[list[int | None], np.ndarray, WaveletMatrix]]:
        """(doc_ids, lengths, matrix) of each block."""
        for block in self.blocks:
            ids, null, lengths = (self.part(block, i) for i in range(3))
            docs = [None if z else int(d) for d, z in zip(np.frombuffer(ids, "<i8"), np.frombuffer(null, np.uint8), strict=True)]
            yield docs, np.frombuffer(lengths, "<u4"), self.matrix(block)


def write_shards(spark: SparkSession, docs: DataFrame, folder: str, tokenizer: str, end: int = END) -> DataFrame:
    """Encodes and writes all documents in doc_id order; a row (part, seq, path, tokens) for each file.

    Files are named anew by each attempt of a task, and only those that a finished attempt reports are ever read.
    """
    rows = has_columns(docs, doc_id="long", text="string").withColumn("text", F.coalesce("text", F.lit("")))
    # the hash spreads a doc_id that repeats very often; equal rows stay in one task, which streams them
    rows = rows.withColumn("spread", F.xxhash64("text")).repartitionByRange("doc_id", "spread").sortWithinPartitions("doc_id", "spread").select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        tokens = encoder(tokenizer, kept=KEPT, most=MOST, rows=ROWS, size=BYTES)
        width, stop = max(1, (tokens.vocabulary - 1).bit_length()), np.array([end], np.uint32)
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        part, seq, writer, done = TaskContext.get().partitionId(), 0, None, []

        def finish() -> None:
            writer.close()
            done.append((part, seq, path, writer.tokens))

        for doc_ids, texts in together(batches, ROWS, BYTES):
            ids, sizes = tokens.encode_arrow(texts)
            for doc_id, own in zip(doc_ids.to_pylist(), np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
                if writer is None:
                    path = f"{base}/part-{part:06d}-{seq:04d}-{uuid.uuid4().hex}.evwm"
                    writer = ShardWriter(store.open_output_stream(path), width)
                writer.add(doc_id, np.concatenate((own, stop)))
                if len(writer.blocks) >= FILE_BLOCKS:
                    finish()
                    writer, seq = None, seq + 1
        if writer:
            finish()
        columns = list(zip(*done, strict=True)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.string(), pa.int64()), strict=True)], ["part", "seq", "path", "tokens"])

    return rows.mapInArrow(write, "part int, seq int, path string, tokens long")


def read_shards(spark: SparkSession, files: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    parts = files.groupBy("part").agg(F.sum("tokens").alias("in_part"))
    # one row for each task that wrote
    before = F.sum("in_part").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("in_part")
    inside = F.sum("tokens").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)) - F.col("tokens")
    placed = files.withColumn("inside", inside).join(F.broadcast(parts.select("part", before.alias("before"))), "part")
    placed = placed.select("path", (F.col("before") + F.col("inside")).alias("start"))
    n = max(1, min(READERS, files.count()))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store = fs.FileSystem.from_uri(folder)[0]
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with store.open_input_file(path) as source:
                    for docs, sizes, matrix in ShardReader(source):
                        ids, ends = matrix.decode().astype("<u4"), np.cumsum(sizes, dtype=np.int64)
                        crc = [zlib.crc32(ids[e - s : e]) for s, e in zip(sizes.astype(np.int64), ends, strict=True)]
                        columns = [pa.array(docs, pa.int64()), pa.array(start + ends - sizes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(crc, pa.int64())]
                        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])
                        start += matrix.n

    return placed.repartition(n).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def wavelet_shards(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Writes the shards and gives doc_id, start, n_tokens, ids_crc32 as read back from them."""
    scratch = Scratch(spark, "wavelet")
    folder = scratch.path("shards")
    files = scratch.keep(write_shards(spark, docs, folder, tokenizer or default_path()), "files")
    return read_shards(spark, files, folder)
