"""Compression of vectors into codes: one codebook for each part of a vector, learnt on weighted distinct parts.

Components become integers (floor of ``SCALE`` times the component), and vectors are cut into consecutive parts. Equal
parts at one position become one row with a weight, and Lloyd's rounds run over these rows alone: tasks assign rows to
the nearest entry and pass on one sum for each entry they met, so what is shuffled in a round doesn't grow with the
table, and a part that a third of all vectors share is one row. Codebooks (parts x entries x a few integers) travel with
the tasks. At the end the codes of the distinct parts are joined back to the vectors.

Defined cases: a vector that is null or holds a null or a non-finite component is dropped, and so is one of another length
than the most frequent (the smallest on a tie) or without components; where ``parts`` doesn't divide the length, the first
parts are one longer, and of a vector shorter than ``parts`` the last parts are empty, code 0 at error 0; scaled components
beyond 2^26 count as 2^26, so that squared distances fit 64 bits; fewer rows than ``entries`` give a codebook of as many
entries; first entries of equal vec_ids go by the vector, those of null vec_ids come last; a repeated row is coded each
time; an empty table gives an empty result; columns other than vec_id, embedding and label are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch, sized

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256

#: The greatest scaled component.
MOST = 1 << 26

#: Distances computed at a time.
TOGETHER = 1 << 20


def bounds(length: int, parts: int) -> list[int]:
    """Where parts begin, and the end."""
    size, longer = divmod(length, parts)
    return [i * size + min(i, longer) for i in range(parts + 1)]


def scaled(vectors: DataFrame) -> DataFrame:
    """vec_id, label and v, the whole-number vector, of the rows that take part; with a row number ``rid``."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    whole = lambda x: F.floor(F.greatest(F.least(x * SCALE, F.lit(float(MOST))), F.lit(-float(MOST)))).cast("long")
    rows = vectors.select(F.col("`vec_id`").cast("long").alias("vec_id"), F.col("`label`").alias("label"), F.col("`embedding`").cast("array<double>").alias("v"))
    rows = rows.filter(F.col("v").isNotNull() & (F.size("v") > 0)).filter(F.forall("v", number))
    return rows.select(F.monotonically_increasing_id().alias("rid"), "vec_id", "label", F.transform("v", whole).alias("v"))


def nearest_entry(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the entry nearest to each part, the lower index on a tie; whole numbers throughout."""
    code, error = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
    step = max(1, TOGETHER // max(1, book.size))
    for i in range(0, len(parts), step):
        far = ((parts[i : i + step, None, :] - book[None]) ** 2).sum(axis=2)
        code[i : i + step] = far.argmin(axis=1)
        error[i : i + step] = far.min(axis=1)
    return code, error


def _by_place(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(position, rows of the batch, their parts) for each position in a batch of (at, part, ...)."""
    at, lists = batch.column(0).to_numpy(), batch.column(1)
    flat, ends = lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
    sizes = np.diff(ends, prepend=0)
    for i in np.unique(at):
        rows = np.flatnonzero(at == i)
        size = int(sizes[rows[0]])
        yield int(i), rows, flat[(ends[rows] - size)[:, None] + np.arange(size)]


def _sums(books: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = [np.zeros(len(b), np.int64) for b in books], [np.zeros(b.shape, np.int64) for b in books]
        for batch in batches:
            weight = batch.column(2).to_numpy()
            for at, rows, parts in _by_place(batch):
                code, _ = nearest_entry(parts, books[at])
                np.add.at(count[at], code, weight[rows])
                np.add.at(total[at], code, parts * weight[rows][:, None])
        for at, book in enumerate(books):
            used = np.flatnonzero(count[at])
            if len(used) and book.shape[1]:
                n = book.shape[1]
                place = np.tile(np.arange(n, dtype=np.int32), len(used))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used) * n, at, np.int32)), pa.array(np.repeat(used, n).astype(np.int32)), pa.array(place), pa.array(np.repeat(count[at][used], n)), pa.array(total[at][used].reshape(-1))], ["at", "entry", "place", "n", "total"])

    return run


def _codes(books: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, error = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for at, rows, parts in _by_place(batch):
                code[rows], error[rows] = nearest_entry(parts, books[at])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code.astype(np.int32)), pa.array(error)], ["at", "part", "code", "error"])

    return run


class PartCodes:
    """A run over one table: ``rows`` (kept and scaled), ``distinct`` (weighted parts), ``books`` (a matrix of entries for each part)."""

    def __init__(self, spark: SparkSession, vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS):
        self.scratch, self.parts = Scratch(spark, "parts"), parts
        kept = self.scratch.keep(scaled(vectors), "scaled")
        sizes = kept.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").first()
        self.length = sizes["size"] if sizes else 0
        self.rows = kept.filter(F.size("v") == self.length)
        self.cuts = bounds(self.length, parts)
        first = [r["v"] for r in self.rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()]
        self.books = [np.array([v[a:b] for v in first], np.int64).reshape(len(first), b - a) for a, b in zip(self.cuts, self.cuts[1:], strict=False)]
        self.distinct = self.scratch.keep(self.cells().groupBy("at", "part").agg(F.count(F.lit(1)).alias("n")), "distinct")
        for _ in range(rounds if first else 0):
            self._round()

    def cells(self, *more: str) -> DataFrame:
        """(at, part): every part of every row, with columns ``more`` of the row."""
        cut = F.array(*(F.slice("v", a + 1, b - a) for a, b in zip(self.cuts, self.cuts[1:], strict=False)))
        return self.rows.select(*more, F.posexplode(cut).alias("at", "part"))

    def _round(self) -> None:
        """Each entry that is nearest to some part moves to the floor of their mean."""
        sums = self.distinct.mapInArrow(_sums(self.books), "at int, entry int, place int, n long, total long")
        # at most one row for each component of each entry reaches the driver
        for r in sums.groupBy("at", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
            self.books[r["at"]][r["entry"], r["place"]] = r["total"] // r["n"]

    def digest(self) -> str:
        """SHA-256 of all entries' components in decimal, by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(str(x) for b in self.books for x in b.reshape(-1).tolist()).encode()).hexdigest()

    def codes(self) -> DataFrame:
        """rid, vec_id, label, code, error for every kept row."""
        coded = self.scratch.keep(self.distinct.select("at", "part").mapInArrow(_codes(self.books), "at int, part array<long>, code int, error long"), "coded")
        each = self.cells("rid", "vec_id", "label").join(sized(coded, coded.count()), ["at", "part"])
        digits: list[Column] = [F.max(F.when(F.col("at") == i, F.col("code"))).alias(f"code{i}") for i in range(self.parts)]
        whole = each.groupBy("rid", "vec_id", "label").agg(*digits, F.sum("error").alias("error"))
        code = F.concat(*(F.lower(F.lpad(F.hex(f"code{i}"), 2, "0")) for i in range(self.parts)))
        return self.scratch.keep(whole.select("rid", "vec_id", "label", code.alias("code"), "error"), "codes")


def vector_codes(spark: SparkSession, vectors: DataFrame, **how: int) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 for every kept row."""
    run = PartCodes(spark, vectors, **how)
    codes = run.codes()
    labels = run.scratch.keep(codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "labels")
    out = codes.join(sized(labels, labels.count()), F.col("label").eqNullSafe(F.col("of")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(run.digest()).alias("codebooks_sha256"))
