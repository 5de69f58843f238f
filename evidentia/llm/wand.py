"""Ranked lexical search by WAND over an inverted index for each shard of documents.

A shard is a run of a task's documents, closed at ``SHARD_DOCS`` of them or ``SHARD_POSTINGS`` postings, and one row of the
index: doc_ids in ascending order, their lengths, the terms, and for each term the places of its documents and how often
they hold it. Counts over all documents (how many have terms, how many terms they have, how many hold a term) are sums over
shards. Queries come in blocks of ``BLOCK_ITEMS``; a task answers a block over all its shards with one heap for each query.

A search in a shard keeps a cursor for each term of the query and the term's greatest impact in the shard. Cursors are
kept in the order of their documents; the pivot is the first document at which the summed greatest impacts reach the
threshold. Cursors before it skip to it; if they are all there, it is scored. The threshold is the k-th best score so far,
and from the start the greatest k-th best impact of a single term, since k documents are known to reach that. A document
below it can't be among the k best of all, so none that may be is skipped. Heaps are merged by rank.

Defined cases: a null text has no terms; documents and items without terms count for nothing and match nothing; equal
scores go by ascending doc_id, null doc_ids last; a document that repeats is ranked each time; each row of the items is
an item of its own, also with a repeated or null item_id; without documents or items the result is empty; other columns
are ignored.
"""

from __future__ import annotations

import math
from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from heapq import heappush, heapreplace
from itertools import islice
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scratch import Scratch, text_of

BEST = 10

#: A shard ends with so many documents or so many postings.
SHARD_DOCS, SHARD_POSTINGS = 8_192, 2_000_000

#: Queries answered in one pass over the index.
BLOCK_ITEMS = 1_000

#: Bytes of a text whose terms are held at once.
PIECE = 4 << 20

#: Scores by length: a document's m is K - B + (B * n * N) div L, in hundredths.
K, B = 100, 75

INDEX = "n_with long, n_terms long, doc_ids array<long>, sizes array<long>, terms array<string>, counts array<int>, places binary, times binary"

#: Bytes outside terms become blanks and A to Z small; bytes of characters beyond ASCII belong to terms.
_TERM_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms_of(text: bytes) -> Counter[bytes]:
    """How often a text holds each term."""
    out: Counter[bytes] = Counter()
    at = 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and _TERM_BYTES[text[end]] != 32:
            end += 1
        out.update(text[at:end].translate(_TERM_BYTES).split())
        at = end
    return out


def _narrow(times: np.ndarray) -> np.ndarray:
    """Two bytes a posting, or eight in a shard where a document holds a term more often."""
    return times.astype("<u2" if times.max(initial=0) < 1 << 16 else "<i8")


def _postings(places: bytes, times: bytes) -> tuple[np.ndarray, np.ndarray]:
    places = np.frombuffer(places, "<u2")
    return places, np.frombuffer(times, "<u2" if len(times) == places.nbytes else "<i8")


class _Shard:
    """Documents on their way into a row of the index."""

    def __init__(self) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.ids: list[int | None] = []
        self.sizes: list[int] = []
        self.terms, self.times = array("i"), array("q")
        self.ends: list[int] = []

    def add(self, doc_id: int | None, counts: Counter[bytes]) -> None:
        number = self.vocabulary.setdefault
        self.terms.extend([number(t, len(self.vocabulary)) for t in counts])
        self.times.extend(counts.values())
        self.ids.append(doc_id)
        self.sizes.append(counts.total())
        self.ends.append(len(self.terms))

    def full(self) -> bool:
        return len(self.ids) >= SHARD_DOCS or len(self.terms) >= SHARD_POSTINGS

    def row(self) -> pa.RecordBatch:
        order = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is None, self.ids[i] or 0))
        place = np.empty(len(order), np.uint16)
        place[order] = np.arange(len(order))
        term, times = np.frombuffer(self.terms, np.int32), np.frombuffer(self.times, np.int64)
        doc = np.repeat(place, np.diff(self.ends, prepend=0))
        by = np.lexsort((doc, term))
        return pa.RecordBatch.from_arrays([
            pa.array([sum(s > 0 for s in self.sizes)], pa.int64()), pa.array([sum(self.sizes)], pa.int64()),
            pa.array([[self.ids[i] for i in order]], pa.list_(pa.int64())), pa.array([[self.sizes[i] for i in order]], pa.list_(pa.int64())),
            pa.array([[t.decode() for t in self.vocabulary]], pa.list_(pa.string())), pa.array([np.bincount(term, minlength=len(self.vocabulary)).astype(np.int32)], pa.list_(pa.int32())),
            pa.array([doc[by].astype("<u2").tobytes()], pa.binary()), pa.array([_narrow(times)[by].tobytes()], pa.binary()),
        ], ["n_with", "n_terms", "doc_ids", "sizes", "terms", "counts", "places", "times"])


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shard = _Shard()
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()), strict=True):
            shard.add(doc_id, terms_of(text.as_py()))
            if shard.full():
                row, shard = shard.row(), _Shard()
                yield row
                pa.default_memory_pool().release_unused()
    if shard.ids:
        yield shard.row()


def build_index(spark: SparkSession, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The index, a row for each shard, as a written table."""
    texts = docs.select(F.col("`doc_id`").cast("long").alias("doc_id"), text_of("`text`").alias("text"))
    return scratch.keep(texts.mapInArrow(_index, INDEX), "index", wide=True)


def _held(wanted: pa.Array):
    """How many documents of a task's shards hold each of the wanted terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for terms, counts in zip(*batch.columns, strict=True):
                at = pc.index_in(wanted, value_set=terms.values)
                real = at.is_valid().to_numpy(zero_copy_only=False)
                total[real] += counts.values.to_numpy()[at.drop_null().to_numpy()]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "df"])

    return run


def wand(lists: list[tuple[array, array, int, int]], heap: list[tuple], k: int, least: int, names: list) -> int:
    """Puts a shard's documents that may be among the k best into ``heap`` as (score, key of the doc_id); returns how many were scored.

    ``lists`` holds for each term of the query (places of its documents, ascending; their impacts; the greatest impact;
    repeats in the query), ``names`` each document's key, which is greater for those that win a tie.
    """
    threshold = max(least, heap[0][0]) if len(heap) == k else least
    cursors = [[places[0], 0, places, impacts, most * repeats, repeats] for places, impacts, most, repeats in lists]
    first, scored = itemgetter(0), 0
    cursors.sort(key=first)
    while cursors:
        bound, pivot = 0, -1
        for c in cursors:
            bound += c[4]
            if bound >= threshold:
                pivot = c[0]
                break
        if pivot < 0:
            break
        ended = False
        if cursors[0][0] == pivot:
            score = 0
            for c in cursors:
                if c[0] != pivot:
                    break
                at = c[1]
                score += c[3][at] * c[5]
                at += 1
                if at < len(c[2]):
                    c[1], c[0] = at, c[2][at]
                else:
                    c[0], ended = -1, True
            scored += 1
            if score >= threshold:
                if len(heap) < k:
                    heappush(heap, (score, names[pivot]))
                elif (score, names[pivot]) > heap[0]:
                    heapreplace(heap, (score, names[pivot]))
                if len(heap) == k and heap[0][0] > threshold:
                    threshold = heap[0][0]
        else:
            for c in cursors:
                if c[0] >= pivot:
                    break
                at = bisect_left(c[2], pivot, c[1] + 1)
                if at < len(c[2]):
                    c[1], c[0] = at, c[2][at]
                else:
                    c[0], ended = -1, True
        if ended:
            cursors = [c for c in cursors if c[0] >= 0]
        cursors.sort(key=first)
    return scored


def _answers(items: list[tuple[int, list[tuple[int, int]]]], wanted: pa.Array, weights: np.ndarray, n_docs: int, n_terms: int, k: int):
    """Each task's k best of each item, as (item, doc_id, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: list[list[tuple]] = [[] for _ in items]
        for batch in batches:
            for row in range(batch.num_rows):
                ids, sizes, terms, counts, places, times = (batch.column(i)[row] for i in range(6))
                at = pc.index_in(wanted, value_set=terms.values).to_pylist()
                ends = np.cumsum(counts.values.to_numpy())
                m = np.array([K - B + (B * n * n_docs) // n_terms for n in sizes.values.to_pylist()], np.int64)
                places, times = _postings(places.as_py(), times.as_py())
                lists: dict[int, tuple] = {}
                for q, t in enumerate(at):
                    if t is None or not weights[q]:
                        continue
                    lo, hi = int(ends[t - 1]) if t else 0, int(ends[t])
                    doc, tf = places[lo:hi], times[lo:hi].astype(np.int64)
                    impact = weights[q] * (1_000_000_000 * tf // (1_000 * tf + 8 * m[doc]))
                    kth = int(np.partition(impact, len(impact) - k)[len(impact) - k]) if len(impact) >= k else 0
                    lists[q] = (array("H", doc.tobytes()), array("q", impact.tobytes()), int(impact.max()), kth)
                # a key is greater for a smaller doc_id, and least for none
                names = [(0, 0) if i is None else (1, -i) for i in ids.values.to_pylist()]
                for heap, (_, query) in zip(heaps, items, strict=True):
                    found = [(lists[q], r) for q, r in query if q in lists]
                    if found:
                        least = max(1, max(x[3] * r for x, r in found))
                        wand([(x[0], x[1], x[2], r) for x, r in found], heap, k, least, names)
            pa.default_memory_pool().release_unused()  # a shard's row is many MB
        for (item, _), heap in zip(items, heaps, strict=True):
            if heap:
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(heap), pa.int64()), pa.array([-d if real else None for _, (real, d) in heap], pa.int64()), pa.array([s for s, _ in heap], pa.int64())], ["item", "doc_id", "score"])

    return run


def _kept(scratch: Scratch, df: DataFrame, name: str, rows: int = 1) -> DataFrame:
    """``scratch.keep`` of a plan whose rows are whole shards, a few in a batch."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = scratch.spark.conf.get(setting)
    scratch.spark.conf.set(setting, str(rows))
    try:
        return scratch.keep(df, name)
    finally:
        scratch.spark.conf.set(setting, before)


def ranked_search(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = BEST) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents with the highest scores above 0 for each row of ``items``."""
    scratch = Scratch(spark, "wand")
    index = build_index(spark, docs, scratch)
    n_docs, n_terms = index.agg(F.sum("n_with"), F.sum("n_terms")).first()
    asked = scratch.keep(items.select(F.monotonically_increasing_id().alias("item"), F.col("`item_id`").alias("item_id"), text_of("`text`").alias("text")), "items")
    found, rest = None, asked.select("item", "text").toLocalIterator()
    while n_docs and (block := list(islice(rest, BLOCK_ITEMS))):
        counts = [(r["item"], terms_of(r["text"].encode())) for r in block]
        vocabulary = list({t: None for _, c in counts for t in c})
        place = {t: i for i, t in enumerate(vocabulary)}
        wanted = pa.array([t.decode() for t in vocabulary], pa.string())
        held = _kept(scratch, index.select("terms", "counts").mapInArrow(_held(wanted), "term long, df long"), f"held_{block[0]['item']}", 16)
        weights = np.zeros(len(vocabulary), np.int64)
        for r in held.groupBy("term").agg(F.sum("df").alias("df")).collect():
            weights[r["term"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["df"] + 1)))
        queries = [(item, [(place[t], n) for t, n in c.items()]) for item, c in counts]
        answers = index.select("doc_ids", "sizes", "terms", "counts", "places", "times").mapInArrow(_answers(queries, wanted, weights, n_docs, n_terms, k), "item long, doc_id long, score long")
        answers = _kept(scratch, answers, f"found_{block[0]['item']}")
        found = answers if found is None else found.unionByName(answers)
    if found is None:
        found = spark.createDataFrame([], "item long, doc_id long, score long")
    best = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
    top = found.withColumn("rank", best).filter(F.col("rank") <= k)
    return top.join(asked.select("item", "item_id"), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
