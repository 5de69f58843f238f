"""Packing by optimal length buckets.

The histogram of exact lengths over all documents is summed by Spark. It has at most sqrt(2 * tokens) rows, since k
distinct lengths need k * k / 2 tokens: some 7 million narrow rows for 100 TB of text. On the driver, dynamic programming
over it chooses at most ``BUCKETS`` upper bounds that minimise the total padding; the lower envelope of lines makes each
layer linear in the lengths. A caller may ask for bins of a relative width of 1 / ``precision`` for lengths from
2 * ``precision`` on; then total padding exceeds the least by less than that share of those documents' padded lengths. Inside a bucket documents are put in batches
of as many rows as the token budget holds at the bucket's padded length; a document longer than the budget is a batch of
its own. The order inside a bucket is by a hash of doc_id, and places come from prefix sums over counts.

Defined cases: a null text counts as empty; every document has an end token, so lengths are at least 1; rows that repeat
are packed one by one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch, has_columns, ranked
from .tokens import default_path, encoder

#: Buckets at most, and tokens (with padding) that a batch may hold.
BUCKETS, BUDGET = 16, 65_536


def optimal_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> tuple[list[int], int]:
    """The upper bounds of at most ``buckets`` buckets with least padding, and that padding.

    ``lengths`` are distinct and ascending (the longest of each bin). With C the running counts and S the running
    tokens, a bucket over bins (i, j] pads lengths[j] * (C[j] - C[i]) - (S[j] - S[i]). For each j the best i lies on the
    lower envelope of the lines y = -C[i] * x + best[i] + S[i], met in order as lengths grow.
    """
    n = len(lengths)
    if not n:
        return [], 0
    c = [0, *np.cumsum(counts).tolist()]
    s = [0, *np.cumsum(lengths * counts).tolist()]
    lengths = lengths.tolist()
    best: list[float] = [0] + [float("inf")] * n
    back: list[np.ndarray] = []
    padding: list[float] = []
    for _ in range(min(buckets, n)):
        new, choice = [float("inf")] * (n + 1), np.zeros(n + 1, np.int32)
        hull: list[tuple[int, int, int]] = []  # slope, height, i
        at = 0
        for j in range(1, n + 1):
            i = j - 1
            if best[i] < float("inf"):
                line = (-c[i], best[i] + s[i], i)
                while len(hull) > at + 1 and (hull[-1][1] - hull[-2][1]) * (hull[-1][0] - line[0]) >= (line[1] - hull[-1][1]) * (hull[-2][0] - hull[-1][0]):
                    hull.pop()
                hull.append(line)
            x = lengths[j - 1]
            while at + 1 < len(hull) and hull[at + 1][0] * x + hull[at + 1][1] <= hull[at][0] * x + hull[at][1]:
                at += 1
            if at < len(hull):
                slope, height, i = hull[at]
                new[j], choice[j] = slope * x + height + c[j] * x - s[j], i
        back.append(choice)
        padding.append(new[n])
        best = new
    k = min(range(len(back)), key=lambda i: (padding[i], i))
    least, bounds, j = padding[k], [], n
    while j:
        bounds.append(lengths[j - 1])
        j, k = int(back[k][j]), k - 1
    return bounds[::-1], int(least)


def token_lengths(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and n_tokens, the end token included."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(tokenizer)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tokens.count_arrow(batch.column(1)) + 1, pa.int64())], ["doc_id", "n_tokens"])

    return has_columns(docs, doc_id="long", text="string").mapInArrow(count, "doc_id long, n_tokens long")


def length_histogram(sizes: DataFrame, precision: int | None = None) -> DataFrame:
    """longest, n: the count of every length; or of bins, at most about 45 * precision of them."""
    n = F.col("n_tokens")
    if precision is None:
        return sizes.groupBy(n.alias("longest")).agg(F.count(F.lit(1)).alias("n"))
    # drop as many low bits as leave a number below 2 * precision
    drop = F.greatest(F.length(F.bin(n)) - F.lit(precision.bit_length()), F.lit(0))
    step = F.call_function("shiftleft", F.lit(1).cast("long"), drop.cast("int"))
    return sizes.groupBy((n - F.pmod(n, step)).alias("bin")).agg(F.max("n_tokens").alias("longest"), F.count(F.lit(1)).alias("n")).drop("bin")


def packed(scratch: Scratch, sizes: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET, precision: int | None = None) -> DataFrame:
    """``sizes`` is a written table with doc_id and n_tokens."""
    bins = length_histogram(sizes, precision).toPandas().sort_values("longest")
    bounds, _ = optimal_bounds(bins["longest"].to_numpy(np.int64), bins["n"].to_numpy(np.int64), buckets)
    bounds = bounds or [1]
    limits = F.array(*(F.lit(b).cast("long") for b in bounds))
    filed = sizes.withColumn("bucket", F.size(F.filter(limits, lambda b: b < F.col("n_tokens"))).cast("int"))
    placed, _ = ranked(scratch, filed, "bucket", len(bounds), F.xxhash64("doc_id", "n_tokens"), ["doc_id", "n_tokens"], fans=256)
    placed = placed.withColumn("padded_to", F.element_at(limits, F.col("bucket") + 1))
    placed = placed.withColumn("rows_in_batch", F.greatest(F.floor(F.lit(budget) / F.col("padded_to")), F.lit(1)).cast("long"))
    return placed.select(
        "doc_id", "n_tokens", "bucket", "padded_to", (F.col("padded_to") - F.col("n_tokens")).alias("padding"), F.expr("rank_in div rows_in_batch").alias("batch"), F.expr("rank_in % rows_in_batch").alias("place")
    )


def pack(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None, buckets: int = BUCKETS, budget: int = BUDGET, precision: int | None = None) -> DataFrame:
    """doc_id, n_tokens, bucket, padded_to, padding, batch (within the bucket), place (within the batch) for every row."""
    scratch = Scratch(spark, "packing")
    sizes = scratch.keep(token_lengths(docs, tokenizer or default_path()), "sizes")
    return packed(scratch, sizes, buckets, budget, precision)
