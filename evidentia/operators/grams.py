"""Which labels stand in some text: an index of character grams, each label under its rarest, with an exact check after.

Texts aren't written out gram by gram. Of every ``WINDOW`` neighbouring grams of ``GRAM`` characters the one with the least
hash is a key; a window that lies inside a label is the same window in every text that holds the label, so the label's
keys are among the text's. Labels too short for one window meet texts by all grams of a length that fits them: these
levels are built only if there are such labels. Of its keys a label takes the one that the fewest texts have.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Tables, sized

#: (least length of a label, characters of a gram, neighbouring grams of which one is a key), longest first.
LEVELS = ((15, 8, 8), (4, 4, 1), (3, 3, 1), (2, 2, 1), (1, 1, 1))

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

#: Characters of a text that are hashed at a time.
PIECE = 1 << 20


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def keys_of(text: str, level: int) -> np.ndarray:
    """The distinct keys of a text on a level."""
    _, gram, window = LEVELS[level]
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    out = []
    for start in range(0, max(1, len(codes) - gram - window + 2), PIECE):
        part = codes[start : start + PIECE + gram + window - 2].astype(np.uint64)
        n = len(part) - gram + 1
        if n < window:
            continue
        h = np.full(n, np.uint64(level + 1))
        for i in range(gram):
            h = h * _MULTIPLIER + part[i : i + n]
        h = _mixed(h)
        if window > 1:
            h = np.lib.stride_tricks.sliding_window_view(h, window).min(axis=1)
        out.append(np.unique(h))
    return np.unique(np.concatenate(out)).view(np.int64) if out else np.empty(0, np.int64)


def level_of(length: int) -> int | None:
    return next((i for i, (least, *_) in enumerate(LEVELS) if length >= least), None)


def _keys(levels: list[int] | None):
    """(id, key) of each text: on all of ``levels``, or on the one level that fits its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ident, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                here = levels if levels is not None else [x for x in [level_of(len(text))] if x is not None]
                for level in here:
                    keys = keys_of(text, level)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), ident)), pa.array(keys)], ["id", "key"])

    return run


def contained_labels(quotes: DataFrame, labels: DataFrame, quote: str, label: str) -> DataFrame:
    """Distinct rows of ``labels`` whose label stands in some quote, anywhere, case and all; any number of either.

    Null quotes and labels take no part; an empty label stands in every quote.
    """
    tables = Tables(labels.sparkSession, "grams")
    # a quote goes by its hash; where two collide, both are checked in full
    said = quotes.select(F.col(f"`{quote}`").cast("string").alias("_quote")).filter("_quote IS NOT NULL").withColumn("_q", F.xxhash64("_quote"))
    named = tables.keep(labels.distinct().filter(F.col(label).isNotNull()).withColumn("_l", F.monotonically_increasing_id()), "labels")
    long = F.length(label)
    kind = sum((F.when(long >= least, 1).otherwise(0) for least, *_ in LEVELS), F.lit(0))
    levels = sorted(len(LEVELS) - r["kind"] for r in named.select(kind.alias("kind")).distinct().collect() if r["kind"])
    asked = tables.keep(named.select("_l", label).mapInArrow(_keys(None), "id long, key long"), "asked")
    wanted = tables.keep(asked.select("key").distinct(), "wanted")
    given = said.select("_q", "_quote").mapInArrow(_keys(levels), "id long, key long").join(sized(wanted, wanted.count()), "key")
    given = tables.keep(given, "given")
    spread = given.groupBy("key").agg(F.count(F.lit(1)).alias("df"))
    # a key that no text has rules its label out
    rarest = asked.join(spread, "key", "left").groupBy(F.col("id").alias("_l")).agg(F.min_by("key", F.struct(F.coalesce("df", F.lit(0)), "key")).alias("key"))
    met = tables.keep(given.select(F.col("id").alias("_q"), "key").join(rarest, "key").select("_q", "_l").distinct(), "met")
    texts = named.select("_l", F.col(label).alias("_label"))
    found = met.join(texts, "_l").join(said, "_q").filter(F.col("_quote").contains(F.col("_label"))).select("_l")
    if said.limit(1).count():
        found = found.unionByName(named.filter(long == 0).select("_l"))
    found = tables.keep(found.distinct(), "found")
    return named.join(sized(found, found.count()), "_l", "left_semi").drop("_l")
