"""SimHash near-duplicates whose fingerprints meet through keys of the binary Golay code.

A fingerprint of 64 bits is cut into three segments, each a word of the perfect Golay code of length 23 (the rest of the
word is zeros). Every word of 23 bits is within three bits of exactly one codeword, whose index has 12 bits. A segment
and its neighbours at one bit decode to a few indices (one, or six if the word lies three bits off), so of two segments
at one bit or less, the index of each is among the keys of the other.

Two fingerprints that differ in at most two bits have a segment that is equal, and another with at most one error: of
three segments with two errors in all, the two with the fewest errors have none and at most one. So for each ordered
pair of segments a fingerprint has one key of its own (the first segment as it is, the second's index) and asks under
several (the first segment, each near index); every link is found by an asked key that is somebody's own.

Where a key is owned by few fingerprints, askers and owners are joined and their bits compared. Where it is owned by
more than ``CROWD``, pairs aren't formed: whoever asks there sends itself and its 64 neighbours at one bit, and
fingerprints that share one of these are within two bits of each other. At most 65 share one, so nothing grows faster
than the number of distinct fingerprints, and no link is lost. Equal fingerprints count once throughout.

Defined cases: a null text is empty; no words give fingerprint 0, which is linked like any other; fewer words than a
shingle has give one shingle of all of them; texts are read whole, in pieces of bounded size; a repeated doc_id is a row
each time; a null doc_id is never the smallest, and a component of only such has component_id null; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations, permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bagminhash import components
from .scratch import Scratch, sized, text_of

#: Words in a shingle, the hash's seed, and the bits in which linked fingerprints may differ. The keys below hold for two bits.
WIDTH, SEED, BITS = 3, 42, 2

#: Bits of each segment, from the lowest.
SEGMENTS = (22, 21, 21)

#: Owners of a key up to which they are joined with its askers.
CROWD = 8

#: Bytes of a text whose words are held at once.
PIECE = 4 << 20

#: Fixed value: a generator polynomial of the binary Golay code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
LENGTH, CHECKS = 23, 11

_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def _remainder(word: int) -> int:
    for i in range(LENGTH - 1, CHECKS - 1, -1):
        if word >> i & 1:
            word ^= GENERATOR << (i - CHECKS)
    return word


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """The remainder of each word without its lowest bits, and the error of up to three bits that each remainder stands for."""
    high = np.array([_remainder(i << CHECKS) for i in range(1 << (LENGTH - CHECKS))], np.int64)
    error = np.zeros(1 << CHECKS, np.int64)
    for n in range(1, 4):
        for places in combinations(range(LENGTH), n):
            pattern = sum(1 << i for i in places)
            error[_remainder(pattern)] = pattern
    return high, error


_HIGH, _ERROR = _tables()


def codeword_index(words: np.ndarray) -> np.ndarray:
    """The index (12 bits) of the codeword nearest to each word of 23 bits."""
    return (words ^ _ERROR[words & ((1 << CHECKS) - 1) ^ _HIGH[words >> CHECKS]]) >> CHECKS


def fingerprint(text: bytes) -> int:
    """The SimHash of a text: each bit that is set in over half of its shingles' hashes."""
    counts, n, last, at = np.zeros(2048, np.int64), 0, [], 0
    digest = xxhash.xxh64_intdigest
    while at < len(text):
        # a piece ends before white space, so no word is cut
        end = _BLANK.search(text, at + PIECE) if at + PIECE < len(text) else None
        end = end.start() if end else len(text)
        words = last + text[at:end].lower().split()
        at = end
        if len(words) >= WIDTH:
            joined = memoryview(b" ".join(words))
            sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
            ends = np.cumsum(sizes)
            starts, ends = (ends - sizes)[: 1 - WIDTH], ends[WIDTH - 1 :] - 1
            h = np.fromiter([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], "<u8", len(starts))
            counts += np.bincount((h.view(np.uint8).reshape(-1, 8) + np.arange(8) * 256).reshape(-1), minlength=2048)
            n += len(h)
            words = words[1 - WIDTH :]
        last = words
    if not n:
        if not last:
            return 0
        return digest(b" ".join(last), SEED)
    over = 2 * (counts.reshape(8, 256) @ _BYTE_BITS).reshape(-1) > n
    return int(np.packbits(over, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.large_binary())
        found = np.fromiter((fingerprint(t.as_py()) for t in texts), np.uint64, len(texts))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])


def keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, place in ``fps``, whether it is the fingerprint's own) of every key under which fingerprints ask."""
    shifts = np.cumsum((0, *SEGMENTS))
    segments = [(fps >> np.uint64(s) & np.uint64((1 << n) - 1)).astype(np.int64) for s, n in zip(shifts, SEGMENTS, strict=False)]
    near = []
    for words, n in zip(segments, SEGMENTS, strict=True):
        around = np.sort(codeword_index(words[:, None] ^ (1 << np.arange(n))), axis=1)
        own = codeword_index(words)[:, None]
        new = (around != own) & (np.diff(around, axis=1, prepend=-1) != 0)
        near.append((np.hstack((own, around)), np.hstack((np.ones_like(own, bool), new))))
    key, place, is_own = [], [], []
    for turn, (i, j) in enumerate(permutations(range(len(SEGMENTS)), 2)):
        index, real = near[j]
        who, column = np.nonzero(real)
        key.append(turn << 40 | segments[i][who] << 12 | index[who, column])
        place.append(who)
        is_own.append(column == 0)
    return np.concatenate(key), np.concatenate(place), np.concatenate(is_own)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy()
        key, place, is_own = keys(fps.view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fps[place]), pa.array(is_own)], ["key", "fp", "own"])


def _around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    flips = np.concatenate((np.zeros(1, np.uint64), np.uint64(1) << np.arange(64, dtype=np.uint64)))
    for batch in batches:
        fps = batch.column(0).to_numpy().view(np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array((fps[:, None] ^ flips).reshape(-1).view(np.int64)), pa.array(np.repeat(fps, len(flips)).view(np.int64))], ["middle", "fp"])


def links(scratch: Scratch, fps: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(a, b): pairs of the distinct fingerprints ``fps`` (column fp) at up to two bits whose components are those of all such pairs."""
    asked = scratch.keep(fps.mapInArrow(_keys, "key long, fp long, own boolean"), "keys")
    owned = asked.filter("own").groupBy("key").agg(F.count(F.lit(1)).alias("owners"))
    crowded = scratch.keep(owned.filter(F.col("owners") > crowd).select("key"), "crowded")
    n = crowded.count()
    # few owners: each asker against each of them
    owners = asked.filter("own").select("key", F.col("fp").alias("b")).join(sized(crowded, n), "key", "left_anti")
    pairs = asked.select("key", F.col("fp").alias("a")).join(owners, "key").filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= BITS))
    found = scratch.keep(pairs.select("a", "b").distinct(), "pairs")
    # many owners: who shares a neighbour at one bit is linked to the smallest that does
    many = asked.join(sized(crowded, n), "key", "left_semi").select("fp").distinct()
    shared = many.mapInArrow(_around, "middle long, fp long").withColumn("b", F.min("fp").over(Window.partitionBy("middle")))
    star = scratch.keep(shared.filter("fp <> b").select(F.col("fp").alias("a"), "b").distinct(), "stars")
    return found.unionByName(star)


def near_fingerprints(spark: SparkSession, docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id (the smallest doc_id reachable over links) for every row."""
    scratch = Scratch(spark, "golay")
    texts = docs.select(F.col("`doc_id`").cast("long").alias("doc_id"), text_of("`text`").alias("text"))
    rows = scratch.keep(texts.mapInArrow(_fingerprints, "doc_id long, fp long"), "rows")
    fps = scratch.keep(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fps")
    labels = components(scratch, links(scratch, fps.select("fp"), crowd), "linked")
    placed = fps.join(sized(labels, labels.count()), F.col("fp") == F.col("v"), "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    placed = scratch.keep(placed, "placed")
    heads = scratch.keep(placed.groupBy("label").agg(F.min("least").alias("component_id")), "heads")
    ids = scratch.keep(placed.join(sized(heads, heads.count()), "label").select("fp", "component_id"), "ids")
    out = rows.join(sized(ids, ids.count()), "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
