"""Near-duplicate detection by BagMinHash signatures, bands and exact verification.

A document is the multiset of its five-word shingles. Its signature takes, for each of ``BANDS * ROWS`` components, the
earliest point of Poisson processes over the shingles' weights. Weights are whole numbers; each shingle's weight axis is
cut into the blocks [0, 1), [1, 2), [2, 4), [4, 8), ... and each block is halved recursively. A process on an interval
gives one point and hands it to one half, and both halves go on from there, so intervals within a document's weight
give points without being split to the bottom, and documents with different weights agree on every interval that both
cover. The share of equal components estimates sum(min) / sum(max) of the weights without bias.

Documents with equal multisets are one class from the start, so copies never meet in pairs. Classes that share a band
meet in rounds, each of which leaves out what the rounds before have joined or compared: a class is first compared with
the smallest class of its largest bucket alone. What stays apart from a bucket's main component then meets, in a small
bucket, every member outside its own component, and in a large one a few hubs of the main component, which are the same
in all buckets; what is still apart there is joined, on the rare shingles that any link must share, with all members of
such buckets, a small part of the pairs first and only of what hasn't come together meanwhile. So every two classes that share a band are in one component, or have been compared in full, or are ruled
out by an exact bound, and a large group never meets in pairs. Components grow by minimum labels with pointer jumping
over DataFrames.

Defined cases: null text counts as empty; all documents without words are one class; a text of fewer than five words is
one shingle; of rows that repeat one is kept; null doc_ids come last in their class; an empty table gives an empty
result; other columns are ignored (and carried along by :func:`near_classes`).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scratch import Scratch, schema, sized, text_of
from .shingles import WIDTH, WordHashes, mix, multiset, overlap

#: 24 bands of 4 components find a pair of similarity 0.8 with probability 1 - 3e-6.
BANDS, ROWS = 24, 4

#: Least weighted Jaccard similarity of a link.
SIMILARITY = 0.8

#: In buckets of at most so many classes all pairs that are still in question are compared; in larger ones, those apart
#: are compared with so many hubs, and what is left is joined on rare shingles.
SMALL_BUCKET, HUBS = 16, 4

#: Pairs for each class, about, that are compared first of those that share a rare token; how many times more each turn.
ASKED, FEWER = 2, 4

#: Shingles whose processes run together in numpy.
BLOCK = 100_000

_STEP = np.uint64(0xD1B54A32D192ED03)


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, owners: int, m: int) -> np.ndarray:
    """The (owners, m) signature matrix of weighted sets given by rows (owner, element, whole weight); no rows, infinity."""
    out = np.full((owners, m), np.inf)
    total = np.bincount(owner, weights=weight, minlength=owners)
    todo, slack = np.flatnonzero(total > 0), 3.0
    while len(todo):
        until = np.zeros(owners)
        until[todo] = m * (math.log(m) + slack) / total[todo]
        rows = until[owner] > 0
        _points(out, until, owner[rows], element[rows], weight[rows], m)
        todo, slack = todo[out[todo].max(axis=1) > until[todo]], slack * 2 + 3
    return out


def _points(out: np.ndarray, until: np.ndarray, owner: np.ndarray, element: np.ndarray, weight: np.ndarray, m: int) -> None:
    """Lowers ``out`` to the earliest points not after ``until``."""
    flat = out.reshape(-1)
    parts = [(owner, mix(element + _STEP), np.zeros(len(owner), np.int64), np.ones(len(owner), np.int64), weight)]
    low = 1
    while len(weight) and (more := weight > low).any():
        owner, element, weight = owner[more], element[more], weight[more]
        parts.append((owner, mix(element + np.uint64(int(_STEP) * (low + 1) & (2**64 - 1))), np.full(len(owner), low, np.int64), np.full(len(owner), 2 * low, np.int64), weight))
        low *= 2
    owner, seed, lo, hi, top = (np.concatenate(x) for x in zip(*parts, strict=True))
    at, component = np.zeros(len(owner)), np.zeros(len(owner), np.int64)
    fresh, told = np.ones(len(owner), bool), np.zeros(len(owner), bool)
    while len(owner):
        # a point for each interval that has not been handed one
        seed = np.where(fresh, mix(seed + _STEP), seed)
        at = np.where(fresh, at - np.log(_uniform(seed)) / (hi - lo), at)
        component = np.where(fresh, (mix(seed ^ _STEP) % np.uint64(m)).astype(np.int64), component)
        told &= ~fresh
        near = at <= until[owner]
        owner, seed, lo, hi, top, at, component, told = (x[near] for x in (owner, seed, lo, hi, top, at, component, told))
        new = (hi <= top) & ~told
        np.minimum.at(flat, owner[new] * m + component[new], at[new])
        told |= new
        # unit intervals go on; longer ones are halved, and one half takes the point
        wide = hi - lo > 1
        if not wide.any():
            fresh = np.ones(len(owner), bool)
            continue
        mid, left = (lo + hi) // 2, (mix(seed + np.uint64(1)) & np.uint64(1)).astype(bool)
        unit = ~wide
        halves = [(owner[unit], seed[unit], lo[unit], hi[unit], top[unit], at[unit], component[unit], told[unit], np.ones(unit.sum(), bool))]
        for side in (0, 1):
            use = wide & ((mid if side else lo) < top)
            takes = (left if side == 0 else ~left)[use]
            halves.append((owner[use], mix(seed[use] + np.uint64(2 + side)), (mid if side else lo)[use], (hi if side else mid)[use], top[use], at[use], component[use], told[use] & takes, ~takes))
        owner, seed, lo, hi, top, at, component, told, fresh = (np.concatenate(x) for x in zip(*halves, strict=True))


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key for each band; equal keys, equal components."""
    bits = signature.view(np.uint64).reshape(len(signature), bands, rows)
    out = np.arange(1, bands + 1, dtype=np.uint64) * _STEP + np.zeros((len(signature), 1), np.uint64)
    for i in range(rows):
        out = mix(out ^ bits[:, :, i]) + _STEP
    return out.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch], bands: int, rows: int, width: int) -> Iterator[pa.RecordBatch]:
    known = WordHashes()

    def out(rids: list, sets: list) -> pa.RecordBatch:
        sizes = [len(h) for h, _ in sets]
        owner = np.repeat(np.arange(len(sets)), sizes)
        element = np.concatenate([h for h, _ in sets]) if sets else np.empty(0, np.uint64)
        weight = np.concatenate([c for _, c in sets]) if sets else np.empty(0, np.int64)
        keys = band_keys(signatures(owner, element, weight, len(sets), bands * rows), bands, rows)
        flat = pa.array(keys.reshape(-1), pa.int64())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * bands, pa.int32()), flat)
        same = [hashlib.blake2b(h.tobytes() + c.astype("<i8").tobytes(), digest_size=16).digest() for h, c in sets]
        n = [int(c.sum()) for _, c in sets]
        return pa.RecordBatch.from_arrays([pa.array(rids, pa.int64()), pa.array(same, pa.binary()), pa.array(n, pa.int64()), lists], ["rid", "same", "n", "bands"])

    for batch in batches:
        rids, sets, load = [], [], 0
        for rid, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            sets.append(multiset(text.as_py() or "", known, width))
            rids.append(rid)
            load += len(sets[-1][0])
            if load >= BLOCK:
                yield out(rids, sets)
                rids, sets, load = [], [], 0
        if rids:
            yield out(rids, sets)


def _verify(batches: Iterator[pa.RecordBatch], similarity: float, width: int) -> Iterator[pa.RecordBatch]:
    known = WordHashes()
    last: tuple = (None, None)
    for batch in batches:
        a, b, good = [], [], []
        for x, y, one, two in zip(*(batch.column(i) for i in range(4)), strict=True):
            y = y.as_py()
            if last[0] != y:
                last = (y, multiset(two.as_py(), known, width))
            good.append(overlap(multiset(one.as_py(), known, width), last[1]) >= similarity - 1e-12)
            a.append(x.as_py())
            b.append(y)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(good, pa.bool_())], ["a", "b", "good"])


def components(scratch: Scratch, links: DataFrame, name: str) -> DataFrame:
    """(v, label): for every end of a link, the smallest vertex of its connected component."""
    both = scratch.keep(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}_both")
    labels = scratch.keep(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("label")), f"{name}_0")
    n, turn = labels.count(), 0
    while n:
        turn += 1
        near = both.join(sized(labels, n), F.col("b") == F.col("v")).groupBy("a").agg(F.min("label").alias("around"))
        near = labels.join(near, F.col("v") == F.col("a")).select("v", F.col("label").alias("old"), F.least("label", "around").alias("label"))
        near = scratch.keep(near, f"{name}_near_{turn}")
        jump = near.select(F.col("v").alias("via"), F.col("label").alias("far"))
        step = near.join(sized(jump, n), F.col("label") == F.col("via"), "left").select("v", "old", F.least("label", F.coalesce("far", "label")).alias("label"))
        step = scratch.keep(step, f"{name}_{turn}")
        moved = step.filter("label <> old").limit(1).count()
        labels = step.select("v", "label")
        if not moved:
            break
    return labels


def grown(scratch: Scratch, labels: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """Labels after more links: the components of the components that the links join, so that settled links aren't walked again."""
    n, ends = labels.count(), links.select("a", "b")
    for side in ("a", "b"):
        to = labels.select(F.col("v").alias(f"_{side}"), F.col("label").alias(f"of_{side}"))
        ends = ends.join(sized(to, n), F.col(side) == F.col(f"_{side}"), "left").withColumn(side, F.coalesce(f"of_{side}", side)).drop(f"_{side}", f"of_{side}")
    joined = components(scratch, ends.filter("a <> b"), name)
    new = joined.join(labels.select("v"), "v", "left_anti").select("v", F.col("v").alias("label"))
    moved, n_moved = joined.select(F.col("v").alias("_v"), F.col("label").alias("_to")), joined.count()
    out = labels.unionByName(new).join(sized(moved, n_moved), F.col("label") == F.col("_v"), "left")
    return scratch.keep(out.select("v", F.coalesce("_to", "label").alias("label")), f"{name}_grown")


def _tokens(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """same, n and one row for each member of the multiset: repeats of a shingle are told apart by their number."""
    known = WordHashes()
    for batch in batches:
        for same, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            h, c = multiset(text.as_py(), known, width)
            n = int(c.sum())
            turn = np.arange(n) - np.repeat(np.cumsum(c) - c, c)
            token = mix(np.repeat(h, c) + turn.astype(np.uint64) * _STEP).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([same] * n, pa.binary()), pa.array([n] * n, pa.int64()), pa.array(token)], ["same", "n", "token"])


def _rare_tokens(scratch: Scratch, groups: DataFrame, n_groups: int, bodies: DataFrame, similarity: float, width: int) -> tuple[DataFrame, int]:
    """(tokens, parts): (token, same, n, at, is_apart), each class's tokens, rarest first, that may be the first which a link
    shares; and into how many parts their pairs are to be cut so that one holds about ASKED for each class, a power of FEWER.

    Classes of n and m tokens with the least similarity s share at least s / (1 + s) * (n + m) tokens, so their first
    common token must leave that many in both orders. This is exact: no linked pair is left out.
    """
    tokens = bodies.join(sized(groups, n_groups), "same").select("same", "text").mapInArrow(lambda it: _tokens(it, width), "same binary, n long, token long")
    tokens = scratch.keep(tokens, "tokens")
    common = scratch.keep(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "common")
    ranked = tokens.join(sized(common, common.count()), "token")
    own = Window.partitionBy("same")
    at = F.col("n") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("df", "token")) - 1
    early = ranked.withColumn("at", at).filter(F.col("n") - F.col("at") >= F.col("n") * (similarity - 1e-9))
    early = scratch.keep(early.join(sized(groups, n_groups), "same").select("token", "same", "n", "at", "is_apart"), "early")
    rows, met = early.groupBy("token").agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n"), F.sum(F.col("n").cast("double") * F.col("n"))).first()
    parts, most = 1, (met or 0) / max(rows or 0, 1) / ASKED
    while parts < most:
        parts *= FEWER
    return early, parts


def _share(tokens: DataFrame, similarity: float, parts: int) -> DataFrame:
    """(same, n, x, n_x): pairs of an apart class and one of another label that share a token early enough for a link; of
    ``parts`` parts of all pairs one, so that a token of many classes is dealt out and doesn't meet itself in full."""
    if parts == 1:
        mixed = tokens.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("token")
        tokens = tokens.join(mixed, "token", "left_semi")
    tokens = tokens.withColumn("part", F.pmod(F.xxhash64("same"), F.lit(parts)))
    x = tokens.filter("is_apart").select("token", F.pmod(F.lit(parts) - F.col("part"), F.lit(parts)).alias("part"), *(F.col(c).alias(f"{c}_x") for c in ("same", "n", "at", "label")))
    least = (F.col("n") + F.col("n_x")) * (similarity / (1 + similarity) - 1e-9)
    # of two classes that are both apart, one asks the other
    asks = (F.col("label") != F.col("label_x")) & (~F.col("is_apart") | (F.col("same") < F.col("same_x")))
    met = tokens.join(x, ["token", "part"]).filter(asks & (F.least(F.col("n") - F.col("at"), F.col("n_x") - F.col("at_x")) >= least))
    return met.select("same", "n", F.col("same_x").alias("x"), "n_x").distinct()


def near_classes(scratch: Scratch, docs: DataFrame, bands: int = BANDS, rows: int = ROWS, similarity: float = SIMILARITY, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): ``rows`` is the written input with ``rid`` and ``doc`` (all its columns); ``classes`` has
    (rid, class_id, class_size, kept) for rows in classes of two or more, class_id being the smallest doc_id."""
    everything = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")).withColumn("rid", F.monotonically_increasing_id())
    everything = scratch.keep(everything, "rows")
    texts = everything.select("rid", text_of("doc.text").alias("text"))
    signed = texts.mapInArrow(lambda it: _sign(it, bands, rows, width), "rid long, same binary, n long, bands array<long>")
    signed = scratch.keep(signed, "signed")
    ids = everything.select("rid", F.col("doc.doc_id").cast("long").alias("doc_id"))
    owners = scratch.keep(signed.groupBy("same").agg(F.min("rid").alias("one"), F.max("n").alias("n"), F.count(F.lit(1)).alias("copies")), "owners")

    # buckets of two or more classes, each with its smallest class
    members = scratch.keep(signed.filter("n > 0").select("same", "n", F.explode("bands").alias("bucket")).distinct(), "members")
    shared = members.groupBy("bucket").agg(F.min(F.struct("same", "n")).alias("pivot"), F.count(F.lit(1)).alias("in_bucket")).filter("in_bucket > 1")
    shared = scratch.keep(shared, "shared")
    together = scratch.keep(members.join(sized(shared, shared.count()), "bucket"), "together")
    wanted = scratch.keep(together.select("same").distinct().join(owners, "same").select("same", F.col("one").alias("rid")), "wanted")
    bodies = scratch.keep(texts.join(sized(wanted, wanted.count()), "rid").select("same", "text"), "bodies")

    def compared(pairs: DataFrame, name: str) -> DataFrame:
        left = bodies.select(F.col("same").alias("a"), F.col("text").alias("text_a"))
        right = bodies.select(F.col("same").alias("b"), F.col("text").alias("text_b"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
        return scratch.keep(both.mapInArrow(lambda it: _verify(it, similarity, width), "a binary, b binary, good boolean"), name)

    def comparable(n: str, n_x: str) -> Column:
        """Whether the sizes alone allow the least similarity."""
        return F.least(n, n_x) >= F.greatest(n, n_x) * (similarity - 1e-9)

    # each class with one pivot, that of its largest bucket
    others = together.filter((F.col("same") != F.col("pivot.same")) & comparable("n", "pivot.n"))
    pairs = others.groupBy(F.col("same").alias("a")).agg(F.max(F.struct("in_bucket", "pivot.same"))["same"].alias("b"))
    seen = compared(scratch.keep(pairs, "pivots"), "seen")
    labels = components(scratch, seen.filter("good"), "first")

    # members apart from their bucket's main component: in a small bucket they meet every member outside their own
    # component, in a large one a few hubs of the main component first
    def unsettled(labels: DataFrame, n_labels: int, name: str) -> tuple[DataFrame, DataFrame]:
        """(mixed, apart): members of buckets with several components, and those of them outside the main one."""
        placed = together.join(sized(labels, n_labels), F.col("same") == F.col("v"), "left").select("bucket", "same", "n", "in_bucket", F.coalesce("label", "same").alias("label"))
        placed = scratch.keep(placed, f"placed_{name}")
        sides = placed.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("side"))
        main = sides.groupBy("bucket").agg(F.max_by("label", F.struct("side", "label")).alias("main"), F.count(F.lit(1)).alias("parts")).filter("parts > 1").select("bucket", "main")
        main = scratch.keep(main, f"main_{name}")
        mixed = scratch.keep(placed.join(sized(main, main.count()), "bucket"), f"mixed_{name}")
        return mixed, mixed.filter("label <> main").select("bucket", F.col("same").alias("x"), F.col("n").alias("n_x"), F.col("label").alias("label_x"), "main")

    def fresh(pairs: DataFrame, done: DataFrame) -> DataFrame:
        """Pairs (same, n, x, n_x) that are worth a comparison and haven't had one."""
        pairs = pairs.filter(comparable("n", "n_x")).select(F.least("same", "x").alias("a"), F.greatest("same", "x").alias("b")).distinct()
        done = done.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        return pairs.join(done, ["a", "b"], "left_anti")

    large = F.col("in_bucket") > SMALL_BUCKET
    mixed, apart = unsettled(labels, labels.count(), "first")
    few = mixed.filter(~large).drop("main").join(apart, "bucket").filter("label <> label_x").select("same", "n", "x", "n_x")
    # the hubs of a component are the same wherever it is the main one, so a class tries no more than these of each
    hub = [F.min_by(F.struct("same", "n"), F.xxhash64("same", F.lit(i))).alias(f"hub_{i}") for i in range(HUBS)]
    hubs = mixed.filter(large & (F.col("label") == F.col("main"))).groupBy("main").agg(*hub)
    hubs = hubs.select("main", F.explode(F.array_distinct(F.array(*(f"hub_{i}" for i in range(HUBS))))).alias("hub"))
    hubs = scratch.keep(hubs.select("main", "hub.same", "hub.n"), "hubs")
    lone = mixed.filter(large & (F.col("label") != F.col("main"))).select("main", F.col("same").alias("x"), F.col("n").alias("n_x")).distinct()
    tries = lone.join(sized(hubs, hubs.count()), "main").select("same", "n", "x", "n_x")
    more = compared(scratch.keep(fresh(few.unionByName(tries), seen), "tries"), "more")
    seen = seen.unionByName(more)
    labels = grown(scratch, labels, more.filter("good"), "second")

    # what is still apart in large buckets shares a rare token with whatever it is linked to. A small part of such pairs is
    # compared first, then four times as many each turn, and only of classes that haven't come together meanwhile: so a
    # group that is one component in the end is one after few comparisons. The last turn takes all pairs, so every pair is
    # in one component or compared
    mixed, _ = unsettled(labels, labels.count(), "second")
    groups = scratch.keep(mixed.filter(large).groupBy("same").agg(F.max(F.col("label") != F.col("main")).alias("is_apart")), "groups")
    n_groups = groups.count()
    if n_groups:
        early, parts = _rare_tokens(scratch, groups, n_groups, bodies, similarity, width)
        while parts:
            placed = early.join(sized(labels, labels.count()), F.col("same") == F.col("v"), "left").withColumn("label", F.coalesce("label", "same")).drop("v")
            met = _share(scratch.keep(placed, f"placed_late_{parts}"), similarity, parts)
            found = compared(scratch.keep(fresh(met, seen), f"rare_{parts}"), f"late_{parts}")
            seen = seen.unionByName(found)
            if found.filter("good").limit(1).count():
                labels = grown(scratch, labels, found.filter("good"), f"late_{parts}")
            parts //= FEWER
    n_labels = labels.count()

    whole = owners.join(sized(labels, n_labels), F.col("same") == F.col("v"), "left").select("same", F.coalesce("label", "same").alias("label"), "copies")
    tags = whole.filter((F.col("copies") > 1) | (F.col("label") != F.col("same")))
    heads = labels.select(F.col("label").alias("same"), "label").distinct().join(owners.select("same", "copies"), "same")
    tags = scratch.keep(tags.unionByName(heads.select("same", "label", "copies")).distinct().select("same", "label"), "tags")
    rows_in = signed.select("rid", "same").join(sized(tags, tags.count()), "same").select("rid", "label")
    rows_in = scratch.keep(rows_in.join(ids, "rid"), "rows_in")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "rid")).alias("first")
    heads = scratch.keep(rows_in.groupBy("label").agg(first, F.count(F.lit(1)).alias("class_size")), "heads")
    classes = rows_in.join(sized(heads, heads.count()), "label")
    return everything, classes.select("rid", F.col("first.doc_id").alias("class_id"), "class_size", (F.col("rid") == F.col("first.rid")).alias("kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, **how: object) -> DataFrame:
    """doc_id, class_id, class_size, kept for every row."""
    rows, classes = near_classes(Scratch(spark, "bagminhash"), docs, **how)
    ids = rows.select("rid", F.col("doc.doc_id").cast("long").alias("doc_id"))
    return ids.join(classes, "rid", "left").select(
        "doc_id", F.when(F.col("class_size").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"), F.coalesce("kept", F.lit(True)).alias("kept")
    )


def one_of_each_class(spark: SparkSession, docs: DataFrame, **how: object) -> DataFrame:
    """The input's rows, one of each class of near-duplicates."""
    scratch = Scratch(spark, "bagminhash")
    rows, classes = near_classes(scratch, docs, **how)
    dropped = scratch.keep(classes.filter("NOT kept").select("rid"), "dropped")
    return rows.join(sized(dropped, dropped.count()), "rid", "left_anti").select("doc.*")
