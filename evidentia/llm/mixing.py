"""Mixing to target weights with soft memberships.

A document belongs to each domain with a probability. Domains are the label pairs (quality, toxic); a softmax regression
on shape steps and telling words, fitted on a bounded sample of the labelled training rows (at most ``SAMPLE``), gives
the posteriors. Then nonnegative rates r, one for each document, are fitted so that the expected tokens of every domain,
sum(r * tokens * posterior), meet the targets in the least-squares sense, by projected gradient from r = 1. A row's part of
the gradient is its posteriors times the domains' distances from the targets. Rows at 0 that the gradient would push below
stay; all others move along the gradient, as it is or scaled by the curvature of just these rows, and are projected on
r >= 0. Of a list of step lengths in both metrics the one that comes nearest is taken. This two-metric projection ends where
no direction is left, so at the targets, or at the least distance that any rates have. An iteration is two sums over a
written table that holds the tokens and posteriors of many rows as one block of bytes, so that a sum costs Spark a few
blocks rather than every row; only the totals and the curvature of the domains reach the driver.

A rate becomes a whole number of copies by a hash of doc_id: floor(rate), and one more with the probability of the rest.

Tokens are words between white space here. Defined cases: a null text counts as empty and has no tokens, its posteriors
come from the features that it has; without labels all posteriors are equal; targets that no rates r >= 0 meet are met as
nearly as any rates can; null doc_ids share one hash; rows that repeat are mixed one by one; an empty table gives an empty
result.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quality_knn import labelled_sample
from .scratch import Scratch, schema, text_of
from .shape import SHARES, STEPS, classes_of, steps_of

#: Labelled rows that the classifier is fitted on, at most.
SAMPLE = 6_000

#: Telling words, at most, and the fewest sampled documents that a word must be in.
WORDS, LEAST_DOCUMENTS = 256, 5

#: (quality, toxic) of each domain, and the share of all expected tokens that it shall have.
DOMAINS = ((0, 0), (0, 1), (1, 0), (1, 1))
TARGETS = (0.04, 0.01, 0.91, 0.04)

#: Steps at most, and the greatest distance from the targets, or from the least distance that any rates can have, as a share
#: of all tokens, at which they end.
ITERATIONS, CLOSE = 60, 1e-6

#: Added to the curvature for each unit of distance from the targets, so that it can be inverted; the lengths of steps that
#: are tried.
DAMPING, LENGTHS = 1e-8, tuple(2.0**-i for i in range(-3, 21))

#: Rows with tokens in one file of the table that the sums read, about; a batch of them is one block of bytes.
FILE_ROWS = 50_000

_MARKS = ".,;:!?()[]\"'|"


def words_of(tokens: Sequence[str]) -> set[str]:
    """The distinct words among a text's tokens, in lower case and without marks around them."""
    return {w.lower().strip(_MARKS) for w in set(tokens)} - {""}


def features(texts: Sequence[str], words: dict[str, int], tokens: Sequence[Sequence[str]] | None = None) -> np.ndarray:
    """A row for each text; ``tokens`` are the texts' tokens, if they are known."""
    out = np.zeros((len(texts), 1 + SHARES * len(STEPS) + len(words)), np.float32)
    out[:, 0] = 1
    for i, text in enumerate(texts):
        split = text.split() if tokens is None else tokens[i]
        out[i, 1 : 1 + SHARES * len(STEPS)] = steps_of(classes_of(text), split)
        for w in words_of(split) & words.keys():
            out[i, 1 + SHARES * len(STEPS) + words[w]] = 1
    return out


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_softmax(x: np.ndarray, y: np.ndarray, classes: int, decay: float = 1e-4, steps: int = 800) -> np.ndarray:
    """Weights of a softmax regression, by accelerated gradient descent on at most SAMPLE rows."""
    weights = ahead = np.zeros((x.shape[1], classes))
    if not len(x):
        return weights
    x = x.astype(np.float64)
    goal = np.eye(classes)[y]
    rate = 1 / (0.5 * np.linalg.norm(x.T @ x / len(x), 2) + decay)
    for k in range(steps):
        new = ahead - rate * (x.T @ (softmax(x @ ahead) - goal) / len(x) + decay * ahead)
        weights, ahead = new, new + k / (k + 3) * (new - weights)
    return weights


def train(scratch: Scratch, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    rows = scratch.keep(labelled_sample(docs, labels, {"quality": "int", "toxic": "int"}, sample).filter("quality IN (0, 1) AND toxic IN (0, 1)"), "sample")

    def each_word(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sorted(words_of(x.split())) for x in batch.column(0).to_pylist()], pa.list_(pa.string())), batch.column(1), batch.column(2)], ["words", "quality", "toxic"])

    n, quality, toxic = rows.agg(F.count(F.lit(1)), F.sum("quality"), F.sum("toxic")).first()
    known: dict[str, int] = {}
    if n:
        of = rows.select("text", "quality", "toxic").mapInArrow(each_word, "words array<string>, quality int, toxic int")
        counts = of.select(F.explode("words").alias("word"), "quality", "toxic").groupBy("word").agg(F.count(F.lit(1)).alias("df"), F.sum("quality").alias("q"), F.sum("toxic").alias("t"))

        def surprise(found: str, share: float) -> Column:
            """Squared distance from the expected count, in units of its variance."""
            return (F.col(found) - F.col("df") * share) ** 2 / (F.col("df") * max(share * (1 - share), 1e-9))

        best = counts.filter(F.col("df") >= LEAST_DOCUMENTS).withColumn("tells", F.greatest(surprise("q", quality / n), surprise("t", toxic / n)))
        known = {r["word"]: i for i, r in enumerate(best.orderBy(F.desc("tells"), "word").limit(WORDS).collect())}

    def design(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(batch.column(0).to_pylist(), known).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), batch.column(1), batch.column(2)], ["x", "quality", "toxic"])

    got = rows.select("text", "quality", "toxic").mapInArrow(design, "x binary, quality int, toxic int").toPandas()
    width = 1 + SHARES * len(STEPS) + len(known)
    x = np.frombuffer(b"".join(got["x"]), np.uint8).reshape(len(got), width)
    y = np.array([DOMAINS.index(d) for d in zip(got["quality"], got["toxic"], strict=True)], np.int64)
    return {"words": known, "weights": fit_softmax(x, y, len(DOMAINS))}


def posteriors(model: dict, texts: Sequence[str], tokens: Sequence[Sequence[str]] | None = None) -> np.ndarray:
    return softmax(features(texts, model["words"], tokens) @ model["weights"])


def members(scratch: Scratch, docs: DataFrame, labels: DataFrame, carried: Sequence[str], sample: int = SAMPLE) -> DataFrame:
    """A written table of ``doc`` (a struct of the carried columns), doc_id, n_tokens and the posteriors p."""
    model = scratch.spark.sparkContext.broadcast(train(scratch, docs, labels, sample))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = part.column(2).to_pylist()
                tokens = [x.split() for x in texts]
                p = posteriors(model.value, texts, tokens)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1) * p.shape[1], pa.int32()), pa.array(p.reshape(-1)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([len(x) for x in tokens], pa.int64()), lists], ["doc", "doc_id", "n_tokens", "p"])

    slim = docs.select(F.struct(*(F.col(f"`{c}`") for c in carried)).alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    out = T.StructType([slim.schema["doc"], slim.schema["doc_id"], *schema("n_tokens long, p array<double>")])
    return scratch.keep(slim.mapInArrow(add, out), "members")


#: How rates move, and the distances from the targets which that lessens.
Step = tuple[np.ndarray, np.ndarray]


def rates_after(p: np.ndarray, steps: Sequence[Step], start: float | np.ndarray = 1.0) -> np.ndarray:
    """The rates of rows with posteriors ``p`` after these steps. A step (s, y) leaves rates of 0 whose gradient p . y is above
    0, and takes all others to max(0, rate - p . s)."""
    rate = np.zeros(len(p)) + start
    if len(steps):
        ways, slopes = (np.array(x) @ p.T for x in zip(*steps, strict=True))
        for way, slope in zip(ways, slopes, strict=True):
            rate = np.where((rate <= 0) & (slope > 0), 0.0, np.maximum(rate - way, 0.0))
    return rate


def totals_of(n: np.ndarray, p: np.ndarray, steps: Sequence[Step], ends: Sequence[Step]) -> np.ndarray:
    """For each last step that is tried after ``steps``: the domains' totals of these rows."""
    before = rates_after(p, steps)
    ways, slopes = (np.array(x) @ p.T for x in zip(*ends, strict=True))
    rates = np.where((before <= 0) & (slopes > 0), 0.0, np.maximum(before - ways, 0.0))
    return rates @ (n[:, None] * p)


def stepped(found: DataFrame, steps: Sequence[Step], start: float = 1.0) -> DataFrame:
    """Adds ``rate`` after these steps."""
    steps = list(steps)

    @F.pandas_udf("double")
    def rate(p: pd.Series) -> pd.Series:
        return pd.Series(rates_after(np.stack(p.to_numpy()), steps, start) if len(p) else np.empty(0))

    return found.withColumn("rate", rate("p"))


def blocks(scratch: Scratch, found: DataFrame, rows: int) -> DataFrame:
    """A written table of the ``rows`` rows of ``found`` (n_tokens, p): a block of them holds their numbers one after the other
    in ``n``, and their posteriors row by row in ``p``, both as doubles."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                both = batch.column(0).to_numpy().astype(float), batch.column(1).flatten().to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in both], ["n", "p"])

    files = max(1, -(-rows // FILE_ROWS))
    return scratch.keep(found.select("n_tokens", "p").coalesce(files).mapInArrow(put, "n binary, p binary"), "blocks")


def _summed(found: DataFrame, d: int, per_block: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, float]]) -> tuple[np.ndarray, float]:
    """The sums of the first part of ``per_block(n_tokens, p)`` over all blocks, and the least of the second; a task hands on
    one row for each number."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, low = 0.0, np.inf
        for batch in batches:
            for n, p in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x, y = per_block(np.frombuffer(n), np.frombuffer(p).reshape(-1, d))
                total, low = total + x.reshape(-1), min(low, y)
        if np.ndim(total):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(total))), pa.array(np.concatenate(([low], total)))], ["i", "x"])

    got = found.select("n", "p").mapInArrow(part, "i long, x double").groupBy("i").agg(F.sum("x").alias("x"), F.min("x").alias("low")).collect()
    by = {r["i"]: r for r in got}
    return np.array([by[i]["x"] for i in range(len(by) - 1)]), by[-1]["low"]


def solve(totals: Callable[[list[Step], list[Step]], np.ndarray], curvature: Callable[[list[Step], np.ndarray], tuple[np.ndarray, float]], goal: np.ndarray, iterations: int, close: float) -> tuple[list[Step], np.ndarray, bool]:
    """The steps, the domains' distances from the goal after them, and whether these are as small as can be, to ``close``.

    ``totals(steps, ends)`` gives a row of the domains' totals for each last step that is tried after ``steps``,
    ``curvature(steps, y)`` the sum of p p' over the rows that a step along y may move, and the least p . y of all rows. Since posteriors add up to 1, the last bounds the distance of any rates from
    below: y, raised until no row has p . y < 0, parts the goal from all totals that rates r >= 0 can have. That proves that
    targets can't be met.
    """
    steps: list[Step] = []
    off, least = totals(steps, [(np.zeros(len(goal)), np.zeros(len(goal)))])[0] - goal, 0.0
    for turn in range(iterations + 1):
        size = float(np.linalg.norm(off))
        if np.abs(off).max() <= close:
            return steps, off, True
        curved, low = curvature(steps, off)
        raised = off + max(0.0, -low)
        least = max(least, float(-goal @ raised / max(np.linalg.norm(raised), 1e-300)))
        if size - least <= close:
            return steps, off, True
        if turn == iterations:
            break
        ways = [np.linalg.solve(curved + DAMPING * size * np.eye(len(goal)), off), off / max(np.linalg.norm(curved, 2), 1e-9)]
        ends = [(length * way, off) for way in ways for length in LENGTHS]
        far = totals(steps, ends) - goal
        best = int(np.linalg.norm(far, axis=1).argmin())
        if np.linalg.norm(far[best]) >= size:
            break
        steps, off = [*steps, ends[best]], far[best]
    return steps, off, False


def fit_rates(found: DataFrame, targets: Sequence[float], total: float | None = None, iterations: int = ITERATIONS, close: float = CLOSE) -> tuple[list[Step], float]:
    """The steps from rate 1 (none without tokens), and the distance from the targets at their end as a share of all tokens.
    If they end before the distance is proven to be the least, that is told as a warning.

    ``found`` has n_tokens and p. ``total`` is the expected number of tokens in all; by default as many as there are.
    """
    d = len(targets)
    found = found.filter("n_tokens > 0")
    tokens, rows = found.agg(F.sum("n_tokens"), F.count(F.lit(1))).first()
    if not rows:
        return [], 0.0
    held, upper = blocks(Scratch(found.sparkSession, "rates"), found, rows), np.triu_indices(d)

    def totals(steps: list[Step], ends: list[Step]) -> np.ndarray:
        return _summed(held, d, lambda n, p: (totals_of(n, p, steps, ends), 0.0))[0].reshape(len(ends), d) / tokens

    def curvature(steps: list[Step], y: np.ndarray) -> tuple[np.ndarray, float]:
        def free(n: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, float]:
            slope = p @ y
            n = np.where((rates_after(p, steps) > 0) | (slope <= 0), n, 0.0)
            return (p.T @ (n[:, None] * p))[upper], float(slope.min())

        out = np.zeros((d, d))
        sums, low = _summed(held, d, free)
        out[upper] = sums / tokens
        return out + np.triu(out, 1).T, low

    goal = np.array(targets, float) / sum(targets) * ((total or tokens) / tokens)
    steps, off, settled = solve(totals, curvature, goal, iterations, close)
    if not settled:
        warnings.warn(f"the rates haven't settled: {np.abs(off).max():.3g} of all tokens from the targets", stacklevel=2)
    return steps, float(np.abs(off).max())


def tilted(found: DataFrame, tilt: Sequence[float]) -> list[float]:
    """The present shares of the domains in the expected tokens, each times its tilt, as targets that add up to 1.

    Targets far from what a table holds can be met only by a few documents repeated very often in place of all others.
    Where a table has been filtered before, such as in a pipeline, its targets are better stated against what is there.
    """
    sums = found.agg(*(F.sum(F.col("n_tokens") * F.element_at("p", i + 1)) for i in range(len(tilt)))).first()
    wanted = [float(x or 0) * t for x, t in zip(sums, tilt, strict=True)]
    return [x / sum(wanted) for x in wanted] if sum(wanted) > 0 else [1 / len(tilt)] * len(tilt)


def with_rates(found: DataFrame, targets: Sequence[float] = TARGETS, tilt: Sequence[float] | None = None) -> DataFrame:
    """Adds ``rate``, ``copies`` and ``off_target``: how far the fitted rates' expected tokens are from the targets at the
    most, as a share of all tokens; above CLOSE where no rates reach them (or with a warning, where the steps ended before)."""
    steps, off = fit_rates(found, targets if tilt is None else tilted(found, tilt))
    chance = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    out = stepped(found, steps)
    out = out.withColumn("rate", F.round("rate", 9))
    out = out.withColumn("off_target", F.lit(off))
    return out.withColumn("copies", (F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("int")).cast("int"))


def mix(spark: SparkSession, docs: DataFrame, labels: DataFrame, targets: Sequence[float] = TARGETS, tilt: Sequence[float] | None = None) -> DataFrame:
    """doc_id, n_tokens, a posterior for each domain, rate, copies and off_target for every row."""
    found = with_rates(members(Scratch(spark, "mixing"), docs, labels, ["doc_id"]), targets, tilt)
    named = [F.element_at("p", i + 1).alias(f"p_quality{q}_toxic{t}") for i, (q, t) in enumerate(DOMAINS)]
    return found.select("doc_id", "n_tokens", *named, "rate", "copies", "off_target")


def mixed_rows(spark: SparkSession, docs: DataFrame, labels: DataFrame, targets: Sequence[float] = TARGETS, tilt: Sequence[float] | None = None) -> DataFrame:
    """The input's rows, each as many times as it has copies; ``tilt`` states the targets against the present shares."""
    found = with_rates(members(Scratch(spark, "mixing"), docs, labels, docs.columns), targets, tilt)
    return found.select("doc", F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("copy")).select("doc.*")
