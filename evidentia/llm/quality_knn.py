"""Quality scores by nearest-neighbour voting in a latent-semantic space.

Labelled documents are a bounded sample of the training rows: at most ``SAMPLE`` rows, the first in the order of a hash
of doc_id. Their features, weighted by inverse document frequency, are projected on the leading ``DIMENSIONS`` right
singular vectors. The labelled vectors (at most SAMPLE x DIMENSIONS floats) are broadcast; every document's vector is
multiplied with all of them, block by block, and its ``NEIGHBOURS`` nearest vote with the fourth power of their cosine.

Defined cases: a null or empty text, or one without any feature, gets the share of label 1 in the sample; without usable
labels every score is 0.5; labels other than 0 and 1 and null doc_ids in ``labels`` are ignored, and of repeated labels the largest
counts; of several texts with one doc_id the smallest is learnt from; labelled vectors stand in the order of doc_id, and
of equal cosines the earlier vector is nearer; rows that repeat are scored one by one; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import bound_batches, has_columns, text_of
from .shape import PAIRS, SHARES, STEPS, pairs_and_steps

#: Labelled rows that the model is fitted on and that vote, at most.
SAMPLE = 4_000

DIMENSIONS, NEIGHBOURS, POWER = 48, 15, 4
STEP_WEIGHT = 0.6
FEATURES = PAIRS + SHARES * len(STEPS)

#: Documents whose vectors are multiplied with the labelled ones at a time.
BLOCK = 256

#: From this score on a document is predicted to be of label 1.
LEAST_SCORE = 0.3


def held_out() -> Column:
    """Rows that no model learns from."""
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def raw_features(texts: list[str]) -> np.ndarray:
    """Square roots of pair frequencies, and weighted steps."""
    out = np.zeros((len(texts), FEATURES), np.float32)
    for i, text in enumerate(texts):
        pairs, steps = pairs_and_steps(text)
        out[i, :PAIRS] = np.sqrt(pairs / max(pairs.sum(), 1))
        out[i, PAIRS:] = steps * STEP_WEIGHT
    return out


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def fit(raw: np.ndarray, labels: np.ndarray) -> dict:
    """Inverse document frequencies, projection, and the labelled vectors; ``raw`` has at most SAMPLE rows."""
    n = len(raw)
    idf = (np.log((1 + n) / (1 + (raw > 0).sum(axis=0))) + 1).astype(np.float32)
    idf[PAIRS:] = 1
    weighted = unit(raw * idf)
    k = min(DIMENSIONS, n)
    basis = np.linalg.qr(weighted @ np.random.default_rng(7).standard_normal((FEATURES, k + 16)).astype(np.float32))[0]
    for _ in range(3):
        basis = np.linalg.qr(weighted @ (weighted.T @ basis))[0]
    top = np.linalg.svd(basis.T @ weighted, full_matrices=False)[2][:k]
    return {"idf": idf, "top": top.astype(np.float32), "vectors": unit(weighted @ top.T).astype(np.float32), "labels": labels.astype(np.float32)}


def nearest_of(cosine: np.ndarray, k: int) -> np.ndarray:
    """The columns of each row's k greatest values; of equal ones the first."""
    near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
    least = np.take_along_axis(cosine, near, axis=1).min(axis=1)
    # only where more than k reach the least is the choice not settled
    for i in np.flatnonzero((cosine >= least[:, None]).sum(axis=1) > k):
        near[i] = np.argsort(-cosine[i], kind="stable")[:k]
    return near


def score(model: dict, texts: list[str]) -> np.ndarray:
    """Weighted share of label 1 among the nearest labelled vectors; exact cosines against all of them."""
    labels = model["labels"]
    if not len(labels):
        return np.full(len(texts), 0.5)
    latent = unit(raw_features(texts) * model["idf"]) @ model["top"].T
    cosine = unit(latent) @ model["vectors"].T
    k = min(NEIGHBOURS, len(labels))
    near = nearest_of(cosine, k)
    weight = np.take_along_axis(cosine, near, axis=1).clip(0).astype(np.float64) ** POWER
    whole = weight.sum(axis=1)
    return np.where(whole > 0, (weight * labels[near]).sum(axis=1) / np.where(whole > 0, whole, 1), labels.mean())


def labelled_sample(docs: DataFrame, labels: DataFrame, columns: dict[str, str], sample: int) -> DataFrame:
    """(doc_id, text, labels): at most ``sample`` training rows with labels 0 and 1, chosen by a hash of doc_id."""
    known = has_columns(labels, doc_id="long", **columns).dropna().filter(~held_out())
    for c in columns:
        known = known.filter(F.col(c).isin(0, 1))
    known = known.groupBy("doc_id").agg(*(F.max(c).alias(c) for c in columns))
    order = F.xxhash64(F.col("doc_id"), F.lit(7))
    known = known.orderBy(order, "doc_id").limit(sample)
    texts = has_columns(docs, doc_id="long", text="string").select("doc_id", text_of().alias("text"))
    found = texts.join(F.broadcast(known), "doc_id")
    return found.groupBy("doc_id", *columns).agg(F.min("text").alias("text")).select("doc_id", "text", *columns)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for i in range(0, len(texts), BLOCK):
                raw = raw_features(texts[i : i + BLOCK]).astype(np.float16)
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in raw], pa.binary()), batch.column(1)[i : i + BLOCK], batch.column(2)[i : i + BLOCK]], ["raw", "label", "doc_id"])

    rows = labelled_sample(docs, labels, {"quality": "int"}, sample).select("text", "quality", "doc_id")
    got = rows.mapInArrow(features, "raw binary, label int, doc_id long").toPandas().sort_values("doc_id")
    if not len(got):
        return {"labels": np.empty(0, np.float32)}
    raw = np.frombuffer(b"".join(got["raw"]), np.float16).reshape(len(got), FEATURES).astype(np.float32)
    return fit(raw, got["label"].to_numpy())


def scored(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The input as column ``doc`` (a struct of all its columns) with ``score``."""
    bound_batches(spark)
    model = spark.sparkContext.broadcast(train(docs, labels, sample))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK):
                doc = batch.slice(i, BLOCK).column(0)
                texts = pc.fill_null(pc.cast(doc.field("text"), pa.string()), "").to_pylist()
                yield pa.RecordBatch.from_arrays([doc, pa.array(score(model.value, texts), pa.float64())], ["doc", "score"])

    # the text crosses to Python once, inside its row
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    return whole.mapInArrow(add, T.StructType([whole.schema["doc"], T.StructField("score", T.DoubleType())]))


def quality_scores(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    slim = has_columns(docs, doc_id="long", text="string")
    # only doc_id rides along; the score sees the text alone
    out = scored(spark, slim.select("doc_id", "text"), labels, sample).select("doc.doc_id", "score")
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted"))


def good_rows(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The input's rows that are predicted to be of label 1."""
    return scored(spark, docs, labels, sample).filter(F.col("score") >= LEAST_SCORE).select("doc.*")
