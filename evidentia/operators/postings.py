"""Top-k retrieval over sparse weights with an inverted index in shards of documents, block maxima and early termination.

Weights are dealt into shards of about ``SHARD_POSTINGS`` by a hash of the document, each built by one task: documents in
the order of their heaviest token, so that like ones are neighbours, cut into blocks of ``BLOCK`` documents, with the
greatest weight of each token in each block. Queries come in blocks of ``QUERIES``. A query takes a shard's blocks by
descending bound (the sum of its weights times the blocks' maxima) and stops at the first that can't reach its k-th
best; the bound of rounding is left as a margin, so ties are never lost. Each shard hands on at most k rows for a query.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import Tables

SHARD_POSTINGS, BLOCK, QUERIES = 500_000, 64, 2_000

SHARD = "idents array<string>, tokens array<string>, docs binary, terms binary, weights binary"


class Shard:
    """Postings of some documents, by document; ``ends`` says where those of each block of documents end."""

    def __init__(self, idents: list, tokens: list[str], docs: np.ndarray, terms: np.ndarray, weights: np.ndarray, block: int = BLOCK):
        self.idents, self.tokens, self.docs, self.terms, self.weights = idents, {t: i for i, t in enumerate(tokens)}, docs, terms, weights
        self.block, self.blocks = block, -(-len(idents) // block)
        self.ends = np.searchsorted(docs, np.arange(self.blocks + 1) * block)
        # the greatest weight of each (token, block) that occurs, by token
        at = terms.astype(np.int64) * self.blocks + docs // block
        self.cells, place = np.unique(at, return_inverse=True)
        self.most = np.zeros(len(self.cells))
        np.maximum.at(self.most, place, weights)
        self.first = np.searchsorted(self.cells, np.arange(len(tokens) + 1) * self.blocks)

    def search(self, query: dict[str, float], k: int, digits: int) -> tuple[list[int], list[float], int]:
        """(documents, rounded scores, postings read) of the k best by rounded score, then ident."""
        mine = [(self.tokens[t], w) for t, w in query.items() if t in self.tokens]
        bound = np.zeros(self.blocks)
        for t, w in mine:
            part = slice(self.first[t], self.first[t + 1])
            bound[self.cells[part] % self.blocks] += w * self.most[part]
        dense = np.zeros(len(self.tokens))
        for t, w in mine:
            dense[t] = w
        found: list[tuple[float, object, int]] = []
        read, slack = 0, 10.0**-digits
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] <= 0 or (len(found) == k and bound[b] + slack < -found[-1][0]):
                break
            part = slice(self.ends[b], self.ends[b + 1])
            read += part.stop - part.start
            product = self.weights[part] * dense[self.terms[part]]
            scores = np.bincount(self.docs[part] - b * self.block, weights=product)
            hits = np.flatnonzero(scores > 0)
            # rounded half up, as the plan does
            found = sorted(found + [(-float(np.floor(scores[i] * 10**digits + 0.5) / 10**digits), self.idents[b * self.block + i], int(b * self.block + i)) for i in hits])[:k]
        return [f[2] for f in found], [-f[0] for f in found], read


def _build(block: int):
    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        heaviest = pdf.sort_values(["weight", "token"], ascending=[False, True], kind="stable").drop_duplicates("ident")
        order = heaviest.sort_values(["token", "weight"], ascending=[True, False], kind="stable")["ident"].to_numpy()
        place = pd.Series(np.arange(len(order)), index=order)
        tokens, terms = np.unique(pdf["token"].to_numpy().astype(object), return_inverse=True)
        docs = place.loc[pdf["ident"]].to_numpy()
        by = np.lexsort((terms, docs))
        return pd.DataFrame({"idents": [list(order)], "tokens": [list(tokens)], "docs": [docs[by].astype("<i4").tobytes()], "terms": [terms[by].astype("<i4").tobytes()], "weights": [pdf["weight"].to_numpy()[by].astype("<f8").tobytes()]})

    return build


def _search(queries: list[tuple[str, dict[str, float]]], k: int, digits: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["idents"], row["tokens"], np.frombuffer(row["docs"], "<i4"), np.frombuffer(row["terms"], "<i4"), np.frombuffer(row["weights"], "<f8"), block)
                out: list[tuple] = []
                for name, query in queries:
                    docs, scores, read = shard.search(query, k, digits)
                    out += [(name, shard.idents[d], s, None, None) for d, s in zip(docs, scores, strict=True)]
                    out.append((name, None, None, read, len(shard.docs)))
                yield pa.RecordBatch.from_pylist([dict(zip(("query", "ident", "score", "read", "held"), r, strict=True)) for r in out], pa.schema([("query", pa.string()), ("ident", pa.string()), ("score", pa.float64()), ("read", pa.int64()), ("held", pa.int64())]))

    return run


def postings_topk(weights: DataFrame, queries: DataFrame, ident: str, query: str, k: int, digits: int = 6, block: int = BLOCK, shard_postings: int = SHARD_POSTINGS) -> tuple[DataFrame, DataFrame]:
    """(rows, measured): the k documents with the largest dot product for each query, by rounded score, then ident; and for
    each query how many postings were read of those held.

    ``weights`` has (ident, token, weight) and ``queries`` (query, token, weight), weights above 0. A document that shares
    no token isn't a row; null idents, tokens and weights take no part; an ident that repeats a token holds both.
    """
    spark = weights.sparkSession
    tables, kind = Tables(spark, "postings"), dict(weights.dtypes)[ident]
    sort_key = F.col(ident) if kind == "string" else F.lpad(F.col(ident).cast("string"), 20, "0")
    rows = weights.select(sort_key.alias("ident"), "token", F.col("weight").cast("double").alias("weight")).dropna()
    n = rows.count()
    shards = max(1, -(-n // shard_postings))
    index = tables.keep(rows.withColumn("shard", F.pmod(F.xxhash64("ident"), F.lit(shards))).groupBy("shard").applyInPandas(_build(block), SHARD), "index")
    # a row a query, in blocks that the driver holds one at a time
    asked = queries.select(F.col(query).cast("string").alias("query"), F.struct("token", F.col("weight").cast("double").alias("weight")).alias("x")).dropna()
    asked = tables.keep(asked.groupBy("query").agg(F.collect_list("x").alias("terms")), "asked")
    found, left = None, asked.toLocalIterator()
    for turn, block_rows in groupby(enumerate(left), lambda x: x[0] // QUERIES):
        some = []
        for _, r in block_rows:
            terms: dict[str, float] = {}
            for x in r["terms"]:
                terms[x["token"]] = terms.get(x["token"], 0.0) + x["weight"]
            some.append((r["query"], terms))
        part = tables.keep(index.mapInArrow(_search(some, k, digits, block), "query string, ident string, score double, read long, held long"), f"found_{turn}")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "query string, ident string, score double, read long, held long")
    back = F.col("ident") if kind == "string" else F.col("ident").cast(kind)
    best = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "ident"))
    top = found.filter("ident IS NOT NULL").withColumn("rank", best).filter(F.col("rank") <= k).select(F.col("query").alias(query), back.alias(ident), "score", "rank")
    return top, found.filter("read IS NOT NULL").groupBy(F.col("query").alias(query)).agg(F.sum("read").alias("postings_read"), F.sum("held").alias("postings"))
