"""Components of similar vectors by a metric-space join: cells around pivots, replicated borders, exact checks in blocks.

A cosine of at least t means a distance of at most r = sqrt(2 - 2t) between unit vectors. In a scope of more than ``SMALL``
rows each vector's home is the cell of its nearest pivot; it visits another cell only if that pivot is at most 2r farther,
for by the triangle inequality a neighbour's home can't be elsewhere. Homes and visitors of a cell are dealt into blocks,
and a task compares one block of homes with one of visitors as a matrix product, so a scope of any size is split. From each
pair of blocks only as many links come as tell its components. Scopes of at most ``SMALL`` rows are joined with themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Tables, components, sized

#: Rows of a scope that is joined with itself; pivots; rows of a block, about.
SMALL, PIVOTS, BLOCK = 32, 32, 1_000


def _links(least: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        home, visit = pdf[pdf["is_home"]], pdf[~pdf["is_home"]]
        compared = len(home) * len(visit)
        a, b = home["place"].to_numpy(), visit["place"].to_numpy()
        out = {"a": [], "b": [], "compared": []}
        if compared:
            x, y = np.stack(home["_v"].to_numpy()), np.stack(visit["_v"].to_numpy())
            i, j = np.nonzero(x @ y.T >= least * home["_n"].to_numpy()[:, None] * visit["_n"].to_numpy()[None])
            keep = a[i] != b[j]
            i, j = i[keep], j[keep]
            # the smallest label reachable inside this pair of blocks
            ids, at = np.unique(np.concatenate((a, b)), return_inverse=True)
            of, to = at[: len(a)][i], at[len(a) :][j]
            label = np.arange(len(ids))
            while True:
                new = label.copy()
                np.minimum.at(new, of, label[to])
                np.minimum.at(new, to, label[of])
                new = np.minimum(new, new[new])
                if (new == label).all():
                    break
                label = new
            moved = np.flatnonzero(label != np.arange(len(ids)))
            out = {"a": ids[moved], "b": ids[label[moved]], "compared": np.zeros(len(moved), np.int64)}
        links = pd.DataFrame(out).astype({"a": "Int64", "b": "Int64", "compared": "int64"})
        return pd.concat((links, pd.DataFrame({"a": [None], "b": [None], "compared": [compared]}).astype({"a": "Int64", "b": "Int64", "compared": "int64"})))

    return run


def similar_links(tables: Tables, vectors: DataFrame, within: Sequence[str], least: float, small: int = SMALL, pivots: int = PIVOTS, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(links, compared): pairs (a, b) of ``place`` whose components are those of all pairs with a cosine of at least
    ``least`` in a scope; and one row with the pairs compared in cells and the pairs of these scopes.

    ``vectors`` has place (long), _v (array of doubles), _n (its norm, above 0) and the columns ``within``, null-safe.
    """
    scope = F.xxhash64(*within, *(F.col(c).isNull() for c in within)) if within else F.lit(0).cast("long")
    rows = tables.keep(vectors.withColumn("scope", scope), "unit")
    sizes = tables.keep(rows.groupBy("scope").agg(F.count(F.lit(1)).alias("size")), "sizes")
    n = sizes.count()
    placed = rows.join(sized(sizes, n), "scope")
    few, many = placed.filter(F.col("size") <= small), placed.filter(F.col("size") > small)
    other = few.select("scope", F.col("place").alias("_place"), F.col("_v").alias("_w"), F.col("_n").alias("_m"), *(F.col(c).alias(f"_of_{c}") for c in within))
    dot = F.aggregate(F.zip_with("_v", "_w", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in within]
    pairs = few.join(other, "scope").filter((F.col("place") < F.col("_place")) & (dot >= least * F.col("_n") * F.col("_m")))
    for s in same:
        pairs = pairs.filter(s)
    plain = tables.keep(pairs.select(F.col("place").alias("a"), F.col("_place").alias("b")), "plain")
    # a bounded number of pivots, anywhere in the data; which ones they are changes the work alone
    chosen = many.select("_v", "_n").orderBy(F.xxhash64("place")).limit(pivots).collect()
    if not chosen:
        return plain, tables.spark.createDataFrame([(0, 0)], "compared long, pairs long")
    centres = np.array([np.array(r["_v"]) / r["_n"] for r in chosen])
    reach = 2 * float(np.sqrt(max(0.0, 2 - 2 * least))) + 1e-9

    @F.pandas_udf("home int, cells array<int>")
    def cells(v: pd.Series, norm: pd.Series) -> pd.DataFrame:
        unit = np.stack(v.to_numpy()) / norm.to_numpy()[:, None]
        far = np.sqrt(np.maximum(2 - 2 * unit @ centres.T, 0))
        home = far.argmin(axis=1)
        near = far <= far.min(axis=1)[:, None] + reach
        return pd.DataFrame({"home": home, "cells": [np.flatnonzero(x) for x in near]})

    dealt = tables.keep(many.select("scope", "size", "place", "_v", "_n", cells("_v", "_n").alias("c")).select("scope", "size", "place", "_v", "_n", "c.home", F.explode("c.cells").alias("cell")), "dealt")
    is_home = F.col("home") == F.col("cell")
    counts = dealt.groupBy("scope", "cell").agg(F.count_if(is_home).alias("homes"), F.count(F.lit(1)).alias("visits")).filter("homes > 0")
    counts = counts.select("scope", "cell", F.ceil(F.col("homes") / block).cast("int").alias("home_blocks"), F.ceil(F.col("visits") / block).cast("int").alias("visit_blocks"))
    counts = tables.keep(counts, "counts")
    both = dealt.join(sized(counts, counts.count()), ["scope", "cell"])
    own = F.pmod(F.xxhash64("place", F.lit(1)), F.col("home_blocks")).cast("int")
    seen = F.pmod(F.xxhash64("place", F.lit(2)), F.col("visit_blocks")).cast("int")
    span = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    homes = both.filter(is_home).select("scope", "cell", own.alias("h"), F.explode(span("visit_blocks")).alias("w"), "place", "_v", "_n", F.lit(True).alias("is_home"))
    # of two homes of one cell each visits the other; whoever lives elsewhere visits too
    visits = both.select("scope", "cell", F.explode(span("home_blocks")).alias("h"), seen.alias("w"), "place", "_v", "_n", F.lit(False).alias("is_home"))
    found = homes.unionByName(visits).groupBy("scope", "cell", "h", "w").applyInPandas(_links(least), "a long, b long, compared long")
    found = tables.keep(found, "found")
    whole = sizes.filter(F.col("size") > small).agg(F.sum(F.col("size") * F.col("size")).alias("pairs"))
    told = found.agg(F.sum("compared").alias("compared")).crossJoin(whole)  # one row each
    return plain.unionByName(found.filter("a IS NOT NULL").select("a", "b").distinct()), told


def similar_components(vectors: DataFrame, ident: str, vector: str, within: Sequence[str], least: float = 0.9, report: list | None = None, **how: int) -> DataFrame:
    """Components of rows whose cosine is at least ``least`` inside a scope: (ident, component), the smallest ident.

    A vector that is null, without components, with a null or non-finite one, of norm 0 or of another length than the most
    frequent is alone; null scopes are one scope. ``report``, if given, gets (pairs compared in cells, pairs of these
    scopes). Scopes are told apart by a hash of 64 bits.
    """
    tables = Tables(vectors.sparkSession, "similar")
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate("_v", F.lit(0.0), lambda a, x: a + x * x))
    rows = vectors.select(F.col(ident).alias("_ident"), *within, v.alias("_v")).withColumn("place", F.monotonically_increasing_id()).withColumn("_n", norm)
    rows = tables.keep(rows, "rows")
    real = rows.filter("_n > 0 AND _n < double('infinity')").filter(~F.isnan("_n"))
    size = real.groupBy(F.size("_v").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").first()
    links, told = similar_links(tables, real.filter(F.size("_v") == (size["size"] if size else 0)).select("place", "_v", "_n", *within), within, least, **how)
    if report is not None:
        report.append(tuple(told.first()))
    labels = components(tables, links)
    placed = tables.keep(rows.select("place", "_ident").join(sized(labels, labels.count()), F.col("place") == F.col("v"), "left").select("_ident", F.coalesce("label", "place").alias("label")), "placed")
    least_of = tables.keep(placed.groupBy("label").agg(F.min("_ident").alias("component")), "least")
    return placed.join(sized(least_of, least_of.count()), "label").select(F.col("_ident").alias(ident), "component")
