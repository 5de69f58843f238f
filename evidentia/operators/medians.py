"""Exact medians of groups of any size: a sketch that merges says between which values the median lies, and one more pass
counts the values between them.

No task holds a group. The first pass keeps a sketch for each group and task; the second sums equal values before they
are shuffled and sends everything outside the bounds as two counts. What is sorted for a group are its distinct values
between the bounds, of which ``accuracy`` leaves some ``10 / accuracy`` of its rows; the window over them spills.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A sketch's rank is off by at most the rows of the group divided by this.
ACCURACY = 10_000

#: Bounds are asked for this many times the sketch's error below and above the middle.
MARGIN = 4


def _long(rows: DataFrame, keys: Mapping[str, Column], measures: Mapping[str, Column]) -> DataFrame:
    """The keys, _m (name of the measure) and _v: every value that is neither NULL nor NaN."""
    pairs = F.array(*(F.struct(F.lit(m).alias("m"), c.cast("double").alias("v")) for m, c in measures.items()))
    out = rows.select(*(c.alias(k) for k, c in keys.items()), F.explode(pairs).alias("_p"))
    return out.select(*keys, F.col("_p.m").alias("_m"), F.col("_p.v").alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))


def _inside(long: DataFrame, keys: Sequence[str], accuracy: int) -> DataFrame:
    """The keys, _m, _n (values of the group), _side (-1, 0 or 1), _v (NULL outside the bounds) and _c (how many there are)."""
    by, q = [*keys, "_m"], MARGIN / accuracy
    ends = long.groupBy(*by).agg(F.percentile_approx("_v", [max(0.0, 0.5 - q), min(1.0, 0.5 + q)], accuracy).alias("_ends"), F.count(F.lit(1)).alias("_n"))
    ends = ends.withColumnsRenamed({k: f"_of{k}" for k in by})
    values = long.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_c"))
    same = [F.col(k).eqNullSafe(F.col(f"_of{k}")) for k in by]
    side = F.when(F.col("_v") < F.col("_ends")[0], -1).when(F.col("_v") > F.col("_ends")[1], 1).otherwise(0)
    placed = values.join(ends, same).withColumn("_side", side)
    return placed.groupBy(*by, "_n", "_side", F.when(F.col("_side") == 0, F.col("_v")).alias("_v")).agg(F.sum("_c").alias("_c"))


def medians(rows: DataFrame, by: Sequence[str], measures: Mapping[str, Column], accuracy: int = ACCURACY) -> DataFrame:
    """``by`` and a double for each measure: the median of its values, the mean of the middle two of an even number.

    Values are compared as doubles. NULL and NaN are left out; a measure without other values is NULL, and a group in
    which no measure has any is absent. NULL is a group of its own. Without ``by`` there is one row, or none. A bound
    that the sketch got wrong stops the job, it can't give a wrong median.
    """
    keys = {f"_k{i}": F.col(f"`{c}`") for i, c in enumerate(by)}
    group = [*keys, "_m"]
    upto = F.sum("_c").over(Window.partitionBy(*group).orderBy("_side", "_v").rowsBetween(Window.unboundedPreceding, 0))
    placed = _inside(_long(rows, keys, measures), list(keys), accuracy).withColumn("_upto", upto)
    # of the rows in order, the first that reaches a place holds its value
    at = lambda place: F.min(F.when(F.col("_upto") >= F.floor(place), F.struct("_upto", "_side", "_v")))
    middle = placed.groupBy(*group).agg(at((F.col("_n") + 1) / 2).alias("_lo"), at(F.col("_n") / 2 + 1).alias("_hi"))
    sure = (F.col("_lo._side") == 0) & (F.col("_hi._side") == 0)
    value = F.when(sure, F.when(F.col("_lo._v") == F.col("_hi._v"), F.col("_lo._v")).otherwise(F.col("_lo._v") / 2 + F.col("_hi._v") / 2)).otherwise(F.raise_error(F.lit("a median lies outside the bounds of its sketch")))
    named = middle.select(*group, value.alias("_median"))
    out = named.groupBy(*keys).agg(*(F.max(F.when(F.col("_m") == m, F.col("_median"))).alias(m) for m in measures))
    return out.withColumnsRenamed(dict(zip(keys, by)))


def with_medians(rows: DataFrame, by: Sequence[str], measures: Mapping[str, Column], *aggregates: Column) -> DataFrame:
    """The aggregates of each group, and medians. Both are put together by the keys, with NULL as a key like any other."""
    base = rows.groupBy(*by).agg(*aggregates)
    both = base.unionByName(medians(rows, by, measures), allowMissingColumns=True)
    return both.groupBy(*by).agg(*(F.max(F.col(f"`{c}`")).alias(c) for c in both.columns if c not in by))
