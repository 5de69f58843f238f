"""Medians by a sketch and one exact pass, against a plain median of all values."""

import math
import random
from statistics import median

import pytest

from evidentia.operators import medians as M, statistics as T
from pyspark.sql import functions as F


def plain(values):
    kept = [v for v in values if v is not None and not math.isnan(v)]
    return median(kept) if kept else None


@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_equal_to_a_plain_median(spark, accuracy):
    r = random.Random(accuracy)
    groups = {
        "hot": [r.random() for _ in range(20_001)], "even": [r.gauss(0, 1e6) for _ in range(4_000)], "ties": [float(r.randrange(3)) for _ in range(3_000)], "same": [7.0] * 900,
        "skewed": [r.paretovariate(0.2) for _ in range(2_500)], "one": [3.5], "two": [-1.0, 2.0], "none": [None, math.nan], "odd": [None, 4.0, math.nan, -math.inf, math.inf], None: [1.0, 2.0, 4.0, 8.0],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    r.shuffle(rows)
    # clashing names, and values in an order that differs from one task to the next
    df = spark.createDataFrame([(g, v, 0) for g, v in rows], "_m string, _v double, _n int").repartition(7)
    got = {x["_m"]: (x["a"], x["b"]) for x in M.medians(df, ["_m"], {"a": F.col("_v"), "b": -F.col("_v")}, accuracy).collect()}
    want = {g: plain(vs) for g, vs in groups.items() if g != "none"}
    assert {g: a for g, (a, _) in got.items()} == want
    assert {g: -b for g, (_, b) in got.items()} == want


def test_few_values_of_a_hot_group_are_sorted(spark):
    n = 200_000
    df = spark.range(n).select(F.lit("x").alias("g"), F.rand(3).alias("v"), F.lit(None).cast("double").alias("w"))
    inside = M._inside(M._long(df, {"_k0": F.col("g")}, {"v": F.col("v")}), ["_k0"], 1_000)
    # two rows hold all that lies outside the bounds
    assert inside.count() <= 2 + n * (2 * M.MARGIN + 2) / 1_000
    assert inside.agg(F.sum("_c")).first()[0] == n
    assert M.medians(df, ["g"], {"v": F.col("v"), "w": F.col("w")}).first()["w"] is None


def test_empty_and_global(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert M.medians(df, ["g"], {"v": F.col("v")}).collect() == []
    assert [tuple(x) for x in M.with_medians(df, [], {"v": F.col("v")}, F.count(F.lit(1)).alias("n")).collect()] == [(0, None)]
    some = spark.createDataFrame([("a", 1.0), ("a", 5.0), (None, None)], "g string, v double")
    assert [tuple(x) for x in M.with_medians(some, [], {"m": F.col("v")}, F.count(F.lit(1)).alias("n")).collect()] == [(3, 3.0)]
    assert sorted((tuple(x) for x in T.quantities(some, ["g"], {"v": F.col("v")}).collect()), key=repr) == [("a", 2, 3.0, 3.0), (None, 1, None, None)]


def test_a_wrong_bound_stops_the_job(spark, monkeypatch):
    # an accuracy below one asks for bounds far from the middle and lets the sketch be wrong
    monkeypatch.setattr(M, "MARGIN", -300)
    df = spark.range(1_000).select(F.col("id").cast("double").alias("v"))
    with pytest.raises(Exception, match="outside the bounds"):
        M.medians(df, [], {"v": F.col("v")}, 1_000).collect()
