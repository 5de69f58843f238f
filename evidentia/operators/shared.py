"""Tables of one run, in the folder that ``spark.checkpoint.dir`` names."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import guard

#: A counted side of at most so many narrow rows is broadcast.
BROADCAST_ROWS = 500_000


def sized(side: DataFrame, rows: int) -> DataFrame:
    """Marks a counted side of narrow rows for broadcast if it is small; else a shuffle join, which is split where keys are hot."""
    return F.broadcast(side) if rows <= BROADCAST_ROWS else side


class Tables:
    """Written tables, each of which cuts the lineage; ``drop`` removes them when what was made from them is stored."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = guard(spark)
        self.root = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def components(tables: Tables, links: DataFrame, name: str = "components") -> DataFrame:
    """(v, label): for every end of the links (a, b) the smallest vertex that is reachable. Labels walk to neighbours and jump
    to their label's label until none moves; each round is a written table."""
    both = tables.keep(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}_links")
    labels = tables.keep(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("label")), f"{name}_0")
    n, turn, moved = labels.count(), 0, True
    while n and moved:
        turn += 1
        near = both.join(sized(labels, n), F.col("b") == F.col("v")).groupBy("a").agg(F.min("label").alias("near"))
        near = tables.keep(labels.join(near, F.col("v") == F.col("a")).select("v", F.col("label").alias("old"), F.least("label", "near").alias("label")), f"{name}_near_{turn}")
        jump = near.select(F.col("v").alias("via"), F.col("label").alias("far"))
        step = tables.keep(near.join(sized(jump, n), F.col("label") == F.col("via")).select("v", "old", F.least("label", "far").alias("label")), f"{name}_{turn}")
        labels, moved = step.select("v", "label"), bool(step.filter("label <> old").limit(1).count())
    return labels
