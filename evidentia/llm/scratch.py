"""Shared scratch tables, size-checked joins and bounded Arrow batches.

Everything that cuts lineage is a Parquet table in the folder that the cluster
names in ``spark.checkpoint.dir``, so it outlives any executor.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import guard

#: A side of at most so many rows, each of a few numbers or one short key, is broadcast (about 64 MB as a hash table).
BROADCAST_ROWS = 500_000

#: Rows that cross to Python in one Arrow batch; with texts of a few KB this keeps a batch to a few MB.
BATCH_ROWS = 1_000

#: Rows of a hot group that one task sorts, about.
FAN_ROWS = 5_000_000

_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one of our own only where it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    key = spark.sparkContext.applicationId
    if key not in _own:
        _own[key] = "file://" + tempfile.mkdtemp(prefix="evidentia-")
    return _own[key]


class Scratch:
    """Tables of one run, under a folder of its own."""

    #: The folders of all runs of this process that haven't been dropped.
    made: list[str] = []

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        Scratch.made.append(self.root)
        bound_batches(guard(spark))

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str, by: Sequence[str] = (), wide: bool = False) -> DataFrame:
        """Writes a table and gives it back as a scan; ``by`` makes it partitioned.

        Rows of many MB are ``wide``: each is a row group of its own. Parquet's writer otherwise looks at its size after a
        hundred rows only, and a scan unpacks all rows of a group at once.
        """
        to = df.write.option("compression", "zstd")
        to = to.option("parquet.block.row.count.limit", 1) if wide else to
        (to.partitionBy(*by) if by else to).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Removes a table that no later plan reads."""
        _remove(self.spark, self.path(name))

    @classmethod
    def drop_since(cls, spark: SparkSession, mark: int) -> None:
        """Removes the folders of all runs begun since ``len(Scratch.made)`` was ``mark``, when what they gave has been written elsewhere."""
        for root in cls.made[mark:]:
            _remove(spark, root)
        del cls.made[mark:]


def _remove(spark: SparkSession, path: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bound_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bounds what a Python worker holds at once, by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))


def sized(small: DataFrame, rows: int) -> DataFrame:
    """Marks a counted side for broadcast if it is small; otherwise a shuffle join, which AQE splits where keys are hot.

    Rows are those of a few numbers or short keys, some 100 bytes; wider ones must be counted as several.
    """
    return F.broadcast(small) if rows <= BROADCAST_ROWS else small


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ranked(scratch: Scratch, df: DataFrame, group: str, groups: int, spread: Column, order: Sequence[str], fans: int = 64) -> tuple[DataFrame, DataFrame]:
    """Adds ``rank_in`` (from 0 within ``group``), ``before`` (rows of lower groups) and returns it with the groups' counts.

    ``group`` is an integer column with at most ``groups`` values. Each group is fanned out by ``spread`` into ``fans``
    parts, so that a hot group is sorted by many tasks; parts are put one after the other by prefix sums over at most
    ``groups * fans`` counts. ``df`` is scanned twice and should be a written table of a few narrow columns. There are as
    many more fans as keep a group that holds all rows at ``FAN_ROWS`` a fan.
    """
    fans = max(fans, -(-df.count() // FAN_ROWS))
    fanned = df.withColumn("fan", F.pmod(spread, F.lit(fans)).cast("int"))
    counts = scratch.keep(fanned.groupBy(group, "fan").agg(F.count(F.lit(1)).alias("n")), f"counts_{group}")
    totals = counts.groupBy(group).agg(F.sum("n").alias("in_group"))
    # at most ``groups`` rows meet here, whatever the input
    totals = totals.withColumn("before", F.sum("in_group").over(Window.orderBy(group).rowsBetween(Window.unboundedPreceding, 0)) - F.col("in_group"))
    by_fan = Window.partitionBy(group).orderBy("fan").rowsBetween(Window.unboundedPreceding, 0)
    starts = counts.withColumn("fan_start", F.sum("n").over(by_fan) - F.col("n")).join(F.broadcast(totals), group).drop("n")
    starts = scratch.keep(starts, f"starts_{group}")
    inner = F.row_number().over(Window.partitionBy(group, "fan").orderBy(*order)) - 1
    out = fanned.withColumn("rank_fan", inner).join(sized(starts, groups * fans), [group, "fan"])
    return out.withColumn("rank_in", F.col("fan_start") + F.col("rank_fan")).drop("fan", "fan_start", "rank_fan"), scratch.keep(totals, f"totals_{group}")


def has_columns(df: DataFrame, **types: str) -> DataFrame:
    """Only the named columns, cast, so that extra columns and odd types can't clash."""
    return df.select(*(F.col(f"`{k}`").cast(v).alias(k) for k, v in types.items()))


def schema(text: str) -> T.StructType:
    return T._parse_datatype_string(text)
