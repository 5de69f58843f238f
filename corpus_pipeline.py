"""The corpus pipeline: five operators of ``evidentia.llm``, each stage written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``. All but the last return the columns of
``docs``. Quality rejects go; of equal texts one stays; of near-duplicates one stays; mixing repeats a row as often as
its rate says, or not at all; packing gives every row its place in a batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from evidentia.llm.bagminhash import one_of_each_class
from evidentia.llm.mixing import mixed_rows
from evidentia.llm.packing import pack
from evidentia.llm.quality_knn import good_rows
from evidentia.llm.radix_dedup import distinct_rows
from evidentia.llm.scratch import Scratch


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return good_rows(spark, docs, _labels(spark, sf_dir))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return distinct_rows(spark, docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each_class(spark, docs)


#: Domains are (quality, toxic) pairs. The stages before have left few documents of low quality, so targets are stated
#: against what is there: good toxic text gets half of its present share, and the others what becomes free.
TILT = (1.0, 1.0, 1.0, 0.5)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_rows(spark, docs, _labels(spark, sf_dir), tilt=TILT)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(spark, docs)


STAGES = [("quality_classifier", quality), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mixing), ("packing", packing)]

#: The stages have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. A stage's scratch tables and its input go when its output is written."""
    scratch, before = Scratch(spark, "pipeline"), None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        mark = len(Scratch.made)
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
        Scratch.drop_since(spark, mark)
        if before:
            scratch.drop(before)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
