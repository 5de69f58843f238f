"""Spark sessions with the settings that the library expects."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def guard(spark: SparkSession) -> SparkSession:
    """Turns off a rule of Spark 4.1 by which a union claims its inputs' common hash partitioning: adaptive execution may
    then coalesce the inputs differently, and an aggregation above sees one key in two partitions. Makes sure that there
    is a folder for checkpoints."""
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        # a cluster names a shared folder; a folder of our own serves only on one machine, as in tests
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named or context.master.startswith("local"):
            context.setCheckpointDir(named or tempfile.mkdtemp(prefix="evidentia-"))
    return spark


def session(master: str = "local[*]", app: str = "evidentia", partitions: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A session with AQE, UTC and ANSI on; pass ``master=None`` to take the cluster's own."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.memory": memory,
    } | conf
    for k, v in settings.items():
        builder = builder.config(k, v)
    return guard(builder.getOrCreate())
