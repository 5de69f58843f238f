"""Files of a corpus: what is there, what manifests say, and verified copies; all work on files is done by tasks."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.shared import Tables

INVENTORY = "path string, length long, modified timestamp, sha256 string"

#: Bytes of a file that a copying task holds at once.
CHUNK = 8 << 20


def inventory(spark: SparkSession, root: str, pattern: str = "*", known: DataFrame | None = None) -> DataFrame:
    """(path, length, modified, sha256) of every file below ``root`` whose name matches.

    With ``known``, an earlier inventory, only files that are new or changed by length or time are read; files that have gone
    are left out. Without any file the result is empty.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    there = files.load(root).select("path", "length", F.col("modificationTime").alias("modified"))
    if known is None:
        return files.load(root).select("path", "length", F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("sha256"))
    tables = Tables(spark, "inventory")
    there = tables.keep(there, "there")
    keys = ["path", "length", "modified"]
    same = there.join(known.select(*keys, "sha256").dropDuplicates(keys), keys)
    changed = there.join(known.select(*keys), keys, "left_anti")
    first = changed.agg(F.date_format(F.min("modified") - F.expr("INTERVAL 1 SECOND"), "yyyy-MM-dd'T'HH:mm:ss")).first()[0]
    if first is None:
        return same.select("path", "length", "modified", "sha256")
    # older files aren't opened; of the others those that are known are dropped
    read = files.option("modifiedAfter", first).option("timeZone", spark.conf.get("spark.sql.session.timeZone")).load(root)
    read = read.select("path", "length", F.col("modificationTime").alias("modified"), "content").join(changed, keys, "left_semi")
    return same.select("path", "length", "modified", "sha256").unionByName(read.select("path", "length", "modified", F.sha2("content", 256).alias("sha256")))


def document_base(manifests: DataFrame, files: DataFrame) -> DataFrame:
    """Manifests (document_id, path, sha256, ...) against files, both ways, with ``file_status``: ok, no_checksum,
    checksum_mismatch, missing_file (a manifest without its file, or without a path) or orphan_file (no manifest names it)."""
    there = files.select(F.col("path").alias("_path"), F.col("length").alias("file_length"), F.col("sha256").alias("file_sha256"))
    out = manifests.join(there, F.col("path") == F.col("_path"), "full_outer")
    unnamed = F.col("path").isNull() & F.col("_path").isNotNull()
    blank = F.coalesce(F.trim("sha256"), F.lit("")) == ""
    status = F.when(unnamed, "orphan_file").when(F.col("_path").isNull(), "missing_file").when(blank, "no_checksum").when(F.lower("sha256") == F.col("file_sha256"), "ok").otherwise("checksum_mismatch")
    return out.withColumn("file_status", status).withColumn("path", F.coalesce("path", "_path")).drop("_path")


def base_summary(base: DataFrame) -> DataFrame:
    """How many documents and files have each status, and their bytes."""
    return base.groupBy("file_status").agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("file_length"), F.lit(0)).alias("bytes"))


def _digest(fs, path: str) -> str:
    out = hashlib.sha256()
    with fs.open_input_stream(path) as f:
        while piece := f.read(CHUNK):
            out.update(piece)
    return out.hexdigest()


def _copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs as pafs

    for batch in batches:
        said = []
        for source, target, expected in zip(batch["source"], batch["target"], batch["sha256"], strict=True):
            source_fs, source_path = pafs.FileSystem.from_uri(source)
            target_fs, target_path = pafs.FileSystem.from_uri(target)
            if target_fs.get_file_info(target_path).type == pafs.FileType.File and _digest(target_fs, target_path) == expected:
                said.append("present")
                continue
            if source_fs.get_file_info(source_path).type != pafs.FileType.File:
                said.append("missing_source")
                continue
            folder = target_path.rpartition("/")[0]
            target_fs.create_dir(folder, recursive=True)
            # a file of this attempt alone; the target appears whole, by one rename
            attempt = f"{folder}/_attempt-{uuid.uuid4().hex}"
            try:
                with source_fs.open_input_stream(source_path) as f, target_fs.open_output_stream(attempt) as to:
                    while piece := f.read(CHUNK):
                        to.write(piece)
                if good := _digest(target_fs, attempt) == expected:
                    target_fs.move(attempt, target_path)
                said.append("copied" if good else "checksum_mismatch")
            finally:
                if target_fs.get_file_info(attempt).type == pafs.FileType.File:
                    target_fs.delete_file(attempt)
        yield batch.assign(copy_status=said)


def copy_verified(plan: DataFrame) -> DataFrame:
    """Copies files and says how it went: ``plan`` has source and target (URIs of file systems that all executors share) and
    sha256; the result adds copy_status: copied, present, missing_source, or checksum_mismatch (nothing is left at the target
    that wasn't there).

    A copy is checked by reading it back before it gets its name. A task that is lost leaves at most a file of its attempt,
    named apart; whoever runs again, or a second task at the same time, finds the target whole or not at all. A target that
    is planned twice is copied from the smallest source.
    """
    once = plan.groupBy("target").agg(F.min(F.struct("source", F.lower("sha256").alias("sha256"))).alias("x")).select("x.source", "target", "x.sha256")
    return once.filter("source IS NOT NULL AND target IS NOT NULL").mapInPandas(_copy, "source string, target string, sha256 string, copy_status string")
