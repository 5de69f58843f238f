"""Exact deduplication by distributed most-significant-digit radix partitioning.

A document is its text without the six ASCII white-space characters. Its length is the leading digit; then come its
UTF-8 bytes, taken from the left in digits of 64, 256, 1024, ... bytes. Each round splits the groups still open by their
next digit. A group of one document is settled; a group that has no more bytes is a group of equal documents. No digest
takes part in the comparison. Members of a group are counted by partial aggregation, so a group with a third of all rows
sends one row per task to its split, and rows learn their new group by a join that is broadcast if small, or else a
shuffle join that AQE splits where a group is hot.

Defined cases: null text counts as empty; all empty documents are equal; of rows that repeat in doc_id and text one is
kept; null doc_ids sort last among equals; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch, has_columns, sized, text_of

#: Width of the first digit, and how much wider each next digit is.
FIRST_DIGIT, WIDER = 64, 4

#: The longest text in bytes that a string column can hold bounds the number of rounds.
_LONGEST = 1 << 31


def _digits() -> list[tuple[int, int]]:
    """(offset, width) of each digit."""
    out, at, width = [], 0, FIRST_DIGIT
    while at < _LONGEST:
        out.append((at, width))
        at, width = at + width, width * WIDER
    return out


def equal_groups(scratch: Scratch, slim: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, groups): every row of ``slim`` (rid, doc_id, text), and (rid, gid) for rows in groups of equal documents."""
    digits = _digits()
    slim = slim.select("rid", "doc_id", F.length("text").alias("n_points"), F.regexp_replace("text", "[ \\t-\\r]", "").alias("norm"))
    slim = slim.select("rid", "doc_id", "n_points", F.sha2("norm", 256).alias("text_sha256"), F.col("norm").cast("binary").alias("bytes"))
    slim = slim.withColumn("size", F.octet_length("bytes"))
    table = F.array(*(F.struct(F.lit(i).alias("level"), F.lit(at).alias("at"), F.lit(w).alias("w")) for i, (at, w) in enumerate(digits)))
    used = F.filter(table, lambda d: (d["at"] < F.col("size")) | (d["level"] == 0))
    cut = slim.select("rid", "doc_id", "n_points", "text_sha256", "size", F.explode(F.transform(used, lambda d: F.struct(d["level"].alias("level"), F.substring(F.col("bytes"), d["at"] + 1, d["w"]).alias("digit")))).alias("d"))
    first = F.col("d.level") == 0
    cut = cut.select("rid", F.col("d.level").alias("level"), F.col("d.digit").alias("digit"), "size", *(F.when(first, F.col(c)).alias(c) for c in ("doc_id", "n_points", "text_sha256")))
    cut = scratch.keep(cut, "digits", by=["level"])

    ended, open_rows = [], None
    for level, (at, width) in enumerate(digits):
        rows = cut.filter(F.col("level") == level).select("rid", "digit", "size")
        if open_rows is None:
            rows = rows.withColumn("gid", F.lit(0).cast("long"))
        else:
            rows = scratch.keep(rows.join(sized(open_rows, n_open), "rid"), f"open_{level}")
        key = ["gid", "size", "digit"]
        groups = scratch.keep(rows.groupBy(*key).agg(F.min("rid").alias("next"), F.count(F.lit(1)).alias("n")).filter("n > 1"), f"groups_{level}")
        n_groups = groups.count()
        if not n_groups:
            break
        split = scratch.keep(rows.join(sized(groups, n_groups * (width // FIRST_DIGIT)), key).select("rid", F.col("next").alias("gid"), (F.col("size") <= at + width).alias("ended")), f"split_{level}")
        ended.append(split.filter("ended").select("rid", "gid"))
        open_rows = split.filter("NOT ended").select("rid", "gid")
        n_open = open_rows.count()
        if not n_open:
            break
    every = cut.filter("level = 0").select("rid", "doc_id", "n_points", "text_sha256")
    groups = scratch.spark.createDataFrame([], "rid long, gid long")
    for x in ended:
        groups = groups.unionByName(x)
    return every, groups


def decided(scratch: Scratch, slim: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, members): all rows, and those in groups of two or more with keep_id, keep_rid and group_size. Of equal
    texts the row with most code points, then the smallest doc_id stays."""
    every, groups = equal_groups(scratch, slim)
    members = scratch.keep(every.join(groups, "rid"), "members")
    # lengths are turned round, as the smallest long has no opposite
    order = F.struct((-F.col("n_points")).alias("short"), F.col("doc_id").isNull().alias("unknown"), "doc_id", "rid")
    best = members.groupBy("gid").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("group_size"))
    best = scratch.keep(best.select("gid", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.rid").alias("keep_rid")), "best")
    return every, members.join(sized(best, best.count()), "gid")


def exact_dedup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row."""
    scratch = Scratch(spark, "radix")
    # the number is fixed by the first table that is written, which all later steps read
    slim = has_columns(docs, doc_id="long", text="string").select(F.monotonically_increasing_id().alias("rid"), "doc_id", text_of().alias("text"))
    every, members = decided(scratch, slim)
    members = scratch.keep(members, "found")
    found = members.select("doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), "text_sha256")
    single = every.join(sized(members.select("rid"), members.count()), "rid", "left_anti")
    single = single.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    return found.unionByName(single)


def distinct_rows(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The input's rows without those whose text equals that of a row that stays."""
    scratch = Scratch(spark, "radix")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")).withColumn("rid", F.monotonically_increasing_id())
    rows = scratch.keep(rows, "rows")
    _, members = decided(scratch, rows.select("rid", F.col("doc.doc_id").cast("long").alias("doc_id"), text_of("doc.text").alias("text")))
    dropped = scratch.keep(members.filter("rid <> keep_rid").select("rid"), "dropped")
    return rows.join(sized(dropped, dropped.count()), "rid", "left_anti").select("doc.*")
