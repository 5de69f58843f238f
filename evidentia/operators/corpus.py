"""The corpus path: duplicate groups, canonical documents, selection, quality buckets.

Tables carry their order as a column; every ranking ends in a unique column, so results don't depend on partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import first_case, missing, reasons


def first_of(df: DataFrame, by: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each group; Spark filters groups before it shuffles them."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def numbered(df: DataFrame, name: str, key: str, pattern: str, prefix: int = 2) -> DataFrame:
    """Ids from a pattern in the order of a text key. Keys with the same first characters are numbered in one task, after
    the counts of the prefixes before them, so no task sorts everything."""
    rows = df.withColumn("_prefix", F.substring(key, 1, prefix))
    counts = rows.groupBy("_prefix").agg(F.count(F.lit(1)).alias("_n"))
    # a row for each prefix, 256 of two hexadecimal digits
    before = F.sum("_n").over(Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_prefix", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.col("_before") + F.row_number().over(Window.partitionBy("_prefix").orderBy(key))
    return rows.join(starts, "_prefix").withColumn(name, F.format_string(pattern, place)).drop("_prefix", "_before")


def exact_duplicate_groups(docs: DataFrame, key: str = "sha256", ident: str = "document_id", sets: Mapping[str, str] | None = None) -> DataFrame:
    """Groups of two or more rows with the same non-blank key: id in key order, size, sorted members, sorted distinct sets."""
    rows = docs.filter(missing(F.col(key)).isNotNull())
    collected = [F.array_sort(F.collect_set(c)).alias(alias) for c, alias in (sets or {}).items()]
    groups = rows.groupBy(key).agg(F.count(F.lit(1)).alias("duplicate_count"), F.array_sort(F.collect_list(ident)).alias("members"), *collected)
    return numbered(groups.filter("duplicate_count > 1"), "duplicate_group_id", key, "exact_dup_%04d")


def duplicate_ids(docs: DataFrame, key: str = "sha256") -> DataFrame:
    """The key, duplicate_count and duplicate_group_id of the same groups, without lists of members."""
    counts = docs.filter(missing(F.col(key)).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("duplicate_count"))
    return numbered(counts.filter("duplicate_count > 1"), "duplicate_group_id", key, "exact_dup_%04d")


def duplicate_members(docs: DataFrame, groups: DataFrame, key: str = "sha256", ident: str = "document_id") -> DataFrame:
    """(duplicate_group_id, member) in long form: what groups hold, without a list of them in any row."""
    return docs.select(key, F.col(ident).alias("member")).join(groups.select(key, "duplicate_group_id"), key).select("duplicate_group_id", "member")


def dedup_summary(docs: DataFrame, key: str = "sha256") -> DataFrame:
    """One row: documents, with a key, distinct keys, groups of duplicates, documents in them. One aggregation per key first."""
    per_key = docs.groupBy(missing(F.col(key)).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    known = F.col("k").isNotNull()
    return per_key.agg(
        F.sum("n").alias("documents"),
        F.sum(F.when(known, F.col("n")).otherwise(0)).alias("with_key"),
        F.count_if(known).alias("unique_keys"),
        F.count_if(known & (F.col("n") > 1)).alias("groups"),
        F.sum(F.when(known & (F.col("n") > 1), F.col("n")).otherwise(0)).alias("in_groups"),
    )


def canonical_documents(docs: DataFrame, key: str, order: Sequence[Column | str], gathered: Mapping[str, str]) -> DataFrame:
    """The best row of each key, with the number of rows and each gathered column's distinct values in sorted order."""
    best = first_of(docs, [key], order)
    groups = docs.groupBy(key).agg(F.count(F.lit(1)).alias("duplicate_count"), *(F.array_sort(F.collect_set(c)).alias(alias) for c, alias in gathered.items()))
    canonical_id = F.concat(F.lit("canonical_"), F.substring(F.sha2(F.concat(F.lit("canonical|"), F.col(key)), 256), 1, 24))
    return best.join(groups, key).withColumn("canonical_document_id", canonical_id)


def scope(df: DataFrame, slugs: Sequence[str] | None = None, years: Sequence[int] | None = None) -> DataFrame:
    """Rows of these companies and fiscal years; no filter where a set is None."""
    if slugs is not None:
        df = df.filter(F.col("company_slug").isin(list(slugs)))
    if years is not None:
        df = df.filter(F.col("fiscal_year").try_cast("int").isin(list(years)))
    return df


def with_reasons(df: DataFrame, cases: Sequence[tuple[Column, str]], order: Sequence[Column | str], at_most: int | None = None) -> DataFrame:
    """Adds ``skip_reason`` (NULL: selected), all reasons that hold; beyond ``at_most`` selected rows, max_documents. ``order``
    is ascending and must tell all rows apart."""
    out = df.withColumn("skip_reason", reasons(*cases))
    if at_most is not None:
        # the last place still taken comes from a top-n, of which each task keeps its own n; then rows are only compared
        key = F.struct(*(F.col(c) if isinstance(c, str) else c for c in order))
        first = out.filter("skip_reason IS NULL").select(key.alias("_key")).orderBy("_key").limit(at_most)
        last = first.agg(F.max("_key").alias("_last"), F.count(F.lit(1)).alias("_taken"))
        out = out.join(F.broadcast(last)).withColumn("_beyond", (F.col("_taken") >= at_most) & F.coalesce(key > F.col("_last"), F.lit(at_most == 0)))
        out = out.withColumn("skip_reason", F.coalesce("skip_reason", F.when(F.col("_beyond"), F.lit("max_documents")))).drop("_last", "_taken", "_beyond")
    return out


#: Points of the selection score.
SELECTION_POINTS = {"valid_pdf": 1000, "likely_valid": 500, "needs_review": 150, "likely_wrong_company": -700, "official": 40, "company": 30, "year": 25}


def selection_score(technical: Column, status: Column, official: Column, company: Column, year: Column, pages: Column, copies: Column, complete_type: Column) -> Column:
    p = SELECTION_POINTS
    one = lambda cond, points: F.when(F.coalesce(cond, F.lit(False)), F.lit(float(points))).otherwise(F.lit(0.0))
    return (
        one(technical == "valid_pdf", p["valid_pdf"])
        + sum((one(status == s, p[s]) for s in ("likely_valid", "needs_review", "likely_wrong_company")), F.lit(0.0))
        + one(official, p["official"])
        + one(company, p["company"])
        + one(year, p["year"])
        + F.when(complete_type, F.least(pages, F.lit(500)) * 0.2).otherwise(0.0)
        + F.least(copies, F.lit(20)) * 0.5
    )


def ranked_selection(df: DataFrame, scope_by: Sequence[str], order: Sequence[Column | str], rejected: Sequence[tuple[Column, str]], same: str | None = None) -> DataFrame:
    """Adds selection_status and selection_reason: rows that a case rejects, copies within a scope, and all but the best."""
    out = df.withColumn("selection_reason", first_case(*rejected, otherwise=F.lit(None).cast("string")))
    if same is not None:
        # rows without a hash are copies of each other too, as NULLs are one group
        copy = F.row_number().over(Window.partitionBy(*scope_by, F.col("selection_reason").isNull(), same).orderBy(*order))
        out = out.withColumn("selection_reason", F.when(F.col("selection_reason").isNull() & (copy > 1), F.lit("same_hash")).otherwise(F.col("selection_reason")))
    place = F.row_number().over(Window.partitionBy(*scope_by, F.col("selection_reason").isNull()).orderBy(*order))
    out = out.withColumn("selection_reason", F.coalesce("selection_reason", F.when(place > 1, F.lit("lower_ranked"))))
    return out.withColumn("selection_status", F.when(F.col("selection_reason").isNull(), F.lit("selected")).otherwise(F.lit("rejected")))


#: Statuses from the worst on.
SEVERITY = ("likely_wrong_company", "needs_review", "likely_valid")


def worst_per_key(df: DataFrame, by: Sequence[str], status: str, position: str) -> DataFrame:
    """One row for each key: that of the worst status, the first on a tie."""
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, SEVERITY)), F.col(status)), F.lit(0)), F.lit(99))
    return first_of(df, by, [rank, position])


def quality_bucket(status: Column, pages: Column, confidence: Column) -> Column:
    """keep, review, high priority or quarantine."""
    return first_case(
        (status == "likely_wrong_company", "quarantine"),
        (pages.isNull() | (pages < 3), "high_priority_review"),
        ((status == "needs_review") | (confidence < 0.5), "review"),
        otherwise="keep",
    )


def group_summary(df: DataFrame, by: Sequence[str], column: str, values: Sequence[str]) -> DataFrame:
    """Rows and the count of each value, in one aggregation."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *(F.count_if(F.col(column) == v).alias(v) for v in values))


def repeated_keys(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """The guard of a join's right side: keys with several rows, which must be none."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def left_join_guarded(left: DataFrame, right: DataFrame, on: Sequence[str], fallback: Sequence[str], order: Sequence[Column | str], value: str) -> DataFrame:
    """``value`` by the full key, else by the shorter one; the right side is cut to one row a key, so rows never fan out."""
    full = first_of(right, on, order).select(*on, F.col(value).alias("_full"))
    short = first_of(right, fallback, order).select(*fallback, F.col(value).alias("_short"))
    return left.join(full, list(on), "left").join(short, list(fallback), "left").withColumn(value, F.coalesce("_full", "_short")).drop("_full", "_short")


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Count and share of all of each value."""
    out = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return out.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


#: Families that a registration document holds as chapters.
CHAPTERS = ["governance_report", "remuneration_report"]


def batch_rules(rows: DataFrame, batch: Sequence[str], kind: str, status: str, family: str, is_csrd: Column) -> DataFrame:
    """Adds rejection, the first rule that takes a document out of its batch, or NULL: no type; unreadable; of a wrong company
    where another document of its type exists; a chapter where the type is the registration document; superseded where a
    statement under the newer directive exists. Rules look at their type's rows that the rules before have left.

    Whether another exists is counted for each (batch, type) and joined back, so a hot batch is no single group.
    """
    key = [*batch, kind]
    yes = lambda c: F.coalesce(c, F.lit(False))
    rows = rows.withColumns({"_csrd": yes(is_csrd), "_left": F.col(kind).isNotNull() & (F.trim(kind) != "") & ~yes(F.col(status) == "unreadable"), "_wrong": yes(F.col(status) == "likely_wrong_company")})
    right = rows.filter("_left").groupBy(*key).agg(F.bool_or(~F.col("_wrong")).alias("_right"))
    rows = rows.join(right, key, "left")
    away = F.col("_wrong") & yes(F.col("_right"))
    newer = rows.filter(F.col("_left") & ~away).groupBy(*key).agg(F.bool_or("_csrd").alias("_newer"))
    rows = rows.join(newer, key, "left")
    rejection = (
        F.when(F.coalesce(F.trim(kind), F.lit("")) == "", F.lit("needs_review"))
        .when(~F.col("_left"), F.lit("unreadable"))
        .when(away, F.lit("likely_wrong_company"))
        .when((F.col(kind) == "01_urd_annual_report") & yes(F.col(family).isin(CHAPTERS)), F.lit("integrated_in_urd"))
        .when((F.col(kind) == "02_sustainability_statement_csrd_esrs") & yes(F.col("_newer")) & ~F.col("_csrd"), F.lit("superseded_by_csrd_statement"))
    )
    return rows.withColumn("rejection", rejection).drop("_csrd", "_left", "_wrong", "_right", "_newer")


def canonical_summary(canonical: DataFrame, families: str, members: str) -> DataFrame:
    """One row: canonical documents, those of several families, duplicates folded into them, and the most in one."""
    return canonical.agg(F.count(F.lit(1)).alias("documents"), F.count_if(F.size(families) > 1).alias("multi_family"), F.coalesce(F.sum(F.col(members) - 1), F.lit(0)).alias("folded"), F.max(members).alias("most"))


def organized(rows: DataFrame, families: str, target: Column, expected: Column, found: Column) -> DataFrame:
    """The plan of a corpus: a row for each (document, family) with its place and whether it is there already: to_copy,
    present, or checksum_mismatch. Nothing is copied here."""
    status = F.when(found.isNull(), F.lit("to_copy")).when(found == expected, F.lit("present")).otherwise(F.lit("checksum_mismatch"))
    return rows.select("*", F.explode(families).alias("family")).select("*", target.alias("target"), status.alias("copy_status"))
