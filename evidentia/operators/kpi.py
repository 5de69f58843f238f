"""Key figures, audits and decisions over candidates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Minutes of review for a candidate of each status.
MINUTES = {"possible_indicator": 3.0, "needs_review": 1.0, "reject_candidate": 0.3}


def family_stats(df: DataFrame, family: str, document: str) -> DataFrame:
    """Rows, distinct documents and the share of all rows in percent, largest first."""
    out = df.groupBy(family).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(document).alias("documents"))
    return out.withColumn("share_pct", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 2))


def document_stats(df: DataFrame, document: str, status: str, value: str, unit: str) -> DataFrame:
    """Counts by status, what is missing, the minutes that review takes, and a bucket of burden."""
    of = lambda s: F.count_if(F.col(status) == s)
    out = df.groupBy(document).agg(F.count(F.lit(1)).alias("candidates"), *(of(s).alias(s) for s in MINUTES), F.count_if(F.col(value).isNull()).alias("without_value"), F.count_if(F.col(unit).isNull()).alias("without_unit"))
    minutes = sum((F.col(s) * m for s, m in MINUTES.items()), F.lit(0.0))
    out = out.withColumn("minutes", F.round(minutes, 1))
    return out.withColumn("burden", F.when(F.col("minutes") < 30, F.lit("low")).when(F.col("minutes") < 90, F.lit("medium")).when(F.col("minutes") < 240, F.lit("high")).otherwise(F.lit("excessive")))


def rates(df: DataFrame, cases: Mapping[str, Column]) -> DataFrame:
    """One row: the count and the percentage of each case, 0 where there are no rows."""
    counts = df.agg(F.count(F.lit(1)).alias("rows"), *(F.count_if(c).alias(f"n_{k}") for k, c in cases.items()))
    return counts.select("rows", *(f"n_{k}" for k in cases), *(F.round(F.when(F.col("rows") > 0, F.col(f"n_{k}") * 100.0 / F.col("rows")).otherwise(0.0), 4).alias(f"pct_{k}") for k in cases))


def figures(candidates: DataFrame, risks: DataFrame, runs: DataFrame) -> DataFrame:
    """The 23 key figures of a production run, in one row; a rate without anything to divide by is 0.

    ``candidates`` has document_id, validation_status, indicator_family, raw_value, raw_unit and quote; ``risks`` has
    risk_level for each likely false positive; ``runs`` has status (selected, success or failed) for each document.
    """
    status = lambda s: F.count_if(F.col("validation_status") == s)
    empty = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")) == ""
    quoted = F.coalesce(F.length(F.trim("quote")), F.lit(0)) >= 10
    per_document = candidates.groupBy("document_id").agg(
        F.count(F.lit(1)).alias("n"), *(status(s).alias(s) for s in MINUTES), F.count_if(empty("raw_value")).alias("no_value"), F.count_if(empty("raw_unit")).alias("no_unit"),
        F.count_if(~quoted).alias("no_quote"), F.count_if(F.col("indicator_family").isin("unknown", "boundary")).alias("noisy"), F.count_if(~empty("raw_value") & quoted).alias("covered"),
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    # from here on every frame is one row
    sums = per_document.agg(*(total(c).alias(c) for c in per_document.columns[1:]), F.count("document_id").alias("documents"), F.coalesce(F.max("n"), F.lit(0)).alias("most"))
    of_risks = risks.agg(F.count(F.lit(1)).alias("risks"), F.count_if(F.col("risk_level") == "high").alias("high"))
    of_runs = runs.agg(F.count(F.lit(1)).alias("selected"), F.count_if(F.col("status").isin("success", "failed")).alias("processed"), F.count_if(F.col("status") == "success").alias("success"), F.count_if(F.col("status") == "failed").alias("failed"))
    one = sums.crossJoin(of_risks).crossJoin(of_runs)
    pct = lambda a, b="n": F.when(F.col(b) > 0, F.col(a) * 100.0 / F.col(b)).otherwise(0.0)
    return one.select(
        F.col("selected").alias("documents_selected"), F.col("processed").alias("documents_processed"), F.col("success").alias("documents_success"), F.col("failed").alias("documents_failed"), pct("success", "processed").alias("documents_success_rate"),
        F.col("n").alias("candidate_count_total"), *(F.col(s).alias(f"{s}_count") for s in MINUTES), *(pct(s).alias(f"{s}_rate") for s in MINUTES),
        pct("no_value").alias("missing_value_rate"), pct("no_unit").alias("missing_unit_rate"), pct("no_quote").alias("missing_quote_rate"), pct("noisy").alias("unknown_boundary_rate"),
        F.col("risks").alias("false_positive_count"), pct("risks").alias("false_positive_risk_rate"), pct("high").alias("high_risk_rate"),
        (sum((F.col(s) * m for s, m in MINUTES.items()), F.lit(0.0)) / 60).alias("review_burden_hours"),
        F.when(F.col("documents") > 0, F.col("n") / F.col("documents")).otherwise(0.0).alias("average_candidates_per_document"), F.col("most").alias("max_candidates_per_document"), pct("covered").alias("evidence_coverage_rate"),
    )


def review_progress(workspace: DataFrame, decisions: DataFrame, key: str, decision: str) -> DataFrame:
    """total, decided, accepted, rejected, more_evidence over the rows of a workspace; the last word on a row counts."""
    last = decisions.groupBy(key).agg(F.max_by(decision, "pos").alias("_said"))
    rows = workspace.join(last, key, "left")
    said = lambda d: F.count_if(F.col("_said") == d)
    return rows.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.length(F.trim("_said")) > 0).alias("decided"), said("accept_candidate").alias("accepted"), said("reject_candidate").alias("rejected"), said("needs_more_evidence").alias("more_evidence"))


def top_counts(df: DataFrame, column: str, k: int = 20) -> DataFrame:
    """The k most frequent values with their counts, in the values' own order: a report."""
    best = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column).limit(k)
    return best.orderBy(column)


def presence_matrix(wide: DataFrame, ids: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """1 where a cell of the wide table has a value, else 0; rows are named by their ids."""
    return wide.select(F.concat_ws(" · ", *(F.col(c).cast("string") for c in ids)).alias("row"), *(F.col(c).isNotNull().cast("int").alias(c) for c in columns))


def success_counts(results: DataFrame, by: str, ok: Column) -> DataFrame:
    """tried and succeeded for each retriever, with the rate to four digits."""
    out = results.groupBy(by).agg(F.count(F.lit(1)).alias("tried"), F.count_if(ok).alias("succeeded"))
    return out.withColumn("rate", F.round(F.col("succeeded") / F.col("tried"), 4))


def input_inventory(sources: DataFrame, by: Sequence[str], path: str, document: str, rows: str) -> DataFrame:
    """The sources of each group as one sorted text, its documents counted, and whether all its inputs are empty."""
    return sources.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_set(path)), "|").alias("sources"), F.count_distinct(document).alias("documents"), F.bool_and(F.coalesce(rows, F.lit(0)) == 0).alias("all_empty"))


def go_decision(missing_value: Column, wrong: Column, coverage: Column) -> Column:
    return F.when((missing_value > 50) | (wrong > 20), F.lit("NO_GO")).when((missing_value > 30) | (coverage < 60), F.lit("GO_WITH_FIXES")).otherwise(F.lit("GO"))


def top_per_group_then_all(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], per_group: int, overall: int) -> DataFrame:
    """At most ``per_group`` rows of each group, then the first ``overall`` of all: a report."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") <= per_group).drop("_place").orderBy(*order).limit(overall)


def recall(truth: DataFrame, found: DataFrame, on: Sequence[str], value: str) -> DataFrame:
    """Expected, found, found with a value, and their shares to four digits. ``found`` is cut to a row a key first."""
    per_key = found.groupBy(*on).agg(F.max(F.col(value).isNotNull()).alias("_value"))
    out = truth.join(per_key, list(on), "left").agg(F.count(F.lit(1)).alias("expected"), F.count_if(F.col("_value").isNotNull()).alias("found"), F.count_if(F.col("_value")).alias("with_value"))
    share = lambda c: F.round(F.when(F.col("expected") > 0, F.col(c) / F.col("expected")).otherwise(0.0), 4)
    return out.withColumns({"recall": share("found"), "value_recall": share("with_value")})


def missed(truth: DataFrame, found: DataFrame, on: Sequence[str]) -> DataFrame:
    return truth.join(found.select(*on), list(on), "left_anti")


def checks(df: DataFrame, cases: Mapping[str, tuple[Column, str]]) -> DataFrame:
    """(check, severity, n, status): one aggregation counts all violations, and then becomes rows."""
    counts = df.agg(*(F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, (c, _) in cases.items())).unpivot([], list(cases), "check", "n")
    severity = F.create_map(*[F.lit(x) for k, (_, s) in cases.items() for x in (k, s)])
    return counts.withColumn("severity", F.element_at(severity, F.col("check"))).withColumn("status", F.when(F.col("n") == 0, F.lit("pass")).otherwise(F.lit("fail")))


def presence(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(by, field, present, empty) for each column."""
    counts = df.groupBy(*by).agg(*(F.count_if(F.length(F.trim(F.col(c).cast("string"))) > 0).alias(c) for c in columns), F.count(F.lit(1)).alias("_rows"))
    out = counts.unpivot([*by, "_rows"], list(columns), "field", "present")
    return out.withColumn("empty", F.col("_rows") - F.col("present")).drop("_rows")


def orphans(links: DataFrame, parents: DataFrame, child: str, parent: str) -> DataFrame:
    """Links whose parent doesn't exist."""
    return links.join(parents.select(F.col(parent).alias(child)), child, "left_anti")


def multi_document(df: DataFrame, document: str, measures: Sequence[Column]) -> DataFrame:
    """The measures of each document, and of all of them where it is NULL."""
    return df.rollup(document).agg(*measures)


def heat(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    return df.groupBy(row).pivot(column, list(values)).count().na.fill(0)
