"""Statistics of a stage's rows, in long form (measure or group, key, n), and findings that come from them.

Everything is partial aggregation over the stage's rows; shares divide by a total that is one row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import contains_any, first_case
from .blocks import SHORT_EVIDENCE, matching
from .medians import with_medians


def distributions(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(measure, key, n): the count of each value of each column; rows are read once and NULL is a value of its own."""
    long = rows.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns)).unpivot([], list(columns), "measure", "key")
    return long.groupBy("measure", "key").agg(F.count(F.lit(1)).alias("n"))


def of_flags(rows: DataFrame, flags: str, by: Sequence[str] = ()) -> DataFrame:
    """How many rows have each flag of an array."""
    return rows.select(*by, F.explode(F.array_distinct(flags)).alias("flag")).groupBy(*by, "flag").agg(F.count(F.lit(1)).alias("n"))


def crossed(rows: DataFrame, row: str, column: str) -> DataFrame:
    """(row, column, n): counts in two dimensions, such as modality and policy."""
    return rows.groupBy(row, column).agg(F.count(F.lit(1)).alias("n"))


def quantities(rows: DataFrame, by: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Count, mean and median of each measure for each group."""
    means = [F.round(F.avg(c), 6).alias(f"mean_{k}") for k, c in measures.items()]
    out = with_medians(rows, by, {f"median_{k}": c for k, c in measures.items()}, F.count(F.lit(1)).alias("n"), *means)
    return out.select(*by, "n", *(f"{what}_{k}" for k in measures for what in ("mean", "median")))


def evidence_figures(evidence: DataFrame) -> DataFrame:
    """One row over evidence (quote, section, blocks, policy, review_required, evidence_type)."""
    size = F.length(F.coalesce("quote", F.lit("")))
    return with_medians(
        evidence, [], {"median_quote_length": size},
        F.count(F.lit(1)).alias("evidence_count"), F.count_if(F.col("section").isNull()).alias("without_section"), F.count_if(F.col("review_required")).alias("review_required"), F.round(F.avg(size), 6).alias("average_quote_length"),
        F.count_if(size < SHORT_EVIDENCE).alias("short_evidence"), F.count_if(F.col("blocks") > 1).alias("merged_evidence"), F.count_if(F.col("policy") == "quarantine").alias("quarantined"),
        F.round(F.avg(F.when(F.col("evidence_type") == "paragraph", F.col("blocks"))), 6).alias("average_merged_blocks"),
    )


def section_density(evidence: DataFrame, document: str, section: str, most: int = 300, share: float = 0.70) -> DataFrame:
    """Evidence of each section, its share of its document to six digits, and whether it is too dense."""
    counts = evidence.filter(F.col(section).isNotNull()).groupBy(document, section).agg(F.count(F.lit(1)).alias("n"))
    totals = evidence.groupBy(document).agg(F.count(F.lit(1)).alias("_all"))
    out = counts.join(totals, document).withColumn("share", F.round(F.col("n") / F.col("_all"), 6)).drop("_all")
    return out.withColumn("is_dense", (F.col("n") > most) | (F.col("share") > share))


#: Titles that promise a certificate, and the words that its text must then have.
PROMISES = ["certification", "assurance", "report on the certification"]
KEPT = ["certification", "assurance", "auditor", "sustainability reporting", "report"]


def title_mismatches(sections: DataFrame, paragraphs: DataFrame, document: str, section: str, title: str, quote: str, order: str, first: int = 5) -> DataFrame:
    """Sections whose title promises a certificate and whose first paragraphs have none of its words; sections without paragraphs don't count."""
    w = Window.partitionBy(document, section).orderBy(order)
    asked = sections.filter(contains_any(matching(F.col(title)), PROMISES)).select(document, section, title)
    head = paragraphs.join(asked.select(document, section), [document, section], "left_semi").withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= first)
    told = head.groupBy(document, section).agg(F.bool_or(contains_any(matching(F.col(quote)), KEPT)).alias("_kept"))
    return asked.join(told, [document, section]).filter("NOT _kept").drop("_kept")


def section_policy(sections: DataFrame) -> DataFrame:
    """Adds section_score, suspicion_reasons, is_suspicious and section_policy.

    ``sections`` has section_type, page_start, page_end, confidence, evidence (count), is_front, is_mismatch and is_dense.
    """
    start, n = F.coalesce("page_start", F.lit(0)), F.coalesce("evidence", F.lit(0))
    cases = [
        (F.col("section_type") == "unknown", 0.10, "unknown_section_type"),
        (start.isin(1, 2), 0.20, "front_matter_section"),
        (F.col("is_front"), 0.25, "front_matter_section"),
        (F.col("is_mismatch"), 0.35, "title_content_mismatch"),
        (F.col("is_dense"), 0.15, "high_evidence_density"),
        ((F.coalesce("page_end", F.lit(0)) < start) | (start <= 0), 0.25, "suspicious_page_range"),
        (F.coalesce("confidence", F.lit(0.0)) < 0.60, 0.10, "weak_heading_confidence"),
        (n <= 1, 0.10, "section_too_short"),
        (n > 300, 0.10, "section_too_long"),
    ]
    hit = lambda c: F.coalesce(c, F.lit(False))
    score = F.greatest(F.lit(0.0), F.round(F.lit(1.0) - sum((F.when(hit(c), F.lit(x)).otherwise(0.0) for c, x, _ in cases), F.lit(0.0)), 6))
    reasons = F.array_distinct(F.array_compact(F.array(*(F.when(hit(c), F.lit(name)) for c, _, name in cases))))
    critical = hit(F.col("is_mismatch"))
    out = sections.withColumns({"section_score": score, "suspicion_reasons": reasons})
    s = F.col("section_score")
    return out.withColumns({"is_suspicious": (s < 0.60) | critical, "section_policy": first_case((critical | (s < 0.50), "quarantine"), (s < 0.75, "review_required"), otherwise="normal")})


def suspicious_sections(sections: DataFrame, evidence: DataFrame, document: str, section: str, quote: str, order: str, keep: int = 5) -> DataFrame:
    """Suspicious sections with how much evidence they have and their first ``keep`` quotes (a report's samples)."""
    key = [document, section]
    of = evidence.join(sections.filter("is_suspicious").select(*key), key, "left_semi")
    counts = of.groupBy(*key).agg(F.count(F.lit(1)).alias("evidence_count"))
    w = Window.partitionBy(*key).orderBy(order)
    first = of.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= keep).groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("_n", F.substring(quote, 1, 200).alias("q")))).alias("_q"))
    out = sections.filter("is_suspicious").join(counts, key, "left").join(first, key, "left")
    return out.withColumns({"evidence_count": F.coalesce("evidence_count", F.lit(0).cast("long")), "sample_quotes": F.transform(F.coalesce("_q", F.array().cast("array<struct<_n:int,q:string>>")), lambda x: x["q"])}).drop("_q")


#: Limits of a table's quality.
MOSTLY_EMPTY, HIGH_EMPTY, HIGH_FRAGMENTED, TINY = 0.80, 0.50, 0.30, 3


def table_status(tables: DataFrame, tiny: int = TINY, high_empty: float = HIGH_EMPTY, mostly_empty: float = MOSTLY_EMPTY, fragmented: float = HIGH_FRAGMENTED) -> DataFrame:
    """Adds flags, status and confidence of a table: empty, parsed or low confidence.

    ``tables`` has row_count, column_count, cells, empty_ratio, fragmented (cells), filled (cells), numeric_ratio,
    on_contents_page and on_title_page.
    """
    rows, columns, filled = F.col("row_count"), F.col("column_count"), F.col("filled")
    empty, full = filled == 0, filled > 0
    torn = F.when(full, F.col("fragmented") / filled).otherwise(0.0)
    named = {
        "all_cells_empty": empty, "single_row_table": rows < 2, "single_column_table": columns < 2, "high_empty_cells_ratio": full & (F.col("empty_ratio") > high_empty), "mostly_empty_cells": full & (F.col("empty_ratio") > mostly_empty),
        "tiny_table_artifact": F.col("cells") <= tiny, "front_matter_or_toc_table_like": F.col("on_contents_page") | F.col("on_title_page"), "fragmented_cells_detected": F.col("fragmented") > 0, "high_fragmented_cells_ratio": torn > fragmented,
        "low_numeric_density": full & (F.col("numeric_ratio") < 0.10) & (rows >= 2),
    }
    thin = named["single_row_table"] | named["single_column_table"]
    weak = sum((F.when(c, 1).otherwise(0) for c in (thin, named["high_fragmented_cells_ratio"], named["front_matter_or_toc_table_like"], named["mostly_empty_cells"])), F.lit(0))
    named["table_artifact_suspected"] = weak >= 2
    doubtful = thin | named["mostly_empty_cells"] | named["front_matter_or_toc_table_like"] | named["high_fragmented_cells_ratio"]
    status = F.when(empty, F.lit("empty_table")).when(doubtful, F.lit("low_confidence")).otherwise(F.lit("parsed"))
    confidence = F.when(status == "empty_table", 0.10).when(status == "low_confidence", 0.35).otherwise(0.70)
    flags = F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in named.items())))
    out = tables.withColumns({"table_quality_flags": flags, "extraction_status": status, "table_confidence": confidence})
    return out.withColumn("review_required", (F.col("extraction_status") != "parsed") | (F.size("table_quality_flags") > 0))


def object_evidence(objects: DataFrame, ident: str, quote: Column, flags: str, blocked: Sequence[str]) -> DataFrame:
    """Evidence of tables or figures with something to quote, but for those with a flag that blocks it."""
    kept = objects.filter(~F.arrays_overlap(flags, F.array(*map(F.lit, blocked))) & (F.length(F.trim(quote)) > 0))
    return kept.select("document_id", "page_number", F.col(ident).alias("source_element_id"), F.substring(quote, 1, 800).alias("quote"), (F.size(flags) > 0).alias("review_required"))


def inventory(document: str, **frames: tuple[DataFrame, Mapping[str, Column]]) -> DataFrame:
    """One row for each document: the counts of every artifact, 0 where it has none."""
    out, names = None, []
    for name, (df, counts) in frames.items():
        one = df.groupBy(document).agg(F.count(F.lit(1)).alias(name), *(F.count_if(c).alias(f"{name}_{k}") for k, c in counts.items()))
        names += [name, *(f"{name}_{k}" for k in counts)]
        out = one if out is None else out.join(one, document, "full")
    return out.na.fill(0, names)
