"""Evidence: policies, typed candidates, chunks, taxonomy, readiness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import contains_any, first_case, hash_id, short_quote
from .corpus import first_of


def eligible(evidence: DataFrame, policy: str, quote: str) -> DataFrame:
    """Evidence with a quote that no policy excludes."""
    return evidence.filter(~F.coalesce(F.col(policy).isin("exclude", "quarantine"), F.lit(False)) & (F.length(F.trim(quote)) > 0))


def with_section_policy(evidence: DataFrame, sections: DataFrame, section: str) -> DataFrame:
    """Adds the section's quality score and policy; evidence outside any section is normal with score 1."""
    s = sections.select(section, "section_score", "section_policy")
    return evidence.join(s, section, "left").withColumns({"section_score": F.coalesce("section_score", F.lit(1.0)), "section_policy": F.coalesce("section_policy", F.lit("normal"))})


def section_quality(deductions: Sequence[tuple[Column, float]], mismatch: Column) -> Column:
    """struct<score, policy>: 1 less the deductions; below 0.5 or on a mismatch quarantine, below 0.75 review."""
    score = F.greatest(F.lit(0.0), F.round(F.lit(1.0) - sum((F.when(c, F.lit(x)).otherwise(0.0) for c, x in deductions), F.lit(0.0)), 2))
    return F.struct(score.alias("score"), first_case((mismatch | (score < 0.5), "quarantine"), (score < 0.75, "review"), otherwise="normal").alias("policy"))


def typed_candidates(evidence: DataFrame, text: str, types: Mapping[str, Sequence[str]], metric: Column, carried: Sequence[str]) -> DataFrame:
    """A row for each type of information that a piece of evidence holds: a metric if there is one, and each keyword type. One pass, no join."""
    low = F.lower(F.col(text))
    made = [F.when(metric.isNotNull(), F.struct(F.lit("metric").alias("information_type"), metric["value"].alias("raw_value"), metric["unit"].alias("raw_unit")))]
    none = F.lit(None).cast("string")
    made += [F.when(contains_any(low, words), F.struct(F.lit(name).alias("information_type"), none.alias("raw_value"), none.alias("raw_unit"))) for name, words in types.items()]
    out = evidence.select(*carried, short_quote(F.col(text)).alias("quote"), F.explode(F.array_compact(F.array(*made))).alias("_c"))
    return out.select(*carried, "quote", "_c.*")


def candidate_confidence(base: Column, review: Column, quarantined: Column, good: Column) -> Column:
    """The base less 0.08 for review and 0.15 for quarantine, 0.05 more if eligible, within 0.05 and 0.6."""
    one = lambda c, x: F.when(c, F.lit(x)).otherwise(0.0)
    return F.round(F.least(F.lit(0.6), F.greatest(F.lit(0.05), base - one(review, 0.08) - one(quarantined, 0.15) + one(good, 0.05))), 2)


def chunks(parts: Sequence[tuple[str, DataFrame]], document: str, text: str, position: str) -> DataFrame:
    """The union of the builders' chunks in their order, one of each id (document, type and text)."""
    out = None
    for i, (name, df) in enumerate(parts):
        df = df.select(F.col(document).cast("string").alias("document_id"), F.lit(name).alias("chunk_type"), F.col(text).alias("chunk_text"), F.lit(i).alias("_source"), F.col(position).cast("long").alias("_pos"))
        out = df if out is None else out.unionByName(df)
    out = out.filter(F.length(F.trim("chunk_text")) > 0).withColumn("chunk_id", hash_id("chunk_", F.col("document_id"), F.col("chunk_text")))
    return first_of(out, ["chunk_id"], ["_source", "_pos", "document_id"]).drop("_source", "_pos")


def taxonomy(family: Column, text: Column, direct: Mapping[str, str], rules: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """The direct mapping of a family, else the first rule with a marker in the text, else needs_review."""
    table = F.create_map(*[F.lit(x) for kv in direct.items() for x in kv])
    return F.coalesce(F.element_at(table, family), first_case(*((contains_any(F.lower(text), words), name) for name, words in rules), otherwise="needs_review"))


def readiness(evidence: DataFrame, excluded: Column, review: Column) -> DataFrame:
    """not, partially or fully ready by the shares of excluded (0.4) and reviewed (0.1) evidence."""
    out = evidence.agg(F.count(F.lit(1)).alias("evidence"), F.count_if(excluded).alias("excluded"), F.count_if(review).alias("review"))
    share = lambda c: F.when(F.col("evidence") > 0, F.col(c) / F.col("evidence")).otherwise(1.0)
    return out.withColumn("readiness", F.when((F.col("evidence") == 0) | (share("excluded") > 0.4), F.lit("not_ready")).when((share("excluded") > 0.1) | (share("review") > 0.1), F.lit("partially_ready")).otherwise(F.lit("ready")))


def constrained_status(value: Column, unit_known: Column, structural: Column, relevance: Column, least: float = 0.1) -> Column:
    """candidate_found, needs_review or the reason of a rejection."""
    return first_case(
        (structural, "rejected_structural"),
        (relevance < least, "rejected_irrelevant"),
        (value.isNull(), "needs_review"),
        (~unit_known, "rejected_unit"),
        otherwise="candidate_found",
    )


def variable_coverage(candidates: DataFrame, variables: Sequence[str], variable: str, status: str) -> DataFrame:
    """Counts for each variable, also for those without candidates; rejected ones don't count."""
    kept = candidates.filter(~F.col(status).startswith("rejected"))
    counts = kept.groupBy(variable).agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("with_value"), F.count("unit").alias("with_unit"))
    every = candidates.sparkSession.createDataFrame([(v,) for v in variables], f"{variable} string")
    return every.join(counts, variable, "left").na.fill(0, ["n", "with_value", "with_unit"])
