"""The candidate path: union of engines, duplicates, consensus, validation, review."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import first_case, key_text, missing, reasons
from .corpus import first_of
from .similarity import similar_components  # noqa: F401  part of this module's interface

#: The order in which engines are trusted, and how far agreement can raise a confidence.
ENGINES = ("table", "csv", "visual")
CONFIDENCE_CAP = {"table": 0.6, "csv": 0.6, "visual": 0.5}
CONSENSUS_STEP = 0.05


def engine_rank(c: Column) -> Column:
    return F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, ENGINES)), c), F.lit(0)), F.lit(9))


def union_engines(parts: Mapping[str, DataFrame], renames: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """UNION ALL of the engines' candidates under common names, with the engine's name; absent columns are NULL."""
    out = None
    for engine, df in parts.items():
        df = df.withColumnsRenamed(dict(renames.get(engine, {}))).withColumn("source_engine", F.lit(engine))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def backfill_scope(df: DataFrame, document: str = "document_id", position: str = "pos") -> DataFrame:
    """Fills company and fiscal_year, where company is blank, from the document's first complete row by engine and order."""
    complete = missing(F.col("company")).isNotNull() & missing(F.col("fiscal_year")).isNotNull()
    best = F.min_by(F.struct("company", "fiscal_year"), F.struct(engine_rank(F.col("source_engine")), position))
    known = df.filter(complete).groupBy(document).agg(best.alias("_known"))
    blank = missing(F.col("company")).isNull() & F.col("_known").isNotNull()
    out = df.join(known, document, "left")
    return out.withColumns({c: F.when(blank, F.col(f"_known.{c}")).otherwise(F.col(c)) for c in ("company", "fiscal_year")}).drop("_known")


def consolidation_key(document: Column, kind: Column, page: Column, value: Column, quote: Column, label: Column) -> Column:
    """Document, type, page, value and the first 160 characters of the quote, or else of the label."""
    said = F.coalesce(missing(F.substring(key_text(quote), 1, 160)), F.substring(key_text(label), 1, 160))
    return F.concat_ws("|", *(key_text(c.cast("string")) for c in (document, kind, page, value)), said)


def mark_duplicates(df: DataFrame, key: str, order: Sequence[Column | str], position: str, ident: str) -> DataFrame:
    """Adds deduplication_status (unique_candidate, canonical, duplicate), canonical_candidate_id, group_size and the
    number of distinct engines. A group's facts come from one partial aggregation; no row meets another."""
    sort = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order], F.col(position))
    facts = df.groupBy(key).agg(F.count(F.lit(1)).alias("group_size"), F.min_by(ident, sort).alias("_best"), F.min(position).alias("first_pos"), F.count_distinct("source_engine").alias("engines"))
    out = df.join(facts, key)
    status = F.when(F.col("group_size") == 1, F.lit("unique_candidate")).when(F.col(ident) == F.col("_best"), F.lit("canonical")).otherwise(F.lit("duplicate"))
    return out.withColumn("deduplication_status", status).withColumnRenamed("_best", "canonical_candidate_id")


def consensus_boost(df: DataFrame, confidence: str = "confidence") -> DataFrame:
    """Raises a canonical row's confidence by 0.05 for each further row of its group if several engines agree, up to its engine's cap."""
    cap = F.create_map(*[F.lit(x) for kv in CONFIDENCE_CAP.items() for x in kv])
    raised = F.round(F.least(F.col(confidence) + CONSENSUS_STEP * (F.col("group_size") - 1), F.element_at(cap, F.col("source_engine"))), 3)
    return df.withColumn(confidence, F.when((F.col("deduplication_status") == "canonical") & (F.col("engines") > 1), F.greatest(raised, F.col(confidence))).otherwise(F.col(confidence)))


def validation_status(forbidden: Column, review: Column, status: Column, quote: Column, traced: Column, page: Column, value: Column) -> Column:
    """The first reason to reject or to look again, else a possible indicator."""
    return first_case(
        (forbidden, "reject_candidate"),
        (F.coalesce(status.isin("rejected", "excluded"), F.lit(False)), "reject_candidate"),
        (F.coalesce(F.length(F.trim(quote)), F.lit(0)) == 0, "reject_candidate"),
        (~traced, "needs_review"),
        (page.isNull(), "needs_review"),
        (review, "needs_review"),
        (missing(value).isNotNull(), "possible_indicator"),
        otherwise="qualitative_evidence",
    )


def forbidden_signal(columns: Sequence[Column]) -> Column:
    """Whether any column holds a score as text."""
    return F.exists(F.array(*(F.coalesce(c.cast("string"), F.lit("")) for c in columns)), lambda x: x.rlike(r"(?i)\bscore\s*=\s*\d"))


def by_confidence(status: Column, confidence: Column, accept: float = 0.30, reject: float = 0.20) -> Column:
    """Accepts and rejects by confidence; a reject stays one."""
    return F.when((status == "reject_candidate") | (confidence < reject), F.lit("reject_candidate")).when((status == "needs_review") & (confidence >= accept), F.lit("possible_indicator")).otherwise(status)


def reject_duplicates(df: DataFrame, key: Sequence[str], order: Sequence[Column | str], status: str) -> DataFrame:
    """All but the first row of a key are rejected."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("is_duplicate", place > 1).withColumn(status, F.when(F.col("is_duplicate"), F.lit("reject_candidate")).otherwise(F.col(status)))


def review_priority(status: Column, value: Column, confidence: Column) -> Column:
    return first_case(((status == "possible_indicator") & missing(value).isNotNull(), "high"), ((status == "needs_review") | (confidence >= 0.4), "medium"), otherwise="low")


def priority_rank(priority: Column) -> Column:
    return F.array_position(F.array(F.lit("high"), F.lit("medium"), F.lit("low")), priority)


#: What a reviewer's decision makes of a row.
DECISIONS = {"accept_candidate": "accepted", "reject_candidate": "rejected", "needs_more_evidence": "needs_more_evidence", "defer_decision": "deferred"}


def apply_decisions(workspace: DataFrame, decisions: DataFrame, ident: str, decision: str, position: str) -> DataFrame:
    """The last decision of each item, joined to the workspace; no decision is pending, an unknown one invalid."""
    last = first_of(decisions, [ident], [F.desc(position)]).select(ident, decision)
    table = F.create_map(*[F.lit(x) for kv in DECISIONS.items() for x in kv])
    status = F.when(missing(F.col(decision)).isNull(), F.lit("pending")).otherwise(F.coalesce(F.element_at(table, F.col(decision)), F.lit("invalid_decision")))
    return workspace.join(last, ident, "left").withColumn("review_status", status)


def prefer_corrected(corrected: Column, normalized: Column, raw: Column) -> Column:
    """struct<value, source>: the first that isn't blank."""
    c, n, r = missing(corrected), missing(normalized), missing(raw)
    source = F.when(c.isNotNull(), F.lit("corrected_value")).when(n.isNotNull(), F.lit("normalized_value")).when(r.isNotNull(), F.lit("raw_value")).otherwise(F.lit("missing"))
    return F.struct(F.coalesce(c, n, r).alias("value"), source.alias("source"))


def preparation_quality(value: Column, unit: Column, year: Column, evidence: Column) -> Column:
    flags = reasons((missing(value).isNull(), "missing_value"), (missing(unit).isNull(), "missing_unit"), (missing(year).isNull(), "missing_year"), (missing(evidence).isNull(), "missing_evidence"), joint="|")
    return F.coalesce(flags, F.lit("complete"))


def false_positive_risk(cases: Sequence[tuple[Column, str]]) -> Column:
    """struct<reasons, risk>: high from two reasons on, medium for one."""
    names = reasons(*cases, joint="|")
    n = F.when(names.isNull(), 0).otherwise(F.size(F.split(names, r"\|")))
    return F.struct(names.alias("reasons"), F.when(n >= 2, F.lit("high")).when(n == 1, F.lit("medium")).otherwise(F.lit("low")).alias("risk"))
