"""Audits: tables of named rules over the rows of a stage, counted in one aggregation, with samples of the rows they hit.

A rule is (condition, level). Levels: ``info`` counts, ``warning`` and ``error`` find fault. A finding's severity is its
level if rows were hit, else info; its status is pass if a faulting rule hit none, else needs_review. Blank and NULL are
the same. Each function takes a DataFrame with the stage's columns and gives the stage's rules; :func:`audit` counts them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import missing

Rules = Mapping[str, tuple[Column, str]]


def blank(name: str) -> Column:
    return missing(F.col(name).cast("string")).isNull()


def filled(name: str) -> Column:
    return ~blank(name)


def isnt(name: str, value: str) -> Column:
    """Another value, or none; case doesn't matter, so that a flag may be a boolean or a text."""
    return ~F.lower(F.col(name).cast("string")).eqNullSafe(F.lit(value.lower()))


def repeated(*names: str) -> Column:
    """Rows whose key is not theirs alone."""
    return F.count(F.lit(1)).over(Window.partitionBy(*names)) > 1


def columns_like(columns: Sequence[str], token: str, but: Sequence[str] = ()) -> int:
    return sum(token in c.lower() and c not in but for c in columns)


def audit(rows: DataFrame, rules: Rules, constants: Mapping[str, tuple[int, str]] | None = None) -> DataFrame:
    """check_name, n, severity, status of every rule; ``constants`` are counts that don't come from rows, such as of columns."""
    marked = rows.select(*(F.coalesce(c, F.lit(False)).alias(k) for k, (c, _) in rules.items()))
    out = marked.agg(*(F.count_if(F.col(k)).alias(k) for k in rules), *(F.lit(n).cast("long").alias(k) for k, (n, _) in (constants or {}).items()))
    levels = {k: v[1] for k, v in {**rules, **(constants or {})}.items()}
    level = F.element_at(F.create_map(*[F.lit(x) for kv in levels.items() for x in kv]), F.col("check_name"))
    found = out.unpivot([], list(levels), "check_name", "n").withColumn("_level", level)
    severity = F.when(F.col("n") > 0, F.col("_level")).otherwise(F.lit("info"))
    status = F.when((F.col("n") == 0) & (F.col("_level") != "info"), F.lit("pass")).otherwise(F.lit("needs_review"))
    return found.select("check_name", "n", severity.alias("severity"), status.alias("status"))


def audit_samples(rows: DataFrame, rules: Rules, carried: Sequence[str], order: Sequence[str], keep: int = 5) -> DataFrame:
    """The first ``keep`` rows of every rule. A report: at most rules x keep rows."""
    hit = F.array_compact(F.array(*(F.when(F.coalesce(F.col(f"_{k}"), F.lit(False)), F.lit(k)) for k in rules)))
    marked = rows.select("*", *(c.alias(f"_{k}") for k, (c, _) in rules.items())).select(*dict.fromkeys([*carried, *order]), F.explode(hit).alias("check_name"))
    place = F.row_number().over(Window.partitionBy("check_name").orderBy(*order))
    return marked.withColumn("sample", place).filter(F.col("sample") <= keep).select("check_name", "sample", *carried)


def summary(findings: DataFrame) -> DataFrame:
    """findings, errors, warnings."""
    return findings.agg(F.count(F.lit(1)).alias("findings"), F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))


def with_membership(rows: DataFrame, others: DataFrame, key: str, name: str) -> DataFrame:
    """Adds whether the key is among ``others``."""
    known = others.select(key).distinct().withColumn(name, F.lit(True))
    return rows.join(known, key, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def database_rules() -> Rules:
    """Preparation records; ``has_link`` and ``has_lineage`` come from :func:`with_membership`."""
    quality = lambda word: F.col("preparation_quality_status").contains(word)
    return {
        "preparation_indicators_count": (F.lit(True), "info"),
        "preparation_only_count": (F.col("indicator_database_status") == "preparation_only", "info"),
        "final_indicator_detected_count": (isnt("is_final_indicator", "False"), "error"),
        "score_detected_count": (isnt("score_produced", "False"), "error"),
        "records_without_candidate_id_count": (blank("candidate_id"), "error"),
        "records_without_document_id_count": (blank("document_id"), "error"),
        "records_without_quote_count": (blank("quote"), "warning"),
        "records_without_page_count": (blank("page_number"), "warning"),
        "records_without_evidence_link_count": (~F.col("has_link"), "warning"),
        "records_without_lineage_count": (~F.col("has_lineage"), "warning"),
        "records_with_corrected_values_count": ((F.col("value_source") == "corrected_value") | (F.col("unit_source") == "corrected_unit") | (F.col("year_source") == "corrected_year"), "warning"),
        "records_with_unknown_domain_count": (F.col("indicator_domain") == "unknown", "warning"),
        "records_with_unknown_topic_count": (F.col("indicator_topic") == "unknown", "warning"),
        "records_needing_value_review_count": (quality("needs_value_review"), "warning"),
        "records_needing_unit_review_count": (quality("needs_unit_review"), "warning"),
        "records_needing_year_review_count": (quality("needs_year_review"), "warning"),
    }


def database_contract() -> Rules:
    """What every preparation record must satisfy."""
    return {
        "status_must_be_preparation_only": (isnt("indicator_database_status", "preparation_only"), "error"),
        "is_final_indicator_must_be_false": (isnt("is_final_indicator", "False"), "error"),
        "score_produced_must_be_false": (isnt("score_produced", "False"), "error"),
        "missing_evidence_link": (~F.col("has_link"), "error"),
        "missing_lineage": (~F.col("has_lineage"), "error"),
    }


def validation_rules() -> Rules:
    """Prevalidated candidates."""
    possible = F.col("validation_status") == "possible_indicator"
    return {
        "validation_records_count": (F.lit(True), "info"),
        "possible_indicators_count": (possible, "info"),
        "rejected_candidates_count": (F.col("validation_status") == "reject_candidate", "info"),
        "needs_review_count": (F.col("validation_status") == "needs_review", "info"),
        "validated_indicators_count": (isnt("is_validated_indicator", "False"), "error"),
        "score_produced_count": (isnt("score_produced", "False"), "error"),
        "records_without_quote_count": (blank("quote"), "warning"),
        "records_without_source_count": (blank("evidence_id") & blank("table_id") & blank("figure_id"), "warning"),
        "records_without_page_count": (blank("page_number"), "warning"),
        "possible_indicator_without_value_count": (possible & blank("normalized_value"), "warning"),
        "possible_indicator_without_unit_count": (possible & blank("normalized_unit"), "warning"),
        "possible_indicator_without_year_count": (possible & blank("normalized_year"), "warning"),
        "duplicate_candidates_count": (F.col("duplicate_status") == "duplicate_candidate", "warning"),
        "unknown_indicator_family": (F.col("indicator_family") == "unknown", "warning"),
    }


def review_rules() -> Rules:
    """Reviewed rows."""
    status = lambda s: F.col("review_status") == s
    corrected = filled("corrected_value") | filled("corrected_unit") | filled("corrected_year")
    return {
        "review_items_count": (F.lit(True), "info"),
        "decisions_count": (filled("proposed_decision"), "info"),
        "accepted_candidates_count": (status("accepted_candidate"), "info"),
        "rejected_candidates_count": (status("rejected_by_reviewer"), "info"),
        "needs_more_evidence_count": (status("needs_more_evidence"), "info"),
        "deferred_candidates_count": (status("decision_deferred"), "info"),
        "missing_decision_count": (status("missing_decision"), "warning"),
        "invalid_decision_count": (status("invalid_decision"), "error"),
        "accepted_without_reviewer_count": (status("accepted_candidate") & blank("reviewer"), "warning"),
        "accepted_without_reason_count": (status("accepted_candidate") & blank("decision_reason"), "warning"),
        "corrected_value_count": (filled("corrected_value"), "info"),
        "corrected_unit_count": (filled("corrected_unit"), "info"),
        "corrected_year_count": (filled("corrected_year"), "info"),
        "validated_indicator_detected_count": (isnt("validated_indicator", "False"), "error"),
        "score_detected_count": (isnt("score_produced", "False"), "error"),
        "missing_traceability": (blank("candidate_id") | blank("document_id") | blank("page_number") | blank("quote"), "error"),
        "correction_without_reason": (corrected & blank("decision_reason"), "warning"),
    }


#: Types of information that the text engine gives.
TEXT_TYPES = ["observed_metric", "target", "policy_or_commitment", "risk_statement", "boundary_context", "methodology_context", "visual_evidence"]


def consolidated_rules() -> Rules:
    """The union of the engines' candidates, each of which gives types of its own; any other engine is a mismatch."""
    engine, kind = F.col("source_engine"), F.coalesce("information_type", F.lit(""))
    fits = F.when(engine == "table", kind == "table_metric_candidate").when(engine == "visual", kind.startswith("visual_")).when(engine == "csv", kind.isin(TEXT_TYPES)).otherwise(F.lit(False))
    too_sure = F.when(engine == "visual", F.col("confidence") > 0.5).otherwise(F.col("confidence") > 0.6)
    return {
        "review_required_missing_or_false": (isnt("review_required", "True"), "error"),
        "extraction_status_not_candidate_only": (isnt("extraction_status", "candidate_only"), "error"),
        "confidence_above_allowed_threshold": (too_sure, "error"),
        "probable_duplicates": (repeated("document_id", "information_type", "raw_value", "page_number", "quote"), "warning"),
        "deduplicated_duplicate_candidates": (F.col("deduplication_status") == "duplicate_candidate", "warning"),
        "source_engine_information_type_mismatch": (~fits, "warning"),
        "candidates_without_source": (blank("evidence_id") & blank("table_id") & blank("figure_id"), "warning"),
        "candidates_without_quote": (blank("quote"), "warning"),
    }


def text_rules() -> Rules:
    """Candidates of the text engine."""
    kind = lambda k: F.col("information_type") == k
    return {
        "candidates_without_quote": (blank("quote"), "error"),
        "observed_metric_without_value": (kind("observed_metric") & blank("raw_value"), "warning"),
        "observed_metric_without_unit": (kind("observed_metric") & blank("raw_unit"), "warning"),
        "target_without_target_year": (kind("target") & blank("target_year"), "warning"),
        "visual_evidence_low_confidence": (kind("visual_evidence") & (F.coalesce("confidence", F.lit(0.0)) < 0.25), "warning"),
        "confidence_above_0_6": (F.col("confidence") > 0.6, "error"),
        "review_required_missing_or_false": (isnt("review_required", "True"), "error"),
        "duplicate_evidence_type_label": (repeated("evidence_id", "information_type", "label"), "warning"),
    }


def table_rules() -> Rules:
    """Candidates of the table engine."""
    digits = F.regexp_replace("raw_value", "[, .]", "")
    return {
        "candidates_without_unit": (blank("raw_unit"), "warning"),
        "candidates_without_year": (blank("reported_year"), "warning"),
        "candidates_with_inferred_year": (F.lower(F.col("inferred_year").cast("string")).isin("true", "1"), "warning"),
        "candidates_from_low_confidence_tables": (F.col("validation_notes").contains("low_confidence_table"), "warning"),
        "duplicate_candidates": (repeated("table_id", "cell_id", "metric_key"), "warning"),
        "raw_value_not_numeric": (~F.coalesce(digits, F.lit("")).rlike(r"^\d+$"), "warning"),
        "confidence_above_0_6": (F.col("confidence") > 0.6, "error"),
        "review_required_missing_or_false": (isnt("review_required", "True"), "error"),
        "extraction_status_not_candidate_only": (isnt("extraction_status", "candidate_only"), "error"),
    }


#: Types that a visual may have.
VISUAL_TYPES = ["logo_or_cover", "illustrative_photo", "chart", "scanned_table", "diagram", "org_chart", "map", "unknown_visual"]


def visual_rules() -> Rules:
    """Candidates of the visual engine, with their crop, OCR and class."""
    no_words = blank("ocr_text")
    return {
        "crops_not_created": (F.col("crop_status").isin("missing_source_pdf", "failed"), "warning"),
        "crops_with_warnings": (filled("visual_warning"), "warning"),
        "ocr_unavailable_or_failed": (F.col("ocr_status").isin("ocr_unavailable", "ocr_failed"), "warning"),
        "candidates_without_source_image_path": (blank("source_image_path"), "error"),
        "candidates_without_figure_id": (blank("figure_id"), "error"),
        "confidence_above_0_5": (F.col("confidence") > 0.5, "error"),
        "review_required_missing_or_false": (isnt("review_required", "True"), "error"),
        "visual_type_unknown": (F.col("visual_type") == "unknown_visual", "warning"),
        "raw_value_without_unit": (filled("raw_value") & blank("raw_unit"), "warning"),
        "chart_candidate_without_ocr_text": ((F.col("visual_type") == "chart") & no_words, "warning"),
        "scanned_table_candidate_without_ocr_text": ((F.col("visual_type") == "scanned_table") & no_words, "warning"),
        "invalid_visual_type": (~F.coalesce(F.col("visual_type").isin(VISUAL_TYPES), F.lit(False)), "error"),
    }


#: ISO standard numbers, which are no measured values.
ISO_NUMBERS = ["9001", "14001", "14004", "14006", "14025", "14031", "14040", "14044", "14046", "14064", "14067", "14068", "20121", "20400", "26000", "37001", "45001", "50001", "55001"]

def iso_number(text: Column) -> Column:
    """A number with ISO before it, or one of the standards' bare numbers."""
    t = F.trim(text)
    return t.rlike(r"^(?i:iso)\s*\d{4,5}$") | t.isin(ISO_NUMBERS)


#: Statuses of targeted candidates.
TARGETED_STATUSES = ["candidate_found", "needs_review", "rejected_structural_noise", "rejected_unit_mismatch", "rejected_no_value", "rejected_no_evidence", "rejected_low_relevance"]


def targeted_errors(statuses: Sequence[str] = TARGETED_STATUSES) -> Rules:
    """The contract of targeted candidates, row by row."""
    status = F.col("candidate_status")
    return {
        "document_id_empty": (blank("document_id"), "error"),
        "company_empty": (blank("company"), "error"),
        "fiscal_year_empty": (blank("fiscal_year"), "error"),
        "invalid_candidate_status": (~F.coalesce(status.isin(list(statuses)), F.lit(False)), "error"),
        "quote_empty": (status.isin("candidate_found", "needs_review") & blank("quote"), "error"),
        "raw_value_empty": ((status == "candidate_found") & blank("raw_value"), "error"),
        "raw_value_is_iso_number": (iso_number(F.col("raw_value")), "error"),
    }


def dataset_rules() -> Rules:
    """The long table of selected values; ``has_evidence`` comes from the key's membership in the evidence."""
    status = lambda s: F.col("value_status") == s
    said = F.lower(F.concat_ws(" ", "variable_name", "value", "unit", "quote"))
    return {
        "found_without_evidence": (status("found") & ~F.col("has_evidence"), "error"),
        "missing_variable": (status("missing_from_corpus"), "warning"),
        "needs_review_variable": (status("needs_review"), "warning"),
        "qualitative_only_variable": (status("qualitative_only"), "warning"),
        "conflicting_values": (status("conflicting_values"), "major"),
        "unit_missing": (status("found") & blank("unit"), "warning"),
        "score_detected": (F.lower(F.concat_ws(" ", "value", "variable_name")).contains("score"), "error"),
        "external_source_detected": (said.contains("external_source") | said.contains("http://") | said.contains("https://"), "error"),
        "final_indicator_claim_detected": (said.contains("final_indicator"), "error"),
    }


#: Statuses of a cell of the variable dataset.
VALUE_STATUSES = ["found", "missing_from_corpus", "needs_review", "qualitative_only", "conflicting_values", "not_disclosed"]


def dataset_contract(long: DataFrame, evidence: DataFrame, expected: Sequence[str], wide_columns: Sequence[str]) -> DataFrame:
    """check_name, n, severity, status: columns missing or forbidden in the wide table, and rows of the long one that break it."""
    keys = ["company", "year", "variable_name"]
    known = evidence.select(*keys).distinct().withColumn("has_evidence", F.lit(True))
    rows = long.join(known, keys, "left").withColumn("has_evidence", F.coalesce("has_evidence", F.lit(False)))
    said = F.lower(F.concat_ws(" ", *rows.drop("has_evidence").columns))
    rules = {
        "duplicate_cell": (repeated(*keys), "error"),
        "invalid_status": (~F.coalesce(F.col("value_status").isin(VALUE_STATUSES), F.lit(False)), "error"),
        "found_without_evidence": ((F.col("value_status") == "found") & ~F.col("has_evidence"), "error"),
        "external_source_detected": (said.contains("http://") | said.contains("https://") | said.contains("external_source"), "error"),
    }
    absent = sum(c not in wide_columns for c in ("company", "year", *expected))
    return audit(rows, rules, {"missing_column": (absent, "error"), "score_column_detected": (columns_like(wide_columns, "score"), "error")})


def row_errors(rows: DataFrame, rules: Rules, name: str = "errors") -> DataFrame:
    """Adds the names of the rules that each row breaks, and whether it breaks none."""
    broken = F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(k)) for k, (c, _) in rules.items())))
    return rows.withColumn(name, broken).withColumn("is_valid", F.size(name) == 0)


def reconciled(counts: Mapping[str, tuple[DataFrame, DataFrame, str]]) -> DataFrame:
    """check_name, expected, found, status: of each pair of frames, how many distinct keys each has, for counts that must agree."""
    out = None
    for name, (left, right, key) in counts.items():
        one = left.agg(F.count_distinct(key).alias("expected")).crossJoin(right.agg(F.count_distinct(key).alias("found")))  # a row each
        one = one.select(F.lit(name).alias("check_name"), "expected", "found", F.when(F.col("expected") == F.col("found"), F.lit("pass")).otherwise(F.lit("fail")).alias("status"))
        out = one if out is None else out.unionByName(one)
    return out


def run_coverage(tasks: DataFrame, manifests: DataFrame, files: DataFrame, on: Sequence[str], path: str) -> DataFrame:
    """Audit of a run: each task with whether it has a manifest, whether the manifest's file exists, and whether its path names the task's keys."""
    known = manifests.groupBy(*on).agg(F.min(path).alias(path), F.count(F.lit(1)).alias("manifests"))
    there = files.select(path).distinct().withColumn("_there", F.lit(True))
    out = tasks.join(known, list(on), "left").join(there, path, "left")
    named = F.forall(F.array(*(F.col(c).cast("string") for c in on)), lambda k: F.col(path).contains(k))
    state = (
        F.when(F.col(path).isNull(), F.lit("no_manifest"))
        .when(F.col("_there").isNull(), F.lit("file_missing"))
        .when(~named, F.lit("path_inconsistent"))
        .otherwise(F.lit("ok"))
    )
    return out.select(*tasks.columns, F.coalesce("manifests", F.lit(0).cast("long")).alias("manifests"), state.alias("state"))


def generic_checks(least_characters: int = 50, least_confidence: float = 0.5) -> Rules:
    """Pages and evidence of any document."""
    return {
        "file_path_missing": (blank("path"), "error"),
        "fiscal_year_inconsistent": (~F.col("fiscal_year").eqNullSafe(F.col("document_year")), "error"),
        "empty_text": (F.coalesce(F.length("text"), F.lit(0)) < least_characters, "warning"),
        "missing_evidence": (blank("evidence_id"), "error"),
        "low_confidence": (F.coalesce("confidence", F.lit(0.0)) < least_confidence, "warning"),
    }


#: Words of units that a family can't have, and of labels that are notes.
UNLIKELY_UNITS = {"ghg_emissions": ["hours", " h", "year", "days", "eur", "usd", "m2"], "energy": ["year", "days", "tco2", "co2"], "water": ["mwh", "kwh", "gwh", "tco2", "eur", "usd"], "waste": ["mwh", "kwh", "gwh", "tco2", "eur", "usd"]}
NOTE_LABELS = ["footnote", "refer to glossary", "see note", "see footnote", "refer to note", "note:", "page reference"]

#: Words by which a reviewer agrees. An underscore is part of a word, so accept_candidate is none of them.
AGREES = r"(?i)\b(?:accept|approve[ds]?|valid(?:at(?:e[ds]?|ion))?|confirm(?:e[ds]?|ation)?|oui|yes|ok)\b"


def unit_mismatch(unit: Column, family: Column) -> Column:
    """Whether a unit has a word that its family can't have."""
    low, out = F.lower(F.trim(unit)), F.lit(False)
    for name, words in UNLIKELY_UNITS.items():
        out = F.when(family == name, F.exists(F.array(*map(F.lit, words)), lambda w: low.contains(w))).otherwise(out)
    return F.coalesce(out, F.lit(False))


def is_note_label(label: Column) -> Column:
    return F.coalesce(F.exists(F.array(*map(F.lit, NOTE_LABELS)), lambda w: F.lower(label).contains(w)), F.lit(False))


def agrees(text: Column) -> Column:
    return F.coalesce(text.rlike(AGREES), F.lit(False))
