"""Named checks of a document's artifacts, by group: rules over the rows of each artifact, and what they find.

:func:`findings` gives a row for each check that a row doesn't pass; :func:`evidentia.operators.audits.audit` counts them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .audits import Rules, blank

#: Statuses and types that artifacts may have.
FIGURE_STATUSES = ["detected", "detected_not_cropped", "cropped", "low_confidence", "page_level"]
MODALITIES = ["text", "table", "figure"]
POLICIES = ["eligible", "review_required", "exclude"]
EVIDENCE_POLICIES = ["normal", "review_required", "quarantine"]

LOW_TEXT, DENSE_TITLES, UNKNOWN_BLOCKS, SHORT_AVERAGE = 100, 0.60, 0.30, 100


def _among(name: str, values: list[str]):
    return F.coalesce(F.col(name).isin(values), F.lit(False))


def page_rules() -> Rules:
    """Pages with characters, blocks, titles, titles_with_number and extraction_status."""
    n = F.coalesce("characters", F.lit(0))
    return {
        "page_low_text_warning": (n < LOW_TEXT, "warning"),
        "possible_visual_page": ((F.col("extraction_status") == "ok") & (n > 0) & (n < LOW_TEXT), "warning"),
        "possible_table_of_contents_page": ((F.col("titles") >= 8) & (F.col("titles_with_number") >= 5), "warning"),
        "high_title_density_warning": ((F.col("blocks") > 0) & (F.col("titles") / F.when(F.col("blocks") > 0, F.col("blocks")) > DENSE_TITLES), "warning"),
    }


def block_rules() -> Rules:
    """Blocks with block_type and repeated (the pages that have the text)."""
    kind = lambda *k: F.col("block_type").isin(*k)
    return {
        "toc_entries_detected": (kind("toc_entry"), "info"),
        "header_footer_detected": (kind("header", "footer"), "info"),
        "repeated_header_footer_warning": (kind("header", "footer") & (F.col("repeated") > 1), "warning"),
        "footer_detection_refined": (kind("footer"), "info"),
        "footnotes_detected": (kind("footnote"), "info"),
    }


def candidate_rules() -> Rules:
    """Candidates for headings with status and was_merged."""
    status = F.col("status")
    of = lambda *s: (status.isin(*s), "info")
    return {
        "section_candidates_detected": (F.lit(True), "info"),
        "section_candidates_rejected": (status.startswith("rejected"), "info"),
        "section_front_matter_rejected": of("rejected_front_matter", "rejected_toc_heading", "rejected_document_title"),
        "section_numeric_values_rejected": of("rejected_numeric_value", "rejected_too_numeric"),
        "section_timeline_like_rejected": of("rejected_timeline_like"),
        "heading_fragments_rejected": of("rejected_heading_fragment"),
        "org_chart_like_headings_rejected": of("rejected_org_chart_like", "rejected_diagram_like"),
        "sentence_like_headings_rejected": of("rejected_sentence_like_heading"),
        "section_candidate_score_threshold_applied": of("rejected_low_confidence"),
        "merged_headings_created": (F.col("was_merged"), "info"),
    }


def section_rules(pages: str = "last_page") -> Rules:
    """Sections with page_start, page_end, section_type, confidence and the document's last page."""
    start, end = F.col("page_start"), F.coalesce("page_end", "page_start")
    return {
        "section_range_valid": ((start < 1) | (end < start) | (end > F.col(pages)), "error"),
        "section_unknown_ratio_warning": (F.col("section_type") == "unknown", "warning"),
        "section_low_confidence_warning": (F.coalesce("confidence", F.lit(0.0)) < 0.60, "warning"),
        "sections_created": (F.lit(True), "info"),
    }


def evidence_rules() -> Rules:
    """Evidence with quote, source_element_id, section_id, section_known, has_bbox, policy, review_required and blocks."""
    size = F.length(F.trim(F.coalesce("quote", F.lit(""))))
    return {
        "evidence_store_created": (F.lit(True), "info"),
        "evidence_quote_not_empty": (size == 0, "error"),
        "evidence_source_exists": (blank("source_element_id"), "error"),
        "evidence_without_section_warning": (blank("section_id"), "warning"),
        "evidence_section_link_valid": (~blank("section_id") & ~F.col("section_known"), "error"),
        "evidence_bbox_available": (~F.col("has_bbox"), "warning"),
        "evidence_policy_assigned": (~_among("policy", EVIDENCE_POLICIES), "error"),
        "evidence_policy_consistency_check": ((F.col("policy") != "normal") & ~F.col("review_required"), "error"),
        "quarantined_evidence_detected": (F.col("policy") == "quarantine", "warning"),
        "short_evidence_review_required": ((size > 0) & (size < 60), "warning"),
        "evidence_paragraph_merge_applied": (F.col("blocks") > 1, "info"),
    }


def table_rules() -> Rules:
    """Tables with table_quality_flags, extraction_status, row_count, cells, section_id and bad_cells (negative places)."""
    flag = lambda f: F.array_contains("table_quality_flags", f)
    status = F.col("extraction_status")
    return {
        "table_extraction_status_valid": ((status == "parsed") & (flag("all_cells_empty") | ((F.col("row_count") > 0) & (F.col("cells") == 0))), "error"),
        "table_section_link_valid": (blank("section_id"), "warning"),
        "table_detected_not_parsed_warning": (status == "detected_not_parsed", "warning"),
        "table_low_confidence_warning": (status == "low_confidence", "warning"),
        "table_cell_coordinates_valid": (F.col("bad_cells") > 0, "error"),
        "empty_table_detected": (status == "empty_table", "warning"),
        "mostly_empty_table_warning": (flag("mostly_empty_cells"), "warning"),
        "tiny_table_artifact_warning": (flag("tiny_table_artifact"), "warning"),
        "front_matter_or_toc_table_warning": (flag("front_matter_or_toc_table_like"), "warning"),
        "fragmented_table_warning": (flag("high_fragmented_cells_ratio"), "warning"),
        "table_artifact_suspected_warning": (flag("table_artifact_suspected"), "warning"),
    }


def figure_rules(types: list[str]) -> Rules:
    """Figures with figure_id, extraction_status, figure_type, section_id, has_bbox, caption, confidence, detection_method."""
    method = F.col("detection_method")
    return {
        "figure_id_missing": (blank("figure_id"), "error"),
        "figure_status_invalid": (~_among("extraction_status", FIGURE_STATUSES), "error"),
        "figure_type_invalid": (~_among("figure_type", types), "error"),
        "figure_section_link_valid": (blank("section_id"), "warning"),
        "figure_without_bbox_warning": (~F.col("has_bbox"), "warning"),
        "figure_without_caption_warning": (blank("caption"), "warning"),
        "figure_low_confidence_warning": (F.coalesce("confidence", F.lit(0.0)) < 0.50, "warning"),
        "page_level_visual_detected": (method == "page_heuristic", "info"),
        "weak_visual_detection_warning": ((method == "page_heuristic") & blank("caption"), "warning"),
    }


def multimodal_rules() -> Rules:
    """Evidence of all modalities with source_modality, use_policy, policy and review_required."""
    use = F.col("use_policy")
    return {
        "multimodal_evidence_index_created": (F.lit(True), "info"),
        "modality_assignment_valid": (~_among("source_modality", MODALITIES), "error"),
        "downstream_use_policy_assigned": (blank("use_policy"), "error"),
        "multimodal_evidence_policy_valid": (~blank("use_policy") & ~_among("use_policy", POLICIES), "error"),
        "quarantined_evidence_excluded_from_automatic_extraction": ((F.col("policy") == "quarantine") & (use != "exclude"), "error"),
        "review_required_evidence_not_marked_eligible": (F.col("review_required") & (use == "eligible"), "error"),
    }


def findings(rows: DataFrame, rules: Rules, ident: list[str]) -> DataFrame:
    """(ident, check_name, severity) for each faulting rule that a row breaks."""
    hits = F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.struct(F.lit(k).alias("check_name"), F.lit(level).alias("severity"))) for k, (c, level) in rules.items() if level != "info")))
    return rows.select(*ident, F.explode(hits).alias("_h")).select(*ident, "_h.*")
