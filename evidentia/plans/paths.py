"""The three end-to-end paths as compositions of operators: DataFrames in, a mapping of DataFrames out.

Nothing is written between stages; callers persist what they publish. Frames used several times are left to Spark's
exchange reuse, or can be written by the caller first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import canonical_numeric, year_with_source
from ..operators import candidates as C, corpus, evidence as E, retrieval as R, variables as V
from ..session import guard


def corpus_path(registry: DataFrame, validation: DataFrame, complete_types: Sequence[str]) -> dict[str, DataFrame]:
    """registry (document_id, sha256, company_slug, fiscal_year, document_family, score, candidate_rank, official, pages,
    technical_status) and validation (document_id, status, confidence) to canonical, selected, rejected and bucketed documents."""
    guard(registry.sparkSession)
    order = [F.desc_nulls_last("score"), F.asc_nulls_last("candidate_rank"), F.desc("official"), "document_id"]
    canonical = corpus.canonical_documents(registry.filter("sha256 IS NOT NULL"), "sha256", order, {"document_family": "families"})
    judged = corpus.worst_per_key(validation, ["document_id"], "status", "confidence")
    rows = canonical.join(judged, "document_id", "left").withColumn("status", F.coalesce("status", F.lit("needs_review")))
    points = corpus.selection_score(F.col("technical_status"), F.col("status"), F.col("official"), F.lit(True), F.col("fiscal_year").isNotNull(), F.col("pages"), F.col("duplicate_count"), F.col("document_family").isin(list(complete_types)))
    cases = [(F.col("technical_status").isin("missing_file", "not_pdf", "unreadable_pdf"), "unreadable"), (F.col("status") == "likely_wrong_company", "wrong_company")]
    ranked = corpus.ranked_selection(rows.withColumn("selection_score", points), ["company_slug", "fiscal_year", "document_family"], [F.desc("selection_score"), "document_id"], cases, same="sha256")
    selected = ranked.filter("selection_status = 'selected'").withColumn("audit_bucket", corpus.quality_bucket(F.col("status"), F.col("pages"), F.col("confidence")))
    return {
        "duplicates": corpus.exact_duplicate_groups(registry, ident="document_id"),
        "canonical": canonical,
        "selected": selected,
        "rejected": ranked.filter("selection_status = 'rejected'"),
        "summary": corpus.group_summary(selected, ["company_slug"], "audit_bucket", ["keep", "review", "high_priority_review", "quarantine"]),
    }


def value_path(engines: Mapping[str, DataFrame], renames: Mapping[str, Mapping[str, str]], decisions: DataFrame, dictionary: DataFrame, variables: Sequence[str]) -> dict[str, DataFrame]:
    """Candidates of the engines (ident, document_id, company, fiscal_year, information_type, page_number, family, label,
    raw_value, raw_unit, year, quote, confidence, pos) to the dense table of company, year and variable with its lineage."""
    every = C.backfill_scope(C.union_engines(engines, renames))
    guard(every.sparkSession)
    key = C.consolidation_key(F.col("document_id"), F.col("information_type"), F.col("page_number"), F.col("raw_value"), F.col("quote"), F.col("label"))
    marked = C.mark_duplicates(every.withColumn("key_text", key), "key_text", [C.engine_rank(F.col("source_engine")), -F.col("confidence"), F.length("quote")], "pos", "ident")
    unique = C.consensus_boost(marked).filter("deduplication_status <> 'duplicate'")
    status = C.validation_status(C.forbidden_signal([F.col("label"), F.col("quote")]), F.lit(False), F.lit("ok"), F.col("quote"), F.col("document_id").isNotNull(), F.col("page_number"), F.col("raw_value"))
    validated = unique.withColumn("validation_status", C.by_confidence(status, F.col("confidence")))
    workspace = validated.filter("validation_status <> 'reject_candidate'").withColumn("review_priority", C.review_priority(F.col("validation_status"), F.col("raw_value"), F.col("confidence")))
    reviewed = C.apply_decisions(workspace, decisions.select("ident", "decision", F.col("pos").alias("decision_pos")), "ident", "decision", "decision_pos")
    accepted = reviewed.filter("review_status = 'accepted'").withColumn("_year", year_with_source(F.col("year"), F.col("fiscal_year"), F.col("quote")))
    records = accepted.select("ident", F.col("label").alias("key"), "family", "label", "quote")
    mapped = V.map_variables(records, dictionary, "ident").filter("mapping_status = 'mapped'")
    facts = accepted.join(mapped.select("ident", "variable_name"), "ident").select("company", F.col("_year.year").alias("year"), "variable_name", F.col("raw_value").alias("value"), F.col("raw_unit").alias("unit"), "quote", "ident")
    entities = accepted.select("company", F.col("_year.year").alias("year")).distinct()
    selected = V.select_values(facts, entities, variables, canonical_numeric(F.col("value")), [F.col("value").isNull(), "ident"])
    evidence = accepted.select(F.col("ident").alias("evidence_ident"), "document_id", "page_number", "source_engine")
    return {
        "consolidated": marked,
        "validated": validated,
        "reviewed": reviewed,
        "mapped": mapped,
        "selected": selected,
        "wide": V.wide(selected, variables),
        "missing": V.missing_report(selected),
        "lineage": V.lineage(selected, evidence, "evidence_ident"),
        "findings": V.quality_findings(selected),
    }


def retrieval_path(chunks: Sequence[tuple[str, DataFrame]], catalog: DataFrame, document: str, text: str, position: str, k: int = 20, least: float = 0.25, places: DataFrame | None = None, noise: Sequence[str] = (r"(?i)table of contents", r"(?i)^page \d+$")) -> dict[str, DataFrame]:
    """Chunks of several builders and a catalog (variable_name, terms, units) to the k best chunks of each variable.

    The catalog has a few dozen rows and is broadcast; a chunk stays if it scores enough or holds a term. ``places``
    (document_id, section_id, doc_type; one row for each document) fills the section's part of the score; the catalog
    then has domain and preferred, an array of types, too. The semantic part is the cosine of the tf-idf encodings of
    the chunk and of the variable's first eight terms.
    """
    guard(catalog.sparkSession)
    unique = E.chunks(chunks, document, text, position)
    vocab_terms = R.tokens(unique, "chunk_id", "chunk_text")
    vocab = R.vocabulary(vocab_terms, "chunk_id", unique.count())
    weights = R.tfidf(vocab_terms, vocab, "chunk_id")
    asked = catalog.select("variable_name", F.concat_ws(" ", F.slice("terms", 1, 8)).alias("_text"))
    words = R.tfidf(R.tokens(asked, "variable_name", "_text"), vocab, "variable_name")
    semantic = weights.join(F.broadcast(words.withColumnRenamed("weight", "_q")), "token").groupBy("variable_name", "chunk_id").agg(F.least(F.lit(1.0), F.sum(F.col("weight") * F.col("_q"))).alias("semantic"))
    low = F.lower("chunk_text")
    pairs = unique.crossJoin(F.broadcast(catalog)).withColumns({"keyword": R.keyword_score(low, F.col("terms")), "unit": R.unit_score(low, F.col("units"))})
    section = F.lit(0.0)
    if places is not None:
        pairs = pairs.join(places.select("document_id", "section_id", "doc_type"), "document_id", "left")
        section = R.section_score(F.col("chunk_type"), F.col("section_id"), F.col("domain"), F.col("doc_type"), F.col("preferred"))
    scored = pairs.join(semantic, ["variable_name", "chunk_id"], "left")
    score = R.hybrid(F.coalesce("semantic", F.lit(0.0)), F.col("keyword"), F.col("unit"), section, R.structural_penalty(F.col("chunk_text"), noise))
    kept = scored.withColumn("score", score).filter((F.col("score") >= least) | (F.col("keyword") > 0))
    return {"chunks": unique, "retrieved": R.top(kept.select("variable_name", "chunk_id", "document_id", "chunk_text", "score"), ["variable_name"], [F.desc("score"), "chunk_id"], k)}
