"""Queries over candidate rows: filters, key figures, audits, contracts. Line items stand for candidates of orders (documents)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import artifacts as A, audits as Q, filters as S, kpi as K, statistics as T
from .registry import query, table

FAMILIES = ["energy", "water", "workforce", "unknown", "boundary", "governance"]

CANDIDATES = """
    cand AS (
        SELECT l_orderkey AS document_id, l_linenumber AS page_number, l_suppkey % 7 AS company, CAST(year(l_shipdate) AS INT) AS fiscal_year,
               CASE l_returnflag WHEN 'R' THEN 'reject_candidate' WHEN 'A' THEN 'needs_review' ELSE 'possible_indicator' END AS validation_status,
               CASE l_partkey % 6 WHEN 0 THEN 'energy' WHEN 1 THEN 'water' WHEN 2 THEN 'workforce' WHEN 3 THEN 'unknown' WHEN 4 THEN 'boundary' ELSE 'governance' END AS indicator_family,
               CASE l_linenumber % 3 WHEN 0 THEN 'csv' WHEN 1 THEN 'table' ELSE 'visual' END AS source_engine,
               CASE WHEN l_discount > 0.02 THEN CAST(CAST(l_quantity AS INT) AS VARCHAR) ELSE ' ' END AS raw_value, CASE WHEN l_tax > 0.02 THEN 'MWh' ELSE '' END AS raw_unit,
               CASE WHEN l_linenumber = 4 THEN 'Part' ELSE 'Part ' || l_partkey || ' of ' || l_suppkey END AS quote, l_partkey, l_suppkey, l_linestatus
        FROM lineitem
    )
"""


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    text = lambda c: F.col(c).cast("string")
    family = F.element_at(F.array(*map(F.lit, FAMILIES)), (F.col("l_partkey") % 6 + 1).cast("int"))
    flag = F.col("l_returnflag")
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("document_id"), F.col("l_linenumber").alias("page_number"), (F.col("l_suppkey") % 7).alias("company"), F.year("l_shipdate").alias("fiscal_year"),
        F.when(flag == "R", F.lit("reject_candidate")).when(flag == "A", F.lit("needs_review")).otherwise(F.lit("possible_indicator")).alias("validation_status"), family.alias("indicator_family"),
        F.element_at(F.array(*map(F.lit, ("csv", "table", "visual"))), (F.col("l_linenumber") % 3 + 1).cast("int")).alias("source_engine"),
        F.when(F.col("l_discount") > 0.02, F.col("l_quantity").cast("int").cast("string")).otherwise(F.lit(" ")).alias("raw_value"), F.when(F.col("l_tax") > 0.02, F.lit("MWh")).otherwise(F.lit("")).alias("raw_unit"),
        F.when(F.col("l_linenumber") == 4, F.lit("Part")).otherwise(F.concat(F.lit("Part "), text("l_partkey"), F.lit(" of "), text("l_suppkey"))).alias("quote"), "l_partkey", "l_suppkey", "l_linestatus",
    )


SHOWN = ["document_id", "page_number", "company", "validation_status", "indicator_family", "raw_value", "quote"]


@query(f"""
    WITH {CANDIDATES}
    SELECT {', '.join(SHOWN)} FROM cand
    WHERE validation_status = 'needs_review' AND indicator_family = 'energy' AND CAST(company AS VARCHAR) = '3' AND trim(raw_value) <> '' AND length(quote) >= 10 AND regexp_matches(quote, '(?i)part [0-9]*[24] OF')
""")
def candidate_filters(spark: SparkSession, d: str) -> DataFrame:
    """All filters together, one that is blank, and one on a column that isn't there."""
    out = S.filtered(
        _candidates(spark, d), {"validation_status": "needs_review", "indicator_family": "energy", "company": "3", "source_engine": "", "risk_level": "high"}, {"quote": "part [0-9]*[24] OF", "label": "x"}, value=True, quote=True
    )
    return out.select(*SHOWN)


@query(f"WITH {CANDIDATES} SELECT {', '.join(SHOWN)} FROM cand WHERE CAST(fiscal_year AS VARCHAR) = '1995' AND source_engine = 'table' AND contains(lower(quote), ' of 7')")
def filters_by_name(spark: SparkSession, d: str) -> DataFrame:
    return S.by_names(_candidates(spark, d), quote=" OF 7", fiscal_year=1995, source_engine="table", nothing="x", company=None).select(*SHOWN)


@query(f"WITH {CANDIDATES} SELECT {', '.join(SHOWN)} FROM cand WHERE validation_status = 'possible_indicator' AND indicator_family NOT IN ('unknown', 'boundary') AND trim(raw_value) <> '' AND length(quote) >= 10")
def priority_queue(spark: SparkSession, d: str) -> DataFrame:
    return S.priority_queue(_candidates(spark, d)).select(*SHOWN)


LABELS = {"possible_indicator": "Possible", "needs_review": "To review", "energy": "Energy", "water": "Water"}


@query(f"""
    WITH {CANDIDATES}
    SELECT document_id AS "Document", CASE validation_status WHEN 'possible_indicator' THEN 'Possible' WHEN 'needs_review' THEN 'To review' ELSE validation_status END AS "Status",
           CASE indicator_family WHEN 'energy' THEN 'Energy' WHEN 'water' THEN 'Water' ELSE indicator_family END AS "Family", raw_value AS "Value" FROM cand
""")
def business_results(spark: SparkSession, d: str) -> DataFrame:
    return S.business_view(_candidates(spark, d), {"document_id": "Document", "validation_status": "Status", "indicator_family": "Family", "raw_value": "Value", "missing": "Missing"}, LABELS)


@query(f"""
    WITH {CANDIDATES}
    SELECT CASE indicator_family WHEN 'energy' THEN 'Energy' WHEN 'water' THEN 'Water' ELSE indicator_family END AS value FROM cand GROUP BY 1
""")
def distinct_labels(spark: SparkSession, d: str) -> DataFrame:
    return S.distinct_values(S.human_labels(_candidates(spark, d), LABELS, {"indicator_family": "Famille"}), "Famille")


@query(f"""
    WITH {CANDIDATES}, o AS (
        SELECT document_id, page_number, unnest(list_filter([CASE WHEN l_linestatus <> 'O' AND indicator_family <> 'unknown' THEN 'observed' END, CASE WHEN l_linestatus = 'O' THEN 'target' END, CASE WHEN indicator_family = 'unknown' THEN 'context' END], lambda x: x IS NOT NULL)) AS output FROM cand
    )
    SELECT output, document_id, count(*) AS n FROM o GROUP BY 1, 2
""")
def table_outputs(spark: SparkSession, d: str) -> DataFrame:
    rows = _candidates(spark, d).withColumn("row_text", F.when(F.col("l_linestatus") == "O", F.lit("Our TARGET for")).otherwise(F.lit("Result of")))
    return rows.select("document_id", F.explode(S.table_outputs(F.col("row_text"), F.col("indicator_family"))).alias("output")).groupBy("output", "document_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
    WITH {CANDIDATES}, r AS (SELECT count(*) AS risks, count(*) FILTER (l_linestatus = 'O') AS high FROM cand WHERE raw_unit = ''),
    u AS (SELECT count(*) AS selected, count(*) FILTER (o_orderstatus IN ('F', 'O')) AS processed, count(*) FILTER (o_orderstatus = 'F') AS success, count(*) FILTER (o_orderstatus = 'O') AS failed FROM orders),
    c AS (
        SELECT count(*) AS n, count(*) FILTER (validation_status = 'possible_indicator') AS p, count(*) FILTER (validation_status = 'needs_review') AS v, count(*) FILTER (validation_status = 'reject_candidate') AS x,
               count(*) FILTER (trim(raw_value) = '') AS nv, count(*) FILTER (trim(raw_unit) = '') AS nu, count(*) FILTER (length(trim(quote)) < 10) AS nq, count(*) FILTER (indicator_family IN ('unknown', 'boundary')) AS nb,
               count(*) FILTER (trim(raw_value) <> '' AND length(trim(quote)) >= 10) AS cov, count(DISTINCT document_id) AS docs FROM cand
    ), m AS (SELECT max(k) AS most FROM (SELECT count(*) AS k FROM cand GROUP BY document_id))
    SELECT selected AS documents_selected, processed AS documents_processed, success AS documents_success, failed AS documents_failed, success * 100.0 / processed AS documents_success_rate, n AS candidate_count_total,
           p AS possible_indicator_count, v AS needs_review_count, x AS reject_candidate_count, p * 100.0 / n AS possible_indicator_rate, v * 100.0 / n AS needs_review_rate, x * 100.0 / n AS reject_candidate_rate,
           nv * 100.0 / n AS missing_value_rate, nu * 100.0 / n AS missing_unit_rate, nq * 100.0 / n AS missing_quote_rate, nb * 100.0 / n AS unknown_boundary_rate, risks AS false_positive_count, risks * 100.0 / n AS false_positive_risk_rate,
           high * 100.0 / n AS high_risk_rate, CAST((p * 3.0 + v * 1.0 + x * 0.3) / 60 AS DOUBLE) AS review_burden_hours, n / docs AS average_candidates_per_document, most AS max_candidates_per_document, cov * 100.0 / n AS evidence_coverage_rate
    FROM c, r, u, m
""")
def production_figures(spark: SparkSession, d: str) -> DataFrame:
    rows = _candidates(spark, d)
    risks = rows.filter("raw_unit = ''").select(F.when(F.col("l_linestatus") == "O", F.lit("high")).otherwise(F.lit("medium")).alias("risk_level"))
    state = F.when(F.col("o_orderstatus") == "F", F.lit("success")).when(F.col("o_orderstatus") == "O", F.lit("failed")).otherwise(F.lit("selected"))
    return K.figures(rows, risks, table(spark, d, "orders").select(state.alias("status")))


@query("""
    SELECT count(*) AS total, count(x) AS decided, count(*) FILTER (x = 'accept_candidate') AS accepted, count(*) FILTER (x = 'reject_candidate') AS rejected, count(*) FILTER (x = 'needs_more_evidence') AS more_evidence
    FROM documents d LEFT JOIN (SELECT doc_id, arg_max(CASE WHEN toxic = 1 THEN 'needs_more_evidence' WHEN quality = 1 THEN 'accept_candidate' ELSE 'reject_candidate' END, quality * 2 + toxic) AS x FROM labels GROUP BY 1) USING (doc_id)
""")
def review_progress(spark: SparkSession, d: str) -> DataFrame:
    said = F.when(F.col("toxic") == 1, F.lit("needs_more_evidence")).when(F.col("quality") == 1, F.lit("accept_candidate")).otherwise(F.lit("reject_candidate"))
    decisions = table(spark, d, "labels").select("doc_id", said.alias("decision"), (F.col("quality") * 2 + F.col("toxic")).alias("pos"))
    return K.review_progress(table(spark, d, "documents").select("doc_id"), decisions, "doc_id", "decision")


@query("SELECT l_partkey, n FROM (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 20)")
def busiest_pages(spark: SparkSession, d: str) -> DataFrame:
    """A top-k report."""
    return K.top_counts(table(spark, d, "lineitem"), "l_partkey", 20)


@query("""
    WITH w AS (SELECT o_custkey, year(o_orderdate) AS y, max(CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) AS f, max(CASE WHEN o_orderstatus = 'O' THEN o_orderkey END) AS o FROM orders GROUP BY 1, 2)
    SELECT o_custkey || ' · ' || y AS row, CAST(f IS NOT NULL AS INT) AS f, CAST(o IS NOT NULL AS INT) AS o FROM w
""")
def presence_matrix(spark: SparkSession, d: str) -> DataFrame:
    status = lambda s: F.max(F.when(F.col("o_orderstatus") == s, F.col("o_orderkey")))
    wide = table(spark, d, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(status("F").alias("f"), status("O").alias("o"))
    return K.presence_matrix(wide, ["o_custkey", "y"], ["f", "o"])


@query("SELECT o_orderpriority, count(*) AS tried, count(*) FILTER (o_orderstatus = 'F') AS succeeded, round(count(*) FILTER (o_orderstatus = 'F') / count(*), 4) AS rate FROM orders GROUP BY 1")
def retriever_benchmark(spark: SparkSession, d: str) -> DataFrame:
    return K.success_counts(table(spark, d, "orders"), "o_orderpriority", F.col("o_orderstatus") == "F")


@query("""
    WITH s AS (SELECT o_custkey AS company, year(o_orderdate) AS y, o_orderpriority AS path, o_orderkey AS doc, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS n FROM orders)
    SELECT company, y AS year, string_agg(DISTINCT path, '|' ORDER BY path) AS sources, count(DISTINCT doc) AS documents, bool_and(n = 0) AS all_empty FROM s GROUP BY 1, 2
""")
def input_inventory(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select(F.col("o_custkey").alias("company"), F.year("o_orderdate").alias("year"), "o_orderpriority", "o_orderkey", F.when(F.col("o_orderstatus") == "F", 1).alias("n"))
    return K.input_inventory(rows, ["company", "year"], "o_orderpriority", "o_orderkey", "n")


def audit_sql(rows: str, rules: list[tuple[str, str, str]]) -> str:
    """The counts of an audit, one SELECT for each rule."""
    def one(name: str, level: str, condition: str) -> str:
        n = f"count(*) FILTER ({condition})"
        status = "'needs_review'" if level == "info" else f"CASE WHEN {n} = 0 THEN 'pass' ELSE 'needs_review' END"
        return f"SELECT '{name}' AS check_name, {n} AS n, CASE WHEN {n} > 0 THEN '{level}' ELSE 'info' END AS severity, {status} AS status FROM r"

    return f"WITH {rows} " + " UNION ALL ".join(one(*x) for x in rules)


PREPARED = """
    r AS (
        SELECT o_orderkey AS ident, CASE WHEN o_orderkey % 50 = 0 THEN 'final' ELSE 'preparation_only' END AS status, CASE WHEN o_orderkey % 97 = 0 THEN 'True' ELSE 'False' END AS is_final, CASE WHEN o_orderstatus = 'P' THEN '' ELSE 'c' END AS candidate,
               o_orderpriority, o_orderstatus, o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AS has_link, o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AS has_lineage,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'corrected_value' ELSE 'raw_value' END AS value_source,
               CASE WHEN o_totalprice < 50000 THEN 'needs_value_review' WHEN o_totalprice < 100000 THEN 'needs_unit_review|needs_year_review' ELSE 'complete' END AS quality FROM orders
    )
"""

DATABASE = [
    ("preparation_indicators_count", "info", "true"), ("preparation_only_count", "info", "status = 'preparation_only'"), ("final_indicator_detected_count", "error", "is_final <> 'False'"), ("score_detected_count", "error", "false"),
    ("records_without_candidate_id_count", "error", "candidate = ''"), ("records_without_document_id_count", "error", "false"), ("records_without_quote_count", "warning", "o_orderpriority = '5-LOW'"), ("records_without_page_count", "warning", "false"),
    ("records_without_evidence_link_count", "warning", "NOT has_link"), ("records_without_lineage_count", "warning", "NOT has_lineage"), ("records_with_corrected_values_count", "warning", "value_source = 'corrected_value'"),
    ("records_with_unknown_domain_count", "warning", "o_orderstatus = 'O'"), ("records_with_unknown_topic_count", "warning", "false"), ("records_needing_value_review_count", "warning", "contains(quality, 'value')"),
    ("records_needing_unit_review_count", "warning", "contains(quality, 'unit')"), ("records_needing_year_review_count", "warning", "contains(quality, 'year')"),
]


def _prepared(spark: SparkSession, d: str) -> DataFrame:
    o, key = table(spark, d, "orders"), F.col("o_orderkey")
    price = F.col("o_totalprice")
    rows = o.select(
        "o_orderkey", "o_custkey", F.when(key % 50 == 0, F.lit("final")).otherwise(F.lit("preparation_only")).alias("indicator_database_status"), F.when(key % 97 == 0, F.lit("True")).otherwise(F.lit("False")).alias("is_final_indicator"), F.lit("False").alias("score_produced"),
        F.when(F.col("o_orderstatus") != "P", F.lit("c")).otherwise(F.lit(" ")).alias("candidate_id"), key.alias("document_id"), F.when(F.col("o_orderpriority") != "5-LOW", F.lit("said")).alias("quote"), F.lit(1).alias("page_number"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("corrected_value")).otherwise(F.lit("raw_value")).alias("value_source"), F.lit("raw_unit").alias("unit_source"), F.lit("raw_year").alias("year_source"),
        F.when(F.col("o_orderstatus") == "O", F.lit("unknown")).otherwise(F.lit("environment")).alias("indicator_domain"), F.lit("energy").alias("indicator_topic"),
        F.when(price < 50000, F.lit("needs_value_review")).when(price < 100000, F.lit("needs_unit_review|needs_year_review")).otherwise(F.lit("complete")).alias("preparation_quality_status"),
    )
    links = table(spark, d, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    lineage = table(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return Q.with_membership(Q.with_membership(rows, links, "o_orderkey", "has_link"), lineage, "o_custkey", "has_lineage")


@query(audit_sql(PREPARED, DATABASE))
def database_audit(spark: SparkSession, d: str) -> DataFrame:
    return Q.audit(_prepared(spark, d), Q.database_rules())


@query(audit_sql(PREPARED, [("status_must_be_preparation_only", "error", "status <> 'preparation_only'"), ("is_final_indicator_must_be_false", "error", "is_final <> 'False'"), ("score_produced_must_be_false", "error", "false"), ("missing_evidence_link", "error", "NOT has_link"), ("missing_lineage", "error", "NOT has_lineage")]))
def database_contract(spark: SparkSession, d: str) -> DataFrame:
    return Q.audit(_prepared(spark, d), Q.database_contract())


@query(f"WITH {PREPARED}, f AS (SELECT count(*) FILTER (is_final <> 'False') AS a, count(*) FILTER (candidate = '') AS b FROM r) SELECT CAST(16 AS BIGINT) AS findings, CAST((a > 0)::INT + (b > 0)::INT AS BIGINT) AS errors, (SELECT count(*) FROM ({audit_sql(PREPARED, DATABASE)}) WHERE severity = 'warning') AS warnings FROM f")
def audit_summary(spark: SparkSession, d: str) -> DataFrame:
    return Q.summary(Q.audit(_prepared(spark, d), Q.database_rules()))


@query(f"""
    WITH {PREPARED}, h AS (SELECT 'final_indicator_detected_count' AS check_name, ident FROM r WHERE is_final <> 'False' UNION ALL SELECT 'missing_link', ident FROM r WHERE NOT has_link)
    SELECT check_name, CAST(sample AS INT) AS sample, ident AS o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY check_name ORDER BY ident) AS sample FROM h) WHERE sample <= 5
""")
def audit_samples(spark: SparkSession, d: str) -> DataFrame:
    """Samples for a report: five rows for each rule."""
    rules = {"final_indicator_detected_count": Q.database_rules()["final_indicator_detected_count"], "missing_link": (~F.col("has_link"), "error")}
    return Q.audit_samples(_prepared(spark, d), rules, ["o_orderkey"], ["o_orderkey"])


VALIDATED = f"""
    {CANDIDATES}, r AS (SELECT *, CASE WHEN l_linestatus = 'O' THEN 'unique' ELSE 'duplicate_candidate' END AS dup, l_suppkey % 3 = 0 AS sourced FROM cand)
"""
POSSIBLE = "validation_status = 'possible_indicator'"


@query(audit_sql(VALIDATED, [
    ("validation_records_count", "info", "true"), ("possible_indicators_count", "info", POSSIBLE), ("rejected_candidates_count", "info", "validation_status = 'reject_candidate'"), ("needs_review_count", "info", "validation_status = 'needs_review'"),
    ("validated_indicators_count", "error", "false"), ("score_produced_count", "error", "true"), ("records_without_quote_count", "warning", "false"), ("records_without_source_count", "warning", "NOT sourced"), ("records_without_page_count", "warning", "false"),
    ("possible_indicator_without_value_count", "warning", f"{POSSIBLE} AND trim(raw_value) = ''"), ("possible_indicator_without_unit_count", "warning", f"{POSSIBLE} AND raw_unit = ''"), ("possible_indicator_without_year_count", "warning", "false"),
    ("duplicate_candidates_count", "warning", "dup = 'duplicate_candidate'"), ("unknown_indicator_family", "warning", "indicator_family = 'unknown'"),
]))
def validation_audit(spark: SparkSession, d: str) -> DataFrame:
    rows = _candidates(spark, d).withColumns({
        "is_validated_indicator": F.lit("False"), "score_produced": F.lit(None).cast("string"), "evidence_id": F.lit(""), "table_id": F.when(F.col("l_suppkey") % 3 == 0, F.lit("t")), "figure_id": F.lit(None).cast("string"),
        "normalized_value": F.col("raw_value"), "normalized_unit": F.col("raw_unit"), "normalized_year": F.col("fiscal_year"), "duplicate_status": F.when(F.col("l_linestatus") == "O", F.lit("unique")).otherwise(F.lit("duplicate_candidate")),
    })
    return Q.audit(rows, Q.validation_rules())


REVIEWED = """
    r AS (
        SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'accepted_candidate' WHEN '2-HIGH' THEN 'rejected_by_reviewer' WHEN '3-MEDIUM' THEN 'needs_more_evidence' WHEN '5-LOW' THEN 'missing_decision' ELSE 'invalid_decision' END AS status,
               o_orderstatus = 'F' AS reviewed, o_orderstatus <> 'P' AS reasoned, o_custkey % 5 = 0 AS v, o_custkey % 7 = 0 AS u, o_orderkey % 11 = 0 AS untraced FROM orders
    )
"""
ACCEPTED = "status = 'accepted_candidate'"


@query(audit_sql(REVIEWED, [
    ("review_items_count", "info", "true"), ("decisions_count", "info", "status <> 'missing_decision'"), ("accepted_candidates_count", "info", ACCEPTED), ("rejected_candidates_count", "info", "status = 'rejected_by_reviewer'"),
    ("needs_more_evidence_count", "info", "status = 'needs_more_evidence'"), ("deferred_candidates_count", "info", "false"), ("missing_decision_count", "warning", "status = 'missing_decision'"), ("invalid_decision_count", "error", "status = 'invalid_decision'"),
    ("accepted_without_reviewer_count", "warning", f"{ACCEPTED} AND NOT reviewed"), ("accepted_without_reason_count", "warning", f"{ACCEPTED} AND NOT reasoned"), ("corrected_value_count", "info", "v"), ("corrected_unit_count", "info", "u"), ("corrected_year_count", "info", "false"),
    ("validated_indicator_detected_count", "error", "false"), ("score_detected_count", "error", "false"), ("missing_traceability", "error", "untraced"), ("correction_without_reason", "warning", "(u OR v) AND NOT reasoned"),
]))
def review_audit(spark: SparkSession, d: str) -> DataFrame:
    p, yes = F.col("o_orderpriority"), lambda c, x="x": F.when(c, F.lit(x))
    status = F.when(p == "1-URGENT", F.lit("accepted_candidate")).when(p == "2-HIGH", F.lit("rejected_by_reviewer")).when(p == "3-MEDIUM", F.lit("needs_more_evidence")).when(p == "5-LOW", F.lit("missing_decision")).otherwise(F.lit("invalid_decision"))
    rows = table(spark, d, "orders").select(
        "*", status.alias("review_status"), yes(p != "5-LOW").alias("proposed_decision"), yes(F.col("o_orderstatus") == "F").alias("reviewer"), yes(F.col("o_orderstatus") != "P").alias("decision_reason"), yes(F.col("o_custkey") % 5 == 0).alias("corrected_value"),
        yes(F.col("o_custkey") % 7 == 0).alias("corrected_unit"), F.lit("").alias("corrected_year"), F.lit("False").alias("validated_indicator"), F.lit("False").alias("score_produced"), F.col("o_orderkey").alias("document_id"),
        F.lit("c").alias("candidate_id"), F.lit(1).alias("page_number"), yes(F.col("o_orderkey") % 11 != 0).alias("quote"),
    )
    return Q.audit(rows, Q.review_rules())


ENGINE_ROWS = f"""
    {CANDIDATES}, t AS (SELECT *, 0.4 + page_number * 0.04 AS confidence, CASE source_engine WHEN 'table' THEN CASE WHEN l_suppkey % 2 = 0 THEN 'table_metric_candidate' ELSE 'target' END WHEN 'visual' THEN 'visual_metric' ELSE 'target' END AS kind FROM cand),
    r AS (SELECT *, count(*) OVER (PARTITION BY document_id, kind, raw_value, page_number, quote) > 1 AS twice FROM t)
"""


@query(audit_sql(ENGINE_ROWS, [
    ("review_required_missing_or_false", "error", "l_linestatus <> 'O'"), ("extraction_status_not_candidate_only", "error", "false"), ("confidence_above_allowed_threshold", "error", "confidence > CASE source_engine WHEN 'visual' THEN 0.5 ELSE 0.6 END"),
    ("probable_duplicates", "warning", "twice"), ("deduplicated_duplicate_candidates", "warning", "false"), ("source_engine_information_type_mismatch", "warning", "source_engine = 'table' AND kind <> 'table_metric_candidate'"),
    ("candidates_without_source", "warning", "false"), ("candidates_without_quote", "warning", "false"),
]))
def consolidated_audit(spark: SparkSession, d: str) -> DataFrame:
    engine = F.col("source_engine")
    kind = F.when(engine == "table", F.when(F.col("l_suppkey") % 2 == 0, F.lit("table_metric_candidate")).otherwise(F.lit("target"))).when(engine == "visual", F.lit("visual_metric")).otherwise(F.lit("target"))
    rows = _candidates(spark, d).withColumns({
        "information_type": kind, "confidence": (F.lit(40) + F.col("page_number") * 4).cast("decimal(6,2)") / 100, "review_required": F.when(F.col("l_linestatus") == "O", F.lit("True")), "extraction_status": F.lit("candidate_only"),
        "deduplication_status": F.lit("unique"), "evidence_id": F.lit("e"), "table_id": F.lit(""), "figure_id": F.lit(""),
    })
    return Q.audit(rows, Q.consolidated_rules())


@query(f"""
    WITH {CANDIDATES}, e AS (
        SELECT document_id, page_number, list_filter([CASE WHEN company = 0 THEN 'company_empty' END, CASE WHEN l_linestatus = 'F' AND l_suppkey % 4 = 0 THEN 'invalid_candidate_status' END,
            CASE WHEN NOT (l_linestatus = 'F' AND l_suppkey % 4 = 0) AND trim(raw_value) = '' THEN 'raw_value_empty' END, CASE WHEN l_partkey = 26 THEN 'raw_value_is_iso_number' END], lambda x: x IS NOT NULL) AS errors
        FROM (SELECT *, CASE WHEN l_partkey = 26 THEN 'ISO 26000' ELSE raw_value END AS rv FROM cand) WHERE true
    )
    SELECT document_id, page_number, array_to_string(errors, ',') AS errors, len(errors) = 0 AS is_valid FROM e
""".replace("trim(raw_value) = ''", "trim(rv) = ''"))
def targeted_contract(spark: SparkSession, d: str) -> DataFrame:
    rows = _candidates(spark, d).withColumns({
        "company": F.when(F.col("company") != 0, F.col("company")), "candidate_status": F.when((F.col("l_linestatus") == "F") & (F.col("l_suppkey") % 4 == 0), F.lit("done")).otherwise(F.lit("candidate_found")),
        "raw_value": F.when(F.col("l_partkey") == 26, F.lit("ISO 26000")).otherwise(F.col("raw_value")),
    })
    out = Q.row_errors(rows, Q.targeted_errors())
    return out.select("document_id", "page_number", F.array_join("errors", ",").alias("errors"), "is_valid")


@query(f"""
    WITH {CANDIDATES}
    SELECT 'source_engine' AS measure, source_engine AS key, count(*) AS n FROM cand GROUP BY 2 UNION ALL SELECT 'indicator_family', indicator_family, count(*) FROM cand GROUP BY 2 UNION ALL SELECT 'validation_status', validation_status, count(*) FROM cand GROUP BY 2
""")
def candidate_distributions(spark: SparkSession, d: str) -> DataFrame:
    return T.distributions(_candidates(spark, d), ["source_engine", "indicator_family", "validation_status"])


@query(f"WITH {CANDIDATES} SELECT source_engine, validation_status, count(*) AS n FROM cand GROUP BY 1, 2")
def modality_policies(spark: SparkSession, d: str) -> DataFrame:
    return T.crossed(_candidates(spark, d), "source_engine", "validation_status")


@query(f"""
    WITH {CANDIDATES}
    SELECT document_id, page_number, l_partkey, l_suppkey, CASE WHEN (l_suppkey % 2 = 0)::INT + (l_partkey % 3 = 0)::INT + (l_partkey % 5 = 0)::INT > 1 THEN 'mixed' WHEN l_partkey % 3 = 0 THEN 'table_cell' WHEN l_partkey % 5 = 0 THEN 'visual_figure' WHEN l_suppkey % 2 = 0 THEN 'text_evidence' ELSE 'unknown' END AS trace_type FROM cand
""")
def trace_types(spark: SparkSession, d: str) -> DataFrame:
    has = lambda c: F.when(c, F.lit("x"))
    kind = A.trace_type(has(F.col("l_suppkey") % 2 == 0), has((F.col("l_partkey") % 3 == 0) & (F.col("page_number") < 3)), has((F.col("l_partkey") % 3 == 0) & (F.col("page_number") >= 3)), has(F.col("l_partkey") % 5 == 0))
    return _candidates(spark, d).select("document_id", "page_number", "l_partkey", "l_suppkey", kind.alias("trace_type"))


@query("""
    WITH t AS (SELECT c_custkey, n_name, c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey),
    m AS (SELECT o_custkey, min(CASE WHEN o_custkey % 3 = 0 THEN 'data/x/' ELSE 'data/' || o_custkey || '/' END) AS path, count(*) AS manifests FROM orders GROUP BY 1)
    SELECT c_custkey, coalesce(manifests, 0) AS manifests, CASE WHEN path IS NULL THEN 'no_manifest' WHEN c_custkey % 4 = 0 AND c_custkey % 3 <> 0 THEN 'file_missing' WHEN c_custkey % 3 = 0 THEN 'path_inconsistent' ELSE 'ok' END AS state
    FROM t LEFT JOIN m ON c_custkey = o_custkey
""")
def run_coverage(spark: SparkSession, d: str) -> DataFrame:
    tasks = table(spark, d, "customer").select("c_custkey")
    key = F.col("o_custkey").cast("string")
    manifests = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.when(F.col("o_custkey") % 3 == 0, F.lit("data/x/")).otherwise(F.concat(F.lit("data/"), key, F.lit("/"))).alias("path"))
    return Q.run_coverage(tasks, manifests, manifests.filter("c_custkey % 4 <> 0 OR c_custkey % 3 = 0").select("path"), ["c_custkey"], "path")


@query("""
    SELECT 'customers_with_orders' AS check_name, (SELECT count(DISTINCT c_custkey) FROM customer) AS expected, (SELECT count(DISTINCT o_custkey) FROM orders) AS found, CASE WHEN (SELECT count(DISTINCT c_custkey) FROM customer) = (SELECT count(DISTINCT o_custkey) FROM orders) THEN 'pass' ELSE 'fail' END AS status
    UNION ALL SELECT 'orders_with_lines', (SELECT count(DISTINCT o_orderkey) FROM orders), (SELECT count(DISTINCT l_orderkey) FROM lineitem), CASE WHEN (SELECT count(DISTINCT o_orderkey) FROM orders) = (SELECT count(DISTINCT l_orderkey) FROM lineitem) THEN 'pass' ELSE 'fail' END
""")
def consistency_report(spark: SparkSession, d: str) -> DataFrame:
    t = lambda name, column: table(spark, d, name).select(F.col(column).alias("k"))
    return Q.reconciled({"customers_with_orders": (t("customer", "c_custkey"), t("orders", "o_custkey"), "k"), "orders_with_lines": (t("orders", "o_orderkey"), t("lineitem", "l_orderkey"), "k")})
