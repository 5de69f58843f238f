"""Queries over paragraphs, tables, sections and joined artifacts, built from the columns of orders
and their lines, so that SQL can say from the columns what the rules must find in the texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import MARKED, PLAIN
from ..operators import artifacts as A, audits as Q, blocks as B, corpus as C, document_checks as K, metrics as M, retrieval as R, scoring, statistics as T, tables
from .registry import query, table


@query()
def paragraph_evidence(spark: SparkSession, d: str) -> DataFrame:
    """Where a run ends depends on its length: tested against a plain loop. Lines of documents stand for paragraphs."""
    lines = M.document_lines(table(spark, d, "documents"), "doc_id", "text").withColumns({"section": F.lit("s"), "page": F.lit(1)})
    rows = lines.filter(B.makes_evidence(F.col("text"), F.lit("paragraph")))
    return B.paragraph_evidence(rows, "doc_id", "section", "page", "line", "text").select("doc_id", "line", "quote", "blocks", "characters", "truncated", "review_short")


@query()
def metrics_of_documents(spark: SparkSession, d: str) -> DataFrame:
    """Whole documents, loose matches too: tested against a plain loop."""
    words = [("in the", "m1", "M1", "%"), ("und der", "m2", "M2", "GWh"), ("the tion and", "m3", "M3", "t"), ("que los", "m4", "M4", "m3")]
    return M.metric_candidates(M.document_lines(table(spark, d, "documents"), "doc_id", "text"), "doc_id", "line", "text", words)


@query(rf"""
    WITH t AS (SELECT doc_id, source, text, trim(regexp_replace(translate(lower(text), '{MARKED}', '{PLAIN}'), '\s+', ' ', 'g')) AS low, doc_id % 9 = 0 AS broken, 2020 + doc_id % 5 AS fy FROM documents),
    f AS (SELECT *, contains(low, 'that') AS company, contains(low, 'tion') OR contains(low, 'ung') AS kind, list_transform(regexp_extract_all(text, '\b(?:19|20)[0-9][0-9]\b'), lambda y: CAST(y AS INT)) AS ys FROM t)
    SELECT doc_id, CASE WHEN broken THEN 'unreadable' WHEN low = '' THEN 'needs_review' WHEN NOT company AND length(low) > 500 THEN CASE WHEN kind THEN 'needs_review' ELSE 'likely_wrong_company' END
           WHEN kind AND len(ys) > 0 AND NOT list_has_any(ys, [fy, fy - 1]) THEN 'needs_review' WHEN kind THEN 'likely_valid' ELSE 'needs_review' END AS status FROM f
""")
def document_validation(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    technical = F.when(F.col("doc_id") % 9 == 0, F.lit("not_pdf")).otherwise(F.lit("valid_pdf"))
    v = scoring.document_validation(F.col("text"), technical, F.lit("That"), F.lit("no-such-slug"), (F.lit(2020) + F.col("doc_id") % 5).cast("int"), ["tion", "ung"])
    return docs.select("doc_id", v["status"].alias("status"))


@query("""
    WITH d AS (
        SELECT o_orderkey, o_custkey, CASE o_orderpriority WHEN '1-URGENT' THEN '01_urd_annual_report' WHEN '2-HIGH' THEN '02_sustainability_statement_csrd_esrs' WHEN '3-MEDIUM' THEN '' ELSE '03_other' END AS kind,
               o_orderkey % 10 = 0 AS unreadable, o_orderstatus = 'O' AS wrong, o_orderkey % 3 = 0 AS chapter, o_orderkey % 4 = 0 AS csrd FROM orders
    ), a AS (SELECT *, kind <> '' AND NOT unreadable AS lft FROM d),
    b AS (SELECT *, bool_or(lft AND NOT (wrong AND NOT unreadable)) OVER (PARTITION BY o_custkey, kind) AND wrong AS away FROM a),
    c AS (SELECT *, bool_or(lft AND NOT away AND csrd) OVER (PARTITION BY o_custkey, kind) AS newer FROM b)
    SELECT o_orderkey, CASE WHEN kind = '' THEN 'needs_review' WHEN unreadable THEN 'unreadable' WHEN away THEN 'likely_wrong_company' WHEN kind = '01_urd_annual_report' AND chapter THEN 'integrated_in_urd'
           WHEN kind = '02_sustainability_statement_csrd_esrs' AND newer AND NOT csrd THEN 'superseded_by_csrd_statement' END AS rejection FROM c
""")
def batch_rules(spark: SparkSession, d: str) -> DataFrame:
    p, key = F.col("o_orderpriority"), F.col("o_orderkey")
    kind = F.when(p == "1-URGENT", F.lit("01_urd_annual_report")).when(p == "2-HIGH", F.lit("02_sustainability_statement_csrd_esrs")).when(p != "3-MEDIUM", F.lit("03_other"))
    status = F.when(key % 10 == 0, F.lit("unreadable")).when(F.col("o_orderstatus") == "O", F.lit("likely_wrong_company")).otherwise(F.lit("likely_valid"))
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", kind.alias("kind"), status.alias("status"), F.when(key % 3 == 0, F.lit("governance_report")).alias("family"), (key % 4 == 0).alias("csrd"))
    return C.batch_rules(rows, ["o_custkey"], "kind", "status", "family", F.col("csrd")).select("o_orderkey", "rejection")


TABLE_ROWS = """
    t AS (SELECT l_orderkey, count(*) AS rows, CAST(min(l_linenumber) AS INT) AS cols, count(*) FILTER (l_returnflag <> 'R') AS filled, count(*) FILTER (l_returnflag = 'A') AS torn, count(*) FILTER (l_linestatus = 'O') AS nums FROM lineitem GROUP BY 1),
    f AS (
        SELECT *, filled = 0 AS e, rows < 2 AS r1, cols < 2 AS c1, filled > 0 AND 1 - filled / rows > 0.5 AS he, filled > 0 AND 1 - filled / rows > 0.8 AS me, rows <= 3 AS tiny, l_orderkey % 7 = 0 OR l_orderkey % 11 = 0 AS toc, torn > 0 AS fr,
               CASE WHEN filled > 0 THEN torn / filled ELSE 0 END > 0.3 AS hf, filled > 0 AND nums / rows < 0.1 AND rows >= 2 AS ln FROM t
    ),
    g AS (SELECT *, (r1 OR c1)::INT + hf::INT + toc::INT + me::INT >= 2 AS art FROM f)
"""
FLAGS = [("e", "all_cells_empty"), ("r1", "single_row_table"), ("c1", "single_column_table"), ("he", "high_empty_cells_ratio"), ("me", "mostly_empty_cells"), ("tiny", "tiny_table_artifact"), ("toc", "front_matter_or_toc_table_like"), ("fr", "fragmented_cells_detected"), ("hf", "high_fragmented_cells_ratio"), ("ln", "low_numeric_density"), ("art", "table_artifact_suspected")]


def _tables(spark: SparkSession, d: str) -> DataFrame:
    n = lambda c: F.count_if(F.expr(c))
    rows = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("row_count"), F.min("l_linenumber").alias("column_count"), n("l_returnflag <> 'R'").alias("filled"), n("l_returnflag = 'A'").alias("fragmented"), n("l_linestatus = 'O'").alias("nums"))
    rows = rows.withColumns({"cells": F.col("row_count"), "empty_ratio": F.lit(1) - F.col("filled") / F.col("row_count"), "numeric_ratio": F.col("nums") / F.col("row_count"), "on_contents_page": F.col("l_orderkey") % 7 == 0, "on_title_page": F.col("l_orderkey") % 11 == 0})
    return T.table_status(rows)


@query(f"""
    WITH {TABLE_ROWS}
    SELECT l_orderkey, CASE WHEN e THEN 'empty_table' WHEN r1 OR c1 OR me OR toc OR hf THEN 'low_confidence' ELSE 'parsed' END AS extraction_status, CAST(CASE WHEN e THEN 0.10 WHEN r1 OR c1 OR me OR toc OR hf THEN 0.35 ELSE 0.70 END AS DOUBLE) AS table_confidence,
           concat_ws(',', {', '.join(f"CASE WHEN {c} THEN '{n}' END" for c, n in FLAGS)}) AS flags, e OR r1 OR c1 OR he OR me OR tiny OR toc OR fr OR hf OR ln AS review_required FROM g
""")
def table_statuses(spark: SparkSession, d: str) -> DataFrame:
    return _tables(spark, d).select("l_orderkey", "extraction_status", "table_confidence", F.array_join("table_quality_flags", ",").alias("flags"), "review_required")


@query(f"WITH {TABLE_ROWS} " + " UNION ALL ".join(f"SELECT '{n}' AS flag, count(*) AS n FROM g WHERE {c} HAVING count(*) > 0" for c, n in FLAGS))
def table_flags(spark: SparkSession, d: str) -> DataFrame:
    return T.of_flags(_tables(spark, d), "table_quality_flags")


@query("""
    WITH s AS (
        SELECT o_orderkey, o_orderpriority = '5-LOW' AS unknown, o_custkey % 9 AS p0, o_custkey % 9 + CASE WHEN o_orderkey % 13 = 0 THEN -1 ELSE 2 END AS p1, o_orderkey % 5 = 0 AS front, o_orderkey % 6 = 0 AS bad, o_orderkey % 8 = 0 AS dense, o_orderkey % 400 AS n, o_orderstatus = 'P' AS weak FROM orders
    ), z AS (
        SELECT o_orderkey, bad, greatest(0, round(1.0 - unknown::INT * 0.10 - (p0 IN (1, 2))::INT * 0.20 - front::INT * 0.25 - bad::INT * 0.35 - dense::INT * 0.15 - (p1 < p0 OR p0 <= 0)::INT * 0.25 - weak::INT * 0.10 - (n <= 1)::INT * 0.10 - (n > 300)::INT * 0.10, 6)) AS s,
               concat_ws(',', CASE WHEN unknown THEN 'unknown_section_type' END, CASE WHEN p0 IN (1, 2) OR front THEN 'front_matter_section' END, CASE WHEN bad THEN 'title_content_mismatch' END, CASE WHEN dense THEN 'high_evidence_density' END,
                         CASE WHEN p1 < p0 OR p0 <= 0 THEN 'suspicious_page_range' END, CASE WHEN weak THEN 'weak_heading_confidence' END, CASE WHEN n <= 1 THEN 'section_too_short' END, CASE WHEN n > 300 THEN 'section_too_long' END) AS reasons FROM s
    )
    SELECT o_orderkey, CAST(s AS DOUBLE) AS section_score, reasons, s < 0.60 OR bad AS is_suspicious, CASE WHEN bad OR s < 0.50 THEN 'quarantine' WHEN s < 0.75 THEN 'review_required' ELSE 'normal' END AS section_policy FROM z
""")
def section_policies(spark: SparkSession, d: str) -> DataFrame:
    key, page = F.col("o_orderkey"), F.col("o_custkey") % 9
    rows = table(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_orderpriority") == "5-LOW", F.lit("unknown")).otherwise(F.lit("climate")).alias("section_type"), page.alias("page_start"), (page + F.when(key % 13 == 0, -1).otherwise(2)).alias("page_end"),
        (key % 5 == 0).alias("is_front"), (key % 6 == 0).alias("is_mismatch"), (key % 8 == 0).alias("is_dense"), (key % 400).alias("evidence"), F.when(F.col("o_orderstatus") != "P", 0.9).alias("confidence"),
    )
    return T.section_policy(rows).select("o_orderkey", "section_score", F.array_join("suspicion_reasons", ",").alias("reasons"), "is_suspicious", "section_policy")


@query("""
    WITH e AS (SELECT o_custkey AS doc, o_orderpriority AS sec FROM orders WHERE o_orderpriority <> '5-LOW'), a AS (SELECT o_custkey AS doc, count(*) AS total FROM orders GROUP BY 1), c AS (SELECT doc, sec, count(*) AS n FROM e GROUP BY 1, 2)
    SELECT doc AS o_custkey, sec AS section, n, round(n / total, 6) AS share, n > 300 OR round(n / total, 6) > 0.70 AS is_dense FROM c JOIN a USING (doc)
""")
def section_densities(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_custkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("section"))
    return T.section_density(rows, "o_custkey", "section")


@query("""
    SELECT count(*) AS evidence_count, count(*) FILTER (role = 'system') AS without_section, count(*) FILTER (length(text) < 60) AS review_required, round(avg(length(coalesce(text, ''))), 6) AS average_quote_length, median(length(coalesce(text, ''))) AS median_quote_length,
           count(*) FILTER (length(coalesce(text, '')) < 60) AS short_evidence, count(*) FILTER (turn > 1) AS merged_evidence, count(*) FILTER (role = 'assistant') AS quarantined, round(avg(turn) FILTER (role = 'user'), 6) AS average_merged_blocks FROM conversations
""")
def evidence_figures(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").select(
        F.col("text").alias("quote"), F.when(F.col("role") != "system", F.col("role")).alias("section"), F.col("turn").alias("blocks"), F.when(F.col("role") == "assistant", F.lit("quarantine")).otherwise(F.lit("normal")).alias("policy"),
        (F.length("text") < 60).alias("review_required"), F.when(F.col("role") == "user", F.lit("paragraph")).otherwise(F.lit("section_heading")).alias("evidence_type"),
    )
    return T.evidence_figures(rows)


@query("""
    SELECT l_returnflag, l_linestatus, count(*) AS n, round(avg(l_quantity), 6) AS mean_quantity, median(l_quantity) AS median_quantity, round(avg(l_extendedprice), 6) AS mean_price, median(l_extendedprice) AS median_price,
           round(avg(l_tax) FILTER (l_discount > 0.03), 6) AS mean_taxed, median(l_tax) FILTER (l_discount > 0.03) AS median_taxed FROM lineitem GROUP BY 1, 2
""")
def group_quantities(spark: SparkSession, d: str) -> DataFrame:
    measures = {"quantity": F.col("l_quantity"), "price": F.col("l_extendedprice"), "taxed": F.when(F.col("l_discount") > 0.03, F.col("l_tax"))}
    return T.quantities(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], measures)


@query("""
    SELECT source, lang, count(*) AS n, round(avg(length(text)), 6) AS mean_characters, median(length(text)) AS median_characters, round(avg(length(text) - length(replace(text, ' ', ''))), 6) AS mean_spaces, median(length(text) - length(replace(text, ' ', ''))) AS median_spaces
    FROM documents GROUP BY 1, 2
""")
def text_quantities(spark: SparkSession, d: str) -> DataFrame:
    """Whole texts; one source holds a third of all documents in the larger tables."""
    size = F.length("text")
    return T.quantities(table(spark, d, "documents"), ["source", "lang"], {"characters": size, "spaces": size - F.length(F.replace("text", F.lit(" "), F.lit("")))})


@query("""
    WITH e AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag AS k FROM lineitem),
    t AS (SELECT p_partkey, p_size FROM part WHERE p_partkey % 4 <> 0), g AS (SELECT s_suppkey, s_nationkey FROM supplier WHERE s_suppkey % 3 <> 0)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE k WHEN 'R' THEN 'table' WHEN 'A' THEN 'figure' ELSE 'text' END AS source_modality,
           CASE WHEN k = 'R' AND p_partkey IS NOT NULL THEN CASE WHEN p_size % 2 = 0 THEN 'low,empty_table' ELSE 'low' END WHEN k = 'A' AND s_suppkey IS NOT NULL THEN 'blurry' ELSE '' END AS flags,
           CAST(CASE WHEN k = 'R' AND p_partkey IS NOT NULL THEN 0.35 WHEN k = 'A' AND s_suppkey IS NOT NULL THEN 0.45 ELSE 0.9 END AS DOUBLE) AS object_confidence
    FROM e LEFT JOIN t ON k = 'R' AND l_partkey = p_partkey LEFT JOIN g ON k = 'A' AND l_suppkey = s_suppkey
""")
def multimodal_evidence(spark: SparkSession, d: str) -> DataFrame:
    """Tables are found by their element's id for odd lines, and by table_id, the fallback, for even ones."""
    k, odd = F.col("l_returnflag"), F.col("l_linenumber") % 2 == 1
    kind = F.when(k == "R", F.lit("table_row")).when(k == "A", F.lit("figure_caption")).otherwise(F.lit("paragraph"))
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", kind.alias("evidence_type"), F.lit("x").alias("source_element_type"), F.when(k == "A", F.col("l_suppkey")).when(odd, F.col("l_partkey")).alias("source_element_id"),
        F.col("l_partkey").alias("table_id"), F.lit(None).cast("long").alias("figure_id"), F.lit(0.9).alias("evidence_confidence"),
    )
    t = table(spark, d, "part").filter("p_partkey % 4 <> 0").select(F.col("p_partkey").alias("table_id"), F.array(F.lit("low")).alias("flags"), F.lit(0.35).alias("confidence"), F.when(F.col("p_size") % 2 == 0, F.lit("empty_table")).otherwise(F.lit("parsed")).alias("status"), F.lit(1).alias("pos"))
    g = table(spark, d, "supplier").filter("s_suppkey % 3 <> 0").select(F.col("s_suppkey").alias("figure_id"), F.array(F.lit("blurry")).alias("flags"), F.lit(0.45).alias("confidence"), F.lit(1).alias("pos"))
    out = A.multimodal_index(rows, t, g)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "source_modality", F.array_join("object_quality_flags", ",").alias("flags"), "object_confidence")


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_partkey % 4 WHEN 0 THEN 'MWh' WHEN 1 THEN 'tCO2e' WHEN 2 THEN 'm3' ELSE '%' END AS unit, ['cell', 'column_header', 'row_header', 'table_title'][l_partkey % 4 + 1] AS unit_source, l_partkey % 4 = 1 AND l_suppkey % 2 = 0 AS unit_conflict,
           l_partkey % 4 <> 0 AND l_linenumber = 1 AS is_footnote, l_partkey % 4 <> 0 AND l_linenumber = 2 AS is_iso, l_partkey % 4 <> 0 AND l_linenumber = 3 AS is_section_number FROM lineitem
""")
def cell_contexts(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.audits import iso_number

    k, n = F.col("l_partkey") % 4, F.col("l_linenumber")
    plain = F.when(n == 1, F.lit("(a)")).when(n == 2, F.lit("ISO 14001")).when(n == 3, F.lit("4.1.2")).otherwise(F.lit("12 000"))
    cell = F.when(k == 0, F.lit("12 MWh")).otherwise(plain)
    column = F.when(k == 1, F.lit("in tCO2e"))
    row = F.when(k == 2, F.lit("Water, m3")).when((k == 1) & (F.col("l_suppkey") % 2 == 0), F.lit("GWh used"))
    c = R.cell_context(cell, column, row, F.when(k == 3, F.lit("Shares in %")), ["MWh", "GWh", "tCO2e", "m3", "%"], iso_number(cell))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", c.alias("c")).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "c.*")


@query("""
    WITH c AS (SELECT DISTINCT l_orderkey, CAST(l_linenumber AS INT) AS r, l_partkey, l_suppkey, l_quantity FROM lineitem),
    t AS (SELECT l_orderkey, r, string_agg(x, ' ' ORDER BY p, x) AS row_text FROM (SELECT l_orderkey, r, l_partkey AS p, 'P' || l_partkey AS x FROM c WHERE l_suppkey % 3 <> 0) GROUP BY 1, 2)
    SELECT k.l_orderkey, k.r AS row, coalesce(row_text, '') AS row_text FROM (SELECT DISTINCT l_orderkey, r FROM c) k LEFT JOIN t USING (l_orderkey, r)
""")
def table_row_texts(spark: SparkSession, d: str) -> DataFrame:
    cells = table(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("int").alias("row"), F.col("l_partkey").alias("column"), "l_suppkey", "l_quantity").distinct()
    cells = cells.withColumn("text", F.when(F.col("l_suppkey") % 3 != 0, F.concat(F.lit("P"), F.col("column").cast("string"))).otherwise(F.lit(" ")))
    return tables.row_texts(cells, "l_orderkey", "row", "column", "text")


@query("""
    SELECT l_orderkey, arg_min(l_returnflag, (l_linestatus <> 'O', l_linenumber, l_partkey * 100000 + l_suppkey)) AS context_unit FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1
""")
def table_context_units(spark: SparkSession, d: str) -> DataFrame:
    cells = table(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("row"), (F.col("l_partkey") * 100000 + F.col("l_suppkey")).alias("column"), F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("unit"), (F.col("l_linestatus") == "O").alias("is_header"))
    return tables.context_unit(cells, "l_orderkey", "row", "column", "unit", "is_header")


@query("""
    WITH i AS (SELECT o_custkey AS c, year(o_orderdate) AS y, arg_min(o_clerk, o_orderkey) AS nm, arg_min(o_orderkey, o_orderkey) AS f FROM (SELECT *, o_orderpriority AS o_clerk FROM orders WHERE o_orderstatus = 'F') GROUP BY 1, 2)
    SELECT o_orderkey, coalesce(nm, CAST(o_custkey AS VARCHAR)) AS company_name, coalesce(CAST(f AS VARCHAR), '') AS final_path FROM orders LEFT JOIN i ON c = o_custkey AND y = year(o_orderdate)
""")
def records_with_index(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("company"), F.year("o_orderdate").alias("fiscal_year"), "o_orderstatus", "o_orderpriority")
    index = rows.filter("o_orderstatus = 'F'").select("company", "fiscal_year", F.col("o_orderpriority").alias("company_name"), F.col("o_orderkey").cast("string").alias("final_path"), F.col("o_orderkey").alias("pos"))
    return A.with_index(rows.select("o_orderkey", "company", "fiscal_year"), index, "pos").select("o_orderkey", "company_name", "final_path")


@query("""
    WITH f AS (SELECT o_orderkey AS ident, o_custkey AS doc, CAST(year(o_orderdate) AS INT) AS page, CAST(o_orderkey % 3 AS VARCHAR) AS bare, 0.3 AS c FROM orders WHERE o_orderstatus <> 'O'),
    s AS (SELECT o_orderkey AS ident, o_custkey AS doc, CAST(year(o_orderdate) AS INT) AS page, CAST(o_orderkey % 3 AS VARCHAR) AS bare, CASE WHEN o_orderkey % 2 = 0 THEN 0.5 ELSE 0.2 END AS c FROM orders WHERE o_orderstatus = 'O'),
    b AS (SELECT doc, page, bare, max(c) AS theirs FROM s GROUP BY 1, 2, 3), k AS (SELECT doc, page, bare, min(ident) AS first FROM f GROUP BY 1, 2, 3)
    SELECT f.ident, CAST(CASE WHEN ident = first AND theirs > c THEN theirs ELSE c END AS DOUBLE) AS confidence, CASE WHEN ident = first AND theirs > c THEN 'both' ELSE 'rules' END AS engine FROM f JOIN k USING (doc, page, bare) LEFT JOIN b USING (doc, page, bare)
    UNION ALL SELECT ident, CAST(c AS DOUBLE), 'spans' FROM s ANTI JOIN k USING (doc, page, bare)
""")
def merged_spans(spark: SparkSession, d: str) -> DataFrame:
    """Values differ in the signs between their digits alone."""
    digit = (F.col("o_orderkey") % 3).cast("string")
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("ident"), F.col("o_custkey").alias("doc"), F.year("o_orderdate").alias("page"), "o_orderstatus", digit.alias("value"), F.when(F.col("o_orderkey") % 2 == 0, 0.5).otherwise(0.2).alias("confidence"))
    found = rows.filter("o_orderstatus <> 'O'").withColumns({"confidence": F.lit(0.3), "value": F.concat(F.lit(" "), F.col("value"), F.lit(", "))}).drop("o_orderstatus")
    return M.merge_spans(found, rows.filter("o_orderstatus = 'O'").drop("o_orderstatus"), "doc", "page", "value", "confidence", "ident").select("ident", "confidence", "engine")


@query("""
    WITH o AS (SELECT o_custkey AS doc, count(*) AS orders, count(*) FILTER (o_orderstatus = 'F') AS orders_done FROM orders GROUP BY 1), c AS (SELECT c_custkey AS doc, count(*) AS customers FROM customer WHERE c_acctbal > 0 GROUP BY 1)
    SELECT coalesce(o.doc, c.doc) AS doc, coalesce(orders, 0) AS orders, coalesce(orders_done, 0) AS orders_done, coalesce(customers, 0) AS customers FROM o FULL JOIN c ON o.doc = c.doc
""")
def document_inventory(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").withColumnRenamed("o_custkey", "doc")
    customers = table(spark, d, "customer").filter("c_acctbal > 0").withColumnRenamed("c_custkey", "doc")
    return T.inventory("doc", orders=(orders, {"done": F.col("o_orderstatus") == "F"}), customers=(customers, {}))


@query("""
    WITH c AS (SELECT conv_id, turn, text, CASE WHEN turn = 0 THEN 'header' WHEN role = 'system' THEN 'table_caption' ELSE 'paragraph' END AS k FROM conversations WHERE trim(text) <> ''),
    s AS (SELECT *, CASE k WHEN 'header' THEN 'page_context' WHEN 'table_caption' THEN 'figure_caption' ELSE 'paragraph' END AS source_type FROM c)
    SELECT CAST(conv_id AS VARCHAR) AS document_id, source_type, 'chunk_' || substr(md5(conv_id || '|' || source_type || '|' || turn), 1, 20) AS chunk_id, trim(text) AS text FROM s
""")
def block_chunks(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("turn") == 0, F.lit("header")).when(F.col("role") == "system", F.lit("table_caption")).otherwise(F.lit("paragraph"))
    rows = table(spark, d, "conversations").select(F.col("conv_id").alias("document_id"), F.col("turn").alias("page_number"), F.lit("s").alias("section_id"), kind.alias("block_type"), F.col("turn").alias("text_block_id"), "text")
    return A.text_chunks(rows).select("document_id", "source_type", "chunk_id", "text")


@query(r"""
    WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM documents),
    p AS (SELECT doc_id, sum(length(x)) AS n, count(*) AS blocks, count(*) FILTER (length(x) <= 90) AS titles, count(*) FILTER (length(x) <= 90 AND regexp_matches(x, '[0-9]$')) AS numbered FROM l GROUP BY 1)
    SELECT doc_id, 'page_low_text_warning' AS check_name, 'warning' AS severity FROM p WHERE n < 100 UNION ALL SELECT doc_id, 'possible_visual_page', 'warning' FROM p WHERE n > 0 AND n < 100 AND doc_id % 2 = 0
    UNION ALL SELECT doc_id, 'possible_table_of_contents_page', 'warning' FROM p WHERE titles >= 8 AND numbered >= 5 UNION ALL SELECT doc_id, 'high_title_density_warning', 'warning' FROM p WHERE titles / blocks > 0.6
""")
def page_checks(spark: SparkSession, d: str) -> DataFrame:
    lines, short = M.document_lines(table(spark, d, "documents").filter("text IS NOT NULL"), "doc_id", "text"), F.length("text") <= 90
    pages = lines.groupBy("doc_id").agg(F.sum(F.length("text")).alias("characters"), F.count(F.lit(1)).alias("blocks"), F.count_if(short).alias("titles"), F.count_if(short & F.col("text").rlike("[0-9]$")).alias("titles_with_number"))
    return K.findings(pages.withColumn("extraction_status", F.when(F.col("doc_id") % 2 == 0, F.lit("ok")).otherwise(F.lit("none"))), K.page_rules(), ["doc_id"])


@query(f"""
    WITH {TABLE_ROWS}, s AS (SELECT *, CASE WHEN e THEN 'empty_table' WHEN r1 OR c1 OR me OR toc OR hf THEN 'low_confidence' ELSE 'parsed' END AS status FROM g)
    SELECT l_orderkey, unnest(list_filter([CASE WHEN l_orderkey % 3 = 0 THEN 'table_section_link_valid' END, CASE WHEN status = 'low_confidence' THEN 'table_low_confidence_warning' END, CASE WHEN e THEN 'empty_table_detected' END, CASE WHEN me THEN 'mostly_empty_table_warning' END,
           CASE WHEN tiny THEN 'tiny_table_artifact_warning' END, CASE WHEN toc THEN 'front_matter_or_toc_table_warning' END, CASE WHEN hf THEN 'fragmented_table_warning' END, CASE WHEN art THEN 'table_artifact_suspected_warning' END], lambda x: x IS NOT NULL)) AS check_name, 'warning' AS severity FROM s
""")
def table_checks(spark: SparkSession, d: str) -> DataFrame:
    rows = _tables(spark, d).withColumns({"section_id": F.when(F.col("l_orderkey") % 3 != 0, F.lit("s")), "bad_cells": F.lit(0)})
    return K.findings(rows, K.table_rules(), ["l_orderkey"])


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_partkey % 4 WHEN 0 THEN l_suppkey % 3 = 0 WHEN 1 THEN l_suppkey % 3 IN (0, 1) ELSE false END AS mismatch, l_suppkey % 5 = 0 AS is_note, l_linenumber IN (1, 2) AS agreed FROM lineitem
""")
def review_signals(spark: SparkSession, d: str) -> DataFrame:
    """Units that a family can't have, labels that are notes, and words by which a reviewer agrees."""
    family = F.when(F.col("l_partkey") % 4 == 0, F.lit("energy")).when(F.col("l_partkey") % 4 == 1, F.lit("water")).otherwise(F.lit("governance"))
    unit = F.when(F.col("l_suppkey") % 3 == 0, F.lit("tCO2e")).when(F.col("l_suppkey") % 3 == 1, F.lit("EUR per unit")).otherwise(F.lit("m3"))
    label = F.when(F.col("l_suppkey") % 5 == 0, F.lit("Sites, See Note 3")).otherwise(F.lit("Sites"))
    said = F.element_at(F.array(*map(F.lit, ("Yes, of course", "approved", "accept_candidate", "no", "invalid", "okay", "unsure"))), F.col("l_linenumber").cast("int"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", Q.unit_mismatch(unit, family).alias("mismatch"), Q.is_note_label(label).alias("is_note"), Q.agrees(said).alias("agreed"))
