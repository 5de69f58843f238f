"""Queries of the candidate and value paths. Orders stand for facts of a company (customer), year and variable (priority)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import best_metric, canonical_numeric, converted, first_metric, unit_name, year_with_source
from ..functions.text import years
from ..operators import candidates as C, kpi as K, variables as V
from ..operators.corpus import first_of
from .registry import query, table

VARIABLES = ["urgent", "high", "medium", "not_specified", "low"]


def _facts(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    name = F.lower(F.replace(F.regexp_extract("o_orderpriority", r"^\d-(.*)$", 1), F.lit(" "), F.lit("_")))
    return orders.select(
        F.col("o_custkey").alias("company"),
        F.year("o_orderdate").alias("year"),
        name.alias("variable_name"),
        F.when(F.col("o_orderstatus") != "P", F.floor(F.col("o_totalprice") / 50000).cast("string")).alias("value"),
        F.lit("EUR").alias("unit"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("quote"),
        F.col("o_orderkey").alias("ident"),
    )


def _selected(spark: SparkSession, d: str) -> DataFrame:
    facts = _facts(spark, d)
    entities = facts.select("company", "year").distinct()
    return V.select_values(facts, entities, VARIABLES, canonical_numeric(F.col("value")), [F.col("value").isNull(), "ident"])


FACTS = """
    facts AS (
        SELECT o_custkey AS company, CAST(year(o_orderdate) AS INT) AS year, lower(replace(regexp_extract(o_orderpriority, '^[0-9]-(.*)$', 1), ' ', '_')) AS variable_name,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(floor(o_totalprice / 50000) AS BIGINT) AS VARCHAR) END AS value, 'EUR' AS unit, 'order ' || o_orderkey AS quote, o_orderkey AS ident
        FROM orders
    ),
    groups AS (
        SELECT company, year, variable_name, count(*) AS candidates, count(DISTINCT value) AS distinct_values, count(quote) AS quotes,
               arg_min(value, (value IS NULL, ident)) AS b_value, arg_min(quote, (value IS NULL, ident)) AS b_quote, arg_min(ident, (value IS NULL, ident)) AS b_ident
        FROM (SELECT * FROM facts) GROUP BY 1, 2, 3
    ),
    dense AS (SELECT * FROM (SELECT DISTINCT company, year FROM facts) CROSS JOIN (SELECT unnest(['urgent','high','medium','not_specified','low']) AS variable_name)),
    s0 AS (
        SELECT dense.*, g.candidates, g.b_value, g.b_quote, g.b_ident,
               CASE WHEN g.candidates IS NULL THEN 'missing_from_corpus' WHEN distinct_values > 1 THEN 'conflicting_values' WHEN distinct_values = 1 THEN 'found' WHEN quotes > 0 THEN 'qualitative_only' ELSE 'needs_review' END AS value_status
        FROM dense LEFT JOIN groups g USING (company, year, variable_name)
    ),
    selected AS (
        SELECT company, year, variable_name, CASE WHEN value_status = 'found' THEN b_value END AS value, CASE WHEN value_status = 'found' THEN 'EUR' END AS unit, value_status, coalesce(candidates, 0) AS candidates, b_quote AS quote, b_ident AS ident
        FROM s0
    )
"""


@query(f"WITH {FACTS} SELECT * FROM selected")
def value_selection_long(spark: SparkSession, d: str) -> DataFrame:
    return _selected(spark, d)


@query(f"WITH {FACTS} SELECT company, year, " + ", ".join(f"max(value) FILTER (variable_name = '{v}') AS {v}" for v in VARIABLES) + " FROM selected GROUP BY 1, 2")
def value_selection_wide(spark: SparkSession, d: str) -> DataFrame:
    return V.wide(_selected(spark, d), VARIABLES)


@query(f"WITH {FACTS} SELECT company, year, " + ", ".join(f"max({c}) FILTER (variable_name = '{v}') AS {v}_{c}" for v in VARIABLES for c in ("value", "unit", "value_status", "quote")) + " FROM selected GROUP BY 1, 2")
def value_selection_enriched(spark: SparkSession, d: str) -> DataFrame:
    return V.wide(_selected(spark, d), VARIABLES, ("value", "unit", "value_status", "quote"))


@query(f"""
    WITH {FACTS}
    SELECT company, year, variable_name, value_status, CASE value_status WHEN 'missing_from_corpus' THEN 'add_documents' WHEN 'conflicting_values' THEN 'resolve_conflict' WHEN 'qualitative_only' THEN 'seek_number' ELSE 'review_candidate' END AS recommended_action
    FROM selected WHERE value_status <> 'found'
""")
def missing_report(spark: SparkSession, d: str) -> DataFrame:
    return V.missing_report(_selected(spark, d))


@query(f"WITH {FACTS} SELECT company, year, variable_name, value, ident, o_orderstatus AS evidence_status, quote IS NOT NULL AS trace_complete FROM selected JOIN orders ON ident = o_orderkey WHERE value_status = 'found'")
def lineage_long(spark: SparkSession, d: str) -> DataFrame:
    evidence = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("evidence_status"))
    return V.lineage(_selected(spark, d), evidence, "o_orderkey").select("company", "year", "variable_name", "value", "ident", "evidence_status", "trace_complete")


@query(f"WITH {FACTS} SELECT company, year, variable_name, value, unit, value_status, candidates, quote, ident FROM selected WHERE value_status = 'found' AND ident NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def untraced_values(spark: SparkSession, d: str) -> DataFrame:
    """Orders with a returned line are those with evidence."""
    out = V.untraced(_selected(spark, d), table(spark, d, "lineitem").filter("l_returnflag = 'R'").select("l_orderkey").distinct(), "l_orderkey")
    return out.select("company", "year", "variable_name", "value", "unit", "value_status", "candidates", "quote", "ident")


@query(f"WITH {FACTS} SELECT count(*) AS cells, count(*) FILTER (value_status = 'found') AS found, round(count(*) FILTER (value_status = 'found') * 100.0 / count(*), 1) AS found_pct FROM selected")
def completion(spark: SparkSession, d: str) -> DataFrame:
    return V.completion(_selected(spark, d))


@query(f"""
    WITH {FACTS}
    SELECT 'duplicate_cell' AS finding, (SELECT count(*) FROM (SELECT count(*) OVER (PARTITION BY company, year, variable_name) AS k FROM selected) WHERE k > 1) AS n UNION ALL SELECT 'found_without_value', count(*) FROM selected WHERE value_status = 'found' AND value IS NULL
    UNION ALL SELECT 'value_without_found', count(*) FROM selected WHERE value_status <> 'found' AND value IS NOT NULL UNION ALL SELECT 'found_without_quote', count(*) FROM selected WHERE value_status = 'found' AND quote IS NULL
    UNION ALL SELECT 'conflicting_values', count(*) FROM selected WHERE value_status = 'conflicting_values' UNION ALL SELECT 'missing_from_corpus', count(*) FROM selected WHERE value_status = 'missing_from_corpus'
""")
def dataset_findings(spark: SparkSession, d: str) -> DataFrame:
    return V.quality_findings(_selected(spark, d))


@query("""
    SELECT o_custkey, o_orderkey, o_totalprice FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus = 'F' DESC, o_totalprice DESC, o_orderdate DESC, o_orderkey) AS rn FROM orders
    ) WHERE rn = 1
""")
def best_value_per_group(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").withColumn("final", F.col("o_orderstatus") == "F")
    return V.best_value(orders, ["o_custkey"], "final", "o_totalprice", "o_orderdate", "o_orderkey").select("o_custkey", "o_orderkey", "o_totalprice")


DICTIONARY = [
    (0, "steel_parts", ["economy"], ["steel"], ["steel", "iron"]),
    (1, "brass_parts", ["standard"], ["brass"], ["brass", "gold"]),
    (2, "copper_parts", ["promo"], ["copper"], ["copper", "red"]),
    (3, "tin_parts", ["large"], ["tin"], ["tin", "grey"]),
]


@query("""
    WITH dict(o, variable_name, k, f, w) AS (VALUES (0, 'steel_parts', 'economy', 'steel', ['steel','iron']), (1, 'brass_parts', 'standard', 'brass', ['brass','gold']), (2, 'copper_parts', 'promo', 'copper', ['copper','red']), (3, 'tin_parts', 'large', 'tin', ['tin','grey'])),
    r AS (SELECT p_partkey, lower(string_split(p_type, ' ')[1]) AS key, lower(string_split(p_type, ' ')[-1]) AS family, lower(p_name) AS label FROM part),
    s AS (
        SELECT p_partkey, o, variable_name, least(round(CASE WHEN key = k THEN 0.7 ELSE 0 END + CASE WHEN family = f THEN 0.45 ELSE 0 END + CASE WHEN len(list_filter(w, lambda x: contains(label, x))) > 0 THEN 0.35 ELSE 0 END, 2), 1.0) AS score
        FROM r CROSS JOIN dict
    ),
    b AS (SELECT p_partkey, max(score) AS score FROM s GROUP BY 1)
    SELECT p_partkey, CASE WHEN b.score > 0 THEN arg_min(variable_name, o) FILTER (s.score = b.score) END AS variable_name, CAST(b.score AS DOUBLE) AS mapping_confidence,
           CASE WHEN b.score <= 0 THEN 'no_match' WHEN count(*) FILTER (s.score = b.score) > 1 THEN 'ambiguous' ELSE 'mapped' END AS mapping_status
    FROM s JOIN b USING (p_partkey) GROUP BY p_partkey, b.score
""")
def variable_mapping(spark: SparkSession, d: str) -> DataFrame:
    dictionary = spark.createDataFrame(DICTIONARY, "variable_order int, variable_name string, keys array<string>, families array<string>, keywords array<string>")
    words = F.split(F.lower("p_type"), " ")
    parts = table(spark, d, "part").select("p_partkey", F.element_at(words, 1).alias("key"), F.element_at(words, -1).alias("family"), F.col("p_name").alias("label"), F.lit("").alias("quote"))
    return V.map_variables(parts, dictionary, "p_partkey")


def _engines(spark: SparkSession, d: str) -> DataFrame:
    """Line items as candidates of three engines; numbers 2 and 3 are seen by two engines each."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag", "l_suppkey")
    base = lines.select(
        F.col("l_orderkey").alias("document_id"), F.col("l_linenumber").alias("page"), F.col("l_quantity").cast("int").cast("string").alias("value"),
        F.concat(F.lit("Part "), F.col("l_partkey").cast("string")).alias("said"), (F.lit(0.3) + F.col("l_linenumber") * 0.02).alias("confidence"), F.col("l_suppkey").alias("sup"), F.col("l_returnflag").alias("flag"),
    )
    parts = {
        "csv": base.filter("page <= 2").withColumnRenamed("said", "quote"),
        "visual": base.filter("page IN (2, 3)").withColumnRenamed("said", "caption"),
        "table": base.filter("page >= 3").withColumnRenamed("said", "source_row_text"),
    }
    every = C.union_engines(parts, {"visual": {"caption": "quote"}, "table": {"source_row_text": "quote"}})
    every = every.withColumn("ident", F.concat_ws(":", "source_engine", F.col("document_id").cast("string"), F.col("page").cast("string"), "quote", "value", F.col("sup").cast("string")))
    return every.withColumn("key", C.consolidation_key(F.col("document_id"), F.lit("metric"), F.col("page"), F.col("value"), F.col("quote"), F.lit(None).cast("string")))


ENGINES = """
    base AS (SELECT l_orderkey AS document_id, l_linenumber AS page, CAST(CAST(l_quantity AS INT) AS VARCHAR) AS value, 'Part ' || l_partkey AS quote, 0.3 + l_linenumber * 0.02 AS confidence, l_suppkey AS sup, l_returnflag AS flag FROM lineitem),
    every AS (
        SELECT *, 'csv' AS source_engine, 2 AS prio FROM base WHERE page <= 2 UNION ALL SELECT *, 'visual', 3 FROM base WHERE page IN (2, 3) UNION ALL SELECT *, 'table', 1 FROM base WHERE page >= 3
    ),
    keyed AS (SELECT *, source_engine || ':' || document_id || ':' || page || ':' || quote || ':' || value || ':' || sup AS ident, document_id || '|metric|' || page || '|' || value || '|' || lower(quote) AS key FROM every)
"""


@query(f"""
    WITH {ENGINES},
    g AS (SELECT key, count(*) AS group_size, count(DISTINCT source_engine) AS engines, arg_min(ident, (prio, -confidence, length(quote), ident)) AS best FROM keyed GROUP BY 1),
    m AS (SELECT source_engine, ident, group_size, engines, confidence, CASE WHEN group_size = 1 THEN 'unique_candidate' WHEN ident = best THEN 'canonical' ELSE 'duplicate' END AS deduplication_status FROM keyed JOIN g USING (key))
    SELECT source_engine, ident, deduplication_status,
           CAST(round(CASE WHEN deduplication_status = 'canonical' AND engines > 1 THEN greatest(round(least(confidence + 0.05 * (group_size - 1), CASE source_engine WHEN 'visual' THEN 0.5 ELSE 0.6 END), 3), confidence) ELSE confidence END, 4) AS DOUBLE) AS confidence
    FROM m
""")
def candidate_consolidation(spark: SparkSession, d: str) -> DataFrame:
    order = [C.engine_rank(F.col("source_engine")), -F.col("confidence"), F.length("quote")]
    marked = C.consensus_boost(C.mark_duplicates(_engines(spark, d), "key", order, "ident", "ident"))
    return marked.select("source_engine", "ident", "deduplication_status", F.round("confidence", 4).alias("confidence"))


@query(f"""
    WITH {ENGINES},
    s AS (SELECT *, CASE WHEN flag = 'A' AND sup % 2 = 0 THEN 'needs_review' ELSE 'possible_indicator' END AS s0, row_number() OVER (PARTITION BY document_id, page, value, quote ORDER BY prio, -confidence, ident) > 1 AS is_duplicate FROM keyed)
    SELECT ident, CASE WHEN is_duplicate THEN 'reject_candidate' WHEN s0 = 'needs_review' AND confidence >= 0.36 THEN 'possible_indicator' ELSE s0 END AS validation_status, is_duplicate FROM s
""")
def candidate_validation(spark: SparkSession, d: str) -> DataFrame:
    rows = _engines(spark, d)
    traced = ~((F.col("flag") == "A") & (F.col("sup") % 2 == 0))
    status = C.validation_status(C.forbidden_signal([F.col("quote")]), F.lit(False), F.lit("ok"), F.col("quote"), traced, F.col("page"), F.col("value"))
    rows = rows.withColumn("validation_status", C.by_confidence(status, F.col("confidence"), accept=0.36))
    rows = C.reject_duplicates(rows, ["document_id", "page", "value", "quote"], [C.engine_rank(F.col("source_engine")), -F.col("confidence"), "ident"], "validation_status")
    return rows.select("ident", "validation_status", "is_duplicate")


@query("""
    WITH dec AS (SELECT doc_id, CASE WHEN quality = 1 AND toxic = 0 THEN 'accept_candidate' WHEN quality = 0 THEN 'reject_candidate' ELSE 'hold' END AS decision FROM labels)
    SELECT d.doc_id, CASE WHEN decision IS NULL THEN 'pending' WHEN decision = 'accept_candidate' THEN 'accepted' WHEN decision = 'reject_candidate' THEN 'rejected' ELSE 'invalid_decision' END AS review_status
    FROM documents d LEFT JOIN dec USING (doc_id)
""")
def review_decisions(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labels")
    decision = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit("accept_candidate")).when(F.col("quality") == 0, F.lit("reject_candidate")).otherwise(F.lit("hold"))
    decisions = labels.select("doc_id", decision.alias("decision"), F.col("doc_id").alias("pos"))
    return C.apply_decisions(table(spark, d, "documents").select("doc_id"), decisions, "doc_id", "decision", "pos").select("doc_id", "review_status")


def _quotes(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")
    unit = F.when(F.col("l_linenumber") % 3 == 0, F.lit("tonnes")).when(F.col("l_linenumber") % 3 == 1, F.lit("MWh")).otherwise(F.lit("parcels"))
    return lines.withColumn("unit_word", unit).withColumn("quote", F.concat_ws(" ", F.lit("Shipment sent:"), (F.col("l_quantity") * 11).cast("int").cast("string"), "unit_word", F.lit("in"), F.year("l_shipdate").cast("string")))


@query("""
    WITH q AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity * 11 AS INT) AS n, CASE l_linenumber % 3 WHEN 0 THEN 'tonnes' WHEN 1 THEN 'MWh' ELSE 'parcels' END AS u, CAST(year(l_shipdate) AS VARCHAR) AS y FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(n AS VARCHAR) AS value, CASE u WHEN 'tonnes' THEN 't' WHEN 'MWh' THEN 'MWh' END AS unit, y AS year, CASE WHEN u = 'MWh' THEN 'converted' ELSE 'unknown_unit' END AS conversion, 'quote' AS year_source, y AS years,
           CASE WHEN u <> 'parcels' OR length(CAST(n AS VARCHAR)) >= 4 THEN CAST(n AS VARCHAR) ELSE y END AS best
    FROM q
""")
def numeric_unit_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Numbers, units and years out of built sentences, with the unit's conversion."""
    rows = _quotes(spark, d).withColumn("m", first_metric(F.col("quote"))).withColumn("y", year_with_source(F.lit(None).cast("string"), F.lit(None).cast("string"), F.col("quote")))
    rows = rows.withColumn("unit", unit_name(F.col("m.unit")))
    conversion = converted(F.col("m.value").cast("double"), F.col("unit"))["status"]
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "m.value", "unit", F.col("y.year").alias("year"), conversion.alias("conversion"), F.col("y.source").alias("year_source"), F.array_join(years(F.col("quote")), ",").alias("years"), best_metric(F.col("quote"))["value"].alias("best"))


@query("""
    SELECT l_returnflag, count(*) AS n, count(DISTINCT l_orderkey) AS documents, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS share_pct FROM lineitem GROUP BY 1
""")
def family_stats(spark: SparkSession, d: str) -> DataFrame:
    return K.family_stats(table(spark, d, "lineitem"), "l_returnflag", "l_orderkey")


STATUS = "CASE l_returnflag WHEN 'R' THEN 'reject_candidate' WHEN 'A' THEN 'needs_review' ELSE 'possible_indicator' END"


def _statused(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_returnflag", "l_discount", "l_tax", "l_linestatus")
    status = F.when(F.col("l_returnflag") == "R", F.lit("reject_candidate")).when(F.col("l_returnflag") == "A", F.lit("needs_review")).otherwise(F.lit("possible_indicator"))
    return lines.select("l_orderkey", status.alias("status"), F.when(F.col("l_discount") > 0.02, F.col("l_discount")).alias("value"), F.when(F.col("l_tax") > 0.02, F.col("l_tax")).alias("unit"), "l_linestatus")


@query(f"""
    WITH s AS (
        SELECT l_orderkey, count(*) AS candidates, count(*) FILTER ({STATUS} = 'possible_indicator') AS possible_indicator, count(*) FILTER ({STATUS} = 'needs_review') AS needs_review, count(*) FILTER ({STATUS} = 'reject_candidate') AS reject_candidate,
               count(*) FILTER (NOT l_discount > 0.02) AS without_value, count(*) FILTER (NOT l_tax > 0.02) AS without_unit FROM lineitem GROUP BY 1
    ), m AS (SELECT *, CAST(round(possible_indicator * 3.0 + needs_review * 1.0 + reject_candidate * 0.3, 1) AS DOUBLE) AS minutes FROM s)
    SELECT *, CASE WHEN minutes < 30 THEN 'low' WHEN minutes < 90 THEN 'medium' WHEN minutes < 240 THEN 'high' ELSE 'excessive' END AS burden FROM m
""")
def document_stats(spark: SparkSession, d: str) -> DataFrame:
    return K.document_stats(_statused(spark, d), "l_orderkey", "status", "value", "unit")


@query("""
    SELECT count(*) AS rows, count(*) FILTER (NOT l_discount > 0.02) AS n_no_value, count(*) FILTER (NOT l_tax > 0.02) AS n_no_unit, count(*) FILTER (l_returnflag = 'R') AS n_rejected,
           round(count(*) FILTER (NOT l_discount > 0.02) * 100.0 / count(*), 4) AS pct_no_value, round(count(*) FILTER (NOT l_tax > 0.02) * 100.0 / count(*), 4) AS pct_no_unit, round(count(*) FILTER (l_returnflag = 'R') * 100.0 / count(*), 4) AS pct_rejected,
           CASE WHEN count(*) FILTER (NOT l_discount > 0.02) * 100.0 / count(*) > 50 OR count(*) FILTER (l_returnflag = 'R') * 100.0 / count(*) > 20 THEN 'NO_GO' WHEN count(*) FILTER (NOT l_discount > 0.02) * 100.0 / count(*) > 30 THEN 'GO_WITH_FIXES' ELSE 'GO' END AS decision
    FROM lineitem
""")
def kpi_block(spark: SparkSession, d: str) -> DataFrame:
    out = K.rates(_statused(spark, d), {"no_value": F.col("value").isNull(), "no_unit": F.col("unit").isNull(), "rejected": F.col("status") == "reject_candidate"})
    return out.withColumn("decision", K.go_decision(F.col("pct_no_value"), F.col("pct_rejected"), F.lit(100)))


@query("""
    SELECT l_returnflag, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem GROUP BY ROLLUP (l_returnflag)
""")
def multi_document_rollup(spark: SparkSession, d: str) -> DataFrame:
    return K.multi_document(table(spark, d, "lineitem"), "l_returnflag", [F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("quantity")])


@query("""
    SELECT n_name, CAST(count(*) FILTER (c_mktsegment = 'BUILDING') AS BIGINT) AS BUILDING, CAST(count(*) FILTER (c_mktsegment = 'MACHINERY') AS BIGINT) AS MACHINERY, CAST(count(*) FILTER (c_mktsegment = 'AUTOMOBILE') AS BIGINT) AS AUTOMOBILE
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
""")
def coverage_matrix(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return K.heat(rows, "n_name", "c_mktsegment", ["BUILDING", "MACHINERY", "AUTOMOBILE"])


@query("""
    WITH p AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer)
    SELECT c_custkey, c_nationkey, c_acctbal FROM p WHERE rn <= 30 ORDER BY c_acctbal DESC, c_custkey LIMIT 200
""")
def top_review_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return K.top_per_group_then_all(rows, ["c_nationkey"], [F.desc("c_acctbal"), "c_custkey"], 30, 200)


@query("""
    SELECT 'negative_balance' AS "check", count(*) FILTER (c_acctbal < 0) AS n, 'medium' AS severity, CASE WHEN count(*) FILTER (c_acctbal < 0) = 0 THEN 'pass' ELSE 'fail' END AS status FROM customer
    UNION ALL SELECT 'blank_name', count(*) FILTER (trim(c_name) = ''), 'high', CASE WHEN count(*) FILTER (trim(c_name) = '') = 0 THEN 'pass' ELSE 'fail' END FROM customer
""")
def contract_checks(spark: SparkSession, d: str) -> DataFrame:
    return K.checks(table(spark, d, "customer"), {"negative_balance": (F.col("c_acctbal") < 0, "medium"), "blank_name": (F.trim("c_name") == "", "high")})


@query("""
    SELECT source, 'text' AS field, count(*) FILTER (length(trim(text)) > 0) AS present, count(*) - count(*) FILTER (length(trim(text)) > 0) AS empty FROM documents GROUP BY 1
    UNION ALL SELECT source, 'lang', count(*) FILTER (length(trim(lang)) > 0), count(*) - count(*) FILTER (length(trim(lang)) > 0) FROM documents GROUP BY 1
""")
def metadata_presence(spark: SparkSession, d: str) -> DataFrame:
    return K.presence(table(spark, d, "documents"), ["source"], ["text", "lang"])


@query("SELECT l_orderkey, l_linenumber FROM lineitem ANTI JOIN (SELECT o_orderkey AS l_orderkey FROM orders WHERE o_orderstatus <> 'P') USING (l_orderkey)")
def referential_orphans(spark: SparkSession, d: str) -> DataFrame:
    parents = table(spark, d, "orders").filter("o_orderstatus <> 'P'")
    return K.orphans(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), parents, "l_orderkey", "o_orderkey").select("l_orderkey", "l_linenumber")


@query("""
    WITH t AS (SELECT DISTINCT c_custkey FROM customer), f AS (SELECT o_custkey, max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS v FROM orders GROUP BY 1)
    SELECT count(*) AS expected, count(v) AS found, CAST(sum(coalesce(v, 0)) AS BIGINT) AS with_value, round(count(v) / count(*), 4) AS recall, round(sum(coalesce(v, 0)) / count(*), 4) AS value_recall FROM t LEFT JOIN f ON c_custkey = o_custkey
""")
def recall_precision(spark: SparkSession, d: str) -> DataFrame:
    truth = table(spark, d, "customer").select("c_custkey").distinct()
    found = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.when(F.col("o_orderstatus") == "F", 1).alias("v"))
    return K.recall(truth, found, ["c_custkey"], "v")


@query("""
    SELECT n_nationkey, y AS fiscal_year, t AS document_type, substr(sha256(n_nationkey || '|' || y || '|' || t), 1, 16) AS task_id, CASE WHEN t = 'policy' THEN 'skipped' ELSE 'pending' END AS status
    FROM nation CROSS JOIN (SELECT unnest([2022, 2023, 2024]) AS y) CROSS JOIN (SELECT unnest(['annual', 'climate', 'policy']) AS t)
""")
def task_matrix(spark: SparkSession, d: str) -> DataFrame:
    out = table(spark, d, "nation").select("n_nationkey", F.explode(F.array(*map(F.lit, (2022, 2023, 2024)))).alias("fiscal_year"))
    out = out.withColumn("document_type", F.explode(F.array(*map(F.lit, ("annual", "climate", "policy")))))
    ident = F.substring(F.sha2(F.concat_ws("|", F.col("n_nationkey").cast("string"), F.col("fiscal_year").cast("string"), "document_type"), 256), 1, 16)
    return out.withColumn("task_id", ident).withColumn("status", F.when(F.col("document_type") == "policy", F.lit("skipped")).otherwise(F.lit("pending")))


@query("""
    SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1
""")
def keep_first(spark: SparkSession, d: str) -> DataFrame:
    return first_of(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], ["o_orderkey"])
