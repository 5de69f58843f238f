"""Queries over evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import first_metric
from ..operators import evidence as E
from .registry import query, table

TYPES = {"licence": ["rights reserved"], "contact": ["@", "call"], "insult": ["idiot", "stupid"], "question": ["que", "tion"], "person": ["ich", "sch"]}


def _evidence(spark: SparkSession, d: str) -> DataFrame:
    turns = table(spark, d, "conversations")
    policy = F.when(F.length("text") < 20, F.lit("exclude")).when(F.col("role") == "system", F.lit("review_required")).otherwise(F.lit("eligible"))
    return turns.withColumn("policy", policy)


EVIDENCE = "evidence AS (SELECT *, CASE WHEN length(text) < 20 THEN 'exclude' WHEN role = 'system' THEN 'review_required' ELSE 'eligible' END AS policy FROM conversations)"


@query(f"""
    WITH {EVIDENCE}, e AS (SELECT * FROM evidence WHERE policy <> 'exclude'),
    c AS (
        SELECT conv_id, turn, 'licence' AS information_type FROM e WHERE contains(lower(text), 'rights reserved')
        UNION ALL SELECT conv_id, turn, 'contact' FROM e WHERE contains(lower(text), '@') OR contains(lower(text), 'call')
        UNION ALL SELECT conv_id, turn, 'insult' FROM e WHERE contains(lower(text), 'idiot') OR contains(lower(text), 'stupid')
        UNION ALL SELECT conv_id, turn, 'question' FROM e WHERE contains(lower(text), 'que') OR contains(lower(text), 'tion')
        UNION ALL SELECT conv_id, turn, 'person' FROM e WHERE contains(lower(text), 'ich') OR contains(lower(text), 'sch')
        UNION ALL SELECT conv_id, turn, 'metric' FROM e WHERE regexp_matches(text, '(^|[^0-9])([1-9][1-9]|[1-9][0-9]{{2}})([^0-9,.]|$)')
    )
    SELECT conv_id, turn, information_type FROM c
""")
def typed_candidates(spark: SparkSession, d: str) -> DataFrame:
    """A row for each type in each turn."""
    rows = E.eligible(_evidence(spark, d), "policy", "text")
    return E.typed_candidates(rows, "text", TYPES, first_metric(F.col("text")), ["conv_id", "turn"]).select("conv_id", "turn", "information_type")


@query()
def typed_candidate_rows(spark: SparkSession, d: str) -> DataFrame:
    """All candidates of turns and documents, metrics with their value and unit too. SQL has no form of first_metric: tested
    against a plain loop."""
    short = F.when(F.length("text") < 20, F.lit("exclude")).otherwise(F.lit("eligible"))
    docs = table(spark, d, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("ident"), F.lit(None).cast("long").alias("turn"), "text", short.alias("policy"))
    turns = _evidence(spark, d).select(F.lit("turn").alias("kind"), F.col("conv_id").alias("ident"), F.col("turn").cast("long").alias("turn"), "text", "policy")
    rows = E.eligible(turns.unionByName(docs), "policy", "text")
    return E.typed_candidates(rows, "text", TYPES, first_metric(F.col("text")), ["kind", "ident", "turn"])


@query("""
    WITH p AS (
        SELECT CAST(doc_id AS VARCHAR) AS document_id, 'text' AS chunk_type, text AS chunk_text, 0 AS s, doc_id AS pos FROM documents
        UNION ALL SELECT CAST(doc_id AS VARCHAR), 'line', unnest(string_split(text, chr(10))), 1, doc_id FROM documents
        UNION ALL SELECT CAST(conv_id AS VARCHAR), 'turn', text, 2, turn FROM conversations
    ),
    k AS (SELECT *, 'chunk_' || substr(md5(document_id || '|' || chunk_text), 1, 20) AS chunk_id FROM p WHERE length(trim(chunk_text)) > 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY s, pos, document_id) AS rn FROM k)
    SELECT chunk_id, document_id, chunk_type, md5(chunk_text) AS text_md5 FROM r WHERE rn = 1
""")
def chunk_dedup(spark: SparkSession, d: str) -> DataFrame:
    docs, turns = table(spark, d, "documents"), table(spark, d, "conversations")
    lines = docs.select("doc_id", F.explode(F.split("text", "\n")).alias("text"))
    parts = [("text", docs.select("doc_id", "text", F.col("doc_id").alias("pos"))), ("line", lines.select("doc_id", "text", F.col("doc_id").alias("pos"))), ("turn", turns.select(F.col("conv_id").alias("doc_id"), "text", F.col("turn").alias("pos")))]
    out = E.chunks(parts, "doc_id", "text", "pos")
    return out.select("chunk_id", "document_id", "chunk_type", F.md5("chunk_text").alias("text_md5"))


@query("""
    WITH t AS (SELECT conv_id, turn, role, lower(text) AS low FROM conversations)
    SELECT conv_id, turn, CASE WHEN role = 'system' THEN 'instruction' WHEN contains(low, 'idiot') OR contains(low, 'stupid') THEN 'insult' WHEN contains(low, 'rights reserved') THEN 'licence' ELSE 'needs_review' END AS official_type FROM t
""")
def taxonomy_rules(spark: SparkSession, d: str) -> DataFrame:
    kind = E.taxonomy(F.col("role"), F.col("text"), {"system": "instruction"}, [("insult", ["idiot", "stupid"]), ("licence", ["rights reserved"])])
    return table(spark, d, "conversations").select("conv_id", "turn", kind.alias("official_type"))


@query(f"""
    WITH {EVIDENCE}, a AS (SELECT count(*) AS evidence, count(*) FILTER (policy = 'exclude') AS excluded, count(*) FILTER (policy = 'review_required') AS review FROM evidence)
    SELECT *, CASE WHEN evidence = 0 OR excluded / evidence > 0.4 THEN 'not_ready' WHEN excluded / evidence > 0.1 OR review / evidence > 0.1 THEN 'partially_ready' ELSE 'ready' END AS readiness FROM a
""")
def extraction_readiness(spark: SparkSession, d: str) -> DataFrame:
    return E.readiness(_evidence(spark, d), F.col("policy") == "exclude", F.col("policy") == "review_required")


@query("""
    WITH v AS (SELECT unnest(['BUILDING', 'MACHINERY', 'UNKNOWN']) AS variable_name),
    c AS (SELECT c_mktsegment AS variable_name, count(*) AS n, count(CASE WHEN c_acctbal > 0 THEN 1 END) AS with_value, count(*) AS with_unit FROM customer WHERE c_nationkey <> 3 GROUP BY 1)
    SELECT variable_name, coalesce(n, 0) AS n, coalesce(with_value, 0) AS with_value, coalesce(with_unit, 0) AS with_unit FROM v LEFT JOIN c USING (variable_name)
""")
def variable_coverage(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").select(F.col("c_mktsegment").alias("variable_name"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("value"), F.lit("EUR").alias("unit"), F.when(F.col("c_nationkey") == 3, F.lit("rejected_unit")).otherwise(F.lit("candidate_found")).alias("status"))
    return E.variable_coverage(rows, ["BUILDING", "MACHINERY", "UNKNOWN"], "variable_name", "status")
