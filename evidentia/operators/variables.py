"""From prepared indicators to a dense table of company, year and variable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import missing
from .corpus import first_of

KEY = ("company", "year", "variable_name")

#: What a mapping rests on, and its weight.
MAPPING_WEIGHTS = {"key": 0.7, "family": 0.45, "label": 0.35, "quote": 0.2}


def map_variables(records: DataFrame, dictionary: DataFrame, ident: str) -> DataFrame:
    """The best variable of each record: mapped, ambiguous if two share the best score, or no_match.

    ``records`` has key, family, label, quote; ``dictionary`` variable_name, keys, families, keywords (arrays). The
    dictionary is a fixed catalog of a few dozen rows, so it is broadcast.
    """
    w = MAPPING_WEIGHTS
    pair = records.crossJoin(F.broadcast(dictionary))
    hit = lambda text: F.exists("keywords", lambda k: F.lower(F.coalesce(text, F.lit(""))).contains(k))
    one = lambda cond, x: F.when(F.coalesce(cond, F.lit(False)), F.lit(x)).otherwise(0.0)
    score = one(F.array_contains("keys", F.col("key")), w["key"]) + one(F.array_contains("families", F.col("family")), w["family"]) + one(hit(F.col("label")), w["label"]) + one(hit(F.col("quote")), w["quote"])
    pair = pair.withColumn("score", F.least(F.round(score, 2), F.lit(1.0)))
    best = pair.groupBy(ident).agg(F.max("score").alias("score"), F.max_by("variable_name", F.struct("score", (-F.col("variable_order")))).alias("variable_name"), F.collect_list("score").alias("_all"))
    ties = F.size(F.filter("_all", lambda x: x == F.col("score")))
    status = F.when(F.col("score") <= 0, F.lit("no_match")).when(ties > 1, F.lit("ambiguous")).otherwise(F.lit("mapped"))
    return best.select(ident, F.when(F.col("score") > 0, F.col("variable_name")).alias("variable_name"), F.col("score").alias("mapping_confidence"), status.alias("mapping_status"))


def densify(entities: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Every company and year with every variable."""
    return entities.withColumn("variable_name", F.explode(F.array(*map(F.lit, variables))))


def select_values(candidates: DataFrame, entities: DataFrame, variables: Sequence[str], canonical: Column, order: Sequence[Column | str]) -> DataFrame:
    """One row for every company, year and variable with value, value_status and the number of candidates.

    found: one distinct value; conflicting_values: several, and no value is given; qualitative_only: quotes alone;
    missing_from_corpus: nothing. ``canonical`` tells equal values. Facts of a group come from partial aggregation.
    """
    rows = candidates.withColumn("_canonical", canonical)
    best = F.min_by(F.struct("value", "unit", "quote", "ident"), F.struct(*[F.col(c) if isinstance(c, str) else c for c in order]))
    facts = rows.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("candidates"),
        F.count_distinct("_canonical").alias("distinct_values"),
        F.count_if(missing(F.col("quote")).isNotNull()).alias("quotes"),
        best.alias("best"),
    )
    dense = densify(entities, variables).join(facts, list(KEY), "left")
    status = (
        F.when(F.col("candidates").isNull(), F.lit("missing_from_corpus"))
        .when(F.col("distinct_values") > 1, F.lit("conflicting_values"))
        .when(F.col("distinct_values") == 1, F.lit("found"))
        .when(F.col("quotes") > 0, F.lit("qualitative_only"))
        .otherwise(F.lit("needs_review"))
    )
    dense = dense.withColumn("value_status", status)
    found = F.col("value_status") == "found"
    return dense.select(*KEY, F.when(found, F.col("best.value")).alias("value"), F.when(found, F.col("best.unit")).alias("unit"), "value_status", F.coalesce("candidates", F.lit(0).cast("long")).alias("candidates"), F.col("best.quote").alias("quote"), F.col("best.ident").alias("ident"))


def wide(selected: DataFrame, variables: Sequence[str], columns: Sequence[str] = ("value",)) -> DataFrame:
    """A row for each company and year, a column for each variable; with several columns, each as variable_column."""
    plain = list(columns) == ["value"]
    pick = [F.max(F.when(F.col("variable_name") == v, F.col(c))).alias(v if plain else f"{v}_{c}") for v in variables for c in columns]
    return selected.groupBy("company", "year").agg(*pick)


def completion(selected: DataFrame) -> DataFrame:
    """Cells, found cells and their share in percent."""
    out = selected.agg(F.count(F.lit(1)).alias("cells"), F.count_if(F.col("value_status") == "found").alias("found"))
    return out.withColumn("found_pct", F.round(F.when(F.col("cells") > 0, F.col("found") * 100.0 / F.col("cells")).otherwise(0.0), 1))


#: What to do about a status.
ACTIONS = {"missing_from_corpus": "add_documents", "conflicting_values": "resolve_conflict", "qualitative_only": "seek_number", "needs_review": "review_candidate"}


def missing_report(selected: DataFrame) -> DataFrame:
    """Cells without a value and the recommended action."""
    table = F.create_map(*[F.lit(x) for kv in ACTIONS.items() for x in kv])
    return selected.filter("value_status <> 'found'").select(*KEY, "value_status", F.element_at(table, F.col("value_status")).alias("recommended_action"))


def lineage(selected: DataFrame, evidence: DataFrame, ident: str) -> DataFrame:
    """Found cells with their evidence's columns, and whether the trace is complete."""
    out = selected.filter("value_status = 'found'").join(evidence, F.col("ident") == F.col(ident), "left")
    return out.withColumn("trace_complete", F.col(ident).isNotNull() & missing(F.col("quote")).isNotNull())


def untraced(selected: DataFrame, evidence: DataFrame, ident: str) -> DataFrame:
    """Found cells without a row of evidence, which must be none."""
    return selected.filter("value_status = 'found'").join(evidence.select(F.col(ident).alias("ident")), "ident", "left_anti")


def best_value(rows: DataFrame, by: Sequence[str], final: str, confidence: str, run: str, position: str) -> DataFrame:
    """The master's choice: final rows first, then confidence, then the latest run."""
    return first_of(rows, by, [F.desc(final), F.desc(confidence), F.desc(run), position])


def quality_findings(selected: DataFrame) -> DataFrame:
    """A count for each kind of finding."""
    once = Window.partitionBy(*KEY)
    marked = selected.withColumn("_n", F.count(F.lit(1)).over(once))
    checks = {
        "duplicate_cell": F.col("_n") > 1,
        "found_without_value": (F.col("value_status") == "found") & missing(F.col("value")).isNull(),
        "value_without_found": (F.col("value_status") != "found") & missing(F.col("value")).isNotNull(),
        "found_without_quote": (F.col("value_status") == "found") & missing(F.col("quote")).isNull(),
        "conflicting_values": F.col("value_status") == "conflicting_values",
        "missing_from_corpus": F.col("value_status") == "missing_from_corpus",
    }
    counts = marked.agg(*(F.count_if(c).alias(k) for k, c in checks.items()))
    return counts.unpivot([], list(checks), "finding", "n")
