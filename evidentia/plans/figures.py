"""Queries that look for metrics, values, units and scores in every line of the text tables, and in what each order line
says of itself; the SQL states the rules over the same lines, and takes from the library their fixed values alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import MARKED, PLAIN
from ..operators import blocks as B, candidates as C, metrics as M, retrieval as R
from .headings import KEY, LINE_ROWS, WHITE, quoted, text_lines
from .registry import query, table

#: Keywords that order lines name, and some that stand in the texts: inside one another, across one another, and as long as one another.
CATALOG = [
    ("Energy  use", "energy", "Energy", "MWh"), ("energy use of the site", "site_energy", "Site energy", "MWh"), ("water", "water", "Water", "m3"), ("hidden", "none", "None", "%"), ("WATER", "water_use", "Water use", "m3"),
    ("Token", "token", "Token", "number"), ("license, version", "license_version", "Version", "ratio"), ("version", "version", "Version", "%"), ("in the", "in_the", "In the", "%"), ("the and", "the_and", "The and", "hours"),
    ("und die", "und_die", "Und die", ""), ("de la", "de_la", "De la", "ha"), ("une", "une", "Une", "tCO2e"), ("que", "que", "Que", "t"),
]

SAID = f"""
    {LINE_ROWS}, o AS (SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS INT) AS line, CAST(CAST(l_quantity * 11 AS INT) AS VARCHAR) AS q, year(l_shipdate) AS y, l_partkey % 5 AS k FROM lineitem),
    said AS (
        SELECT src, ident, part, line, text FROM h UNION ALL
        SELECT 'order', l_orderkey, 0, line, CASE k WHEN 0 THEN 'ÉNERGY  USE of the site: ' || q || ' MWh in ' || y WHEN 1 THEN 'Energy use' WHEN 2 THEN 'Water: ' || q || 'm3' WHEN 3 THEN 'our water, 2000' ELSE 'nothing hid' END FROM o
    )"""


def _numbered(spark: SparkSession, d: str) -> DataFrame:
    """Order lines with their place in the order."""
    return table(spark, d, "lineitem").withColumn("line", F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")))


def said_lines(spark: SparkSession, d: str) -> DataFrame:
    """src, ident, part, line, text: lines of the text tables, and a line for each line of an order."""
    rows = _numbered(spark, d)
    q, y, k = (F.col("l_quantity") * 11).cast("int").cast("string"), F.year("l_shipdate").cast("string"), F.col("l_partkey") % 5
    text = (
        F.when(k == 0, F.concat(F.lit("ÉNERGY  USE of the site: "), q, F.lit(" MWh in "), y))
        .when(k == 1, F.lit("Energy use"))
        .when(k == 2, F.concat(F.lit("Water: "), q, F.lit("m3")))
        .when(k == 3, F.lit("our water, 2000"))
        .otherwise(F.lit("nothing hid"))
    )
    orders = rows.select(F.lit("order").alias("src"), F.col("l_orderkey").alias("ident"), F.lit(0).alias("part"), "line", text.alias("text"))
    return text_lines(spark, d).unionByName(orders)


def _cases(key: str, of: dict[str, object]) -> str:
    return f"CASE {key} " + " ".join(f"WHEN {quoted([k])} THEN {quoted([v]) if isinstance(v, str) else repr(v)}" for k, v in of.items()) + " END"


def _digits(x: str) -> str:
    return f"length(regexp_replace({x}, '[^0-9]', '', 'g'))"


#: ``best``: {score, early, value, unit} of a line, NULL if it has no value.
VALUES = rf"""
    pairs AS (
        SELECT *, regexp_extract_all(text, '{M.VALUE_UNIT}', 1) AS vs, regexp_extract_all(text, '{M.VALUE_UNIT}', 2) AS us FROM said
    ), figures AS (
        SELECT * EXCLUDE (vs, us), list_reverse_sort(list_filter(list_transform(range(1, len(vs) + 1), lambda i: {{'score': {_digits("vs[i]")} + CASE WHEN us[i] <> '' THEN 10 ELSE 0 END, 'early': -i, 'value': regexp_replace(vs[i], '[\s,]', '', 'g'), 'unit': coalesce(trim(us[i]), '')}}),
               lambda m: {_digits("m.value")} <= {M.MOST_DIGITS} AND ({_digits("m.value")} >= 2 OR m.unit <> '')))[1] AS best FROM pairs
    )"""

#: The catalog in the SQL's own words: (keyword, metric_id, label, unit), the later of equal keywords alone.
_ENTRIES = M.catalog_index(CATALOG)
_AT = " UNION ALL ".join(
    f"SELECT src, ident, part, line, {quoted([k])} AS word, {quoted([m])} AS metric_id, {quoted([unit])} AS expected, length(regexp_extract(norm, '(?s)^(.*?)(?:^|[^A-Za-z0-9_]){k}(?:$|[^A-Za-z0-9_])', 1)) AS pos FROM lines WHERE regexp_matches(norm, '(^|[^A-Za-z0-9_]){k}($|[^A-Za-z0-9_])')"
    for k, (m, _, unit) in _ENTRIES.items()
)


def _norm(x: str) -> str:
    return f"trim(regexp_replace(translate(lower({x}), '{MARKED}', '{PLAIN}'), '{WHITE}', ' ', 'g'))"


NAMED = rf"""
    {SAID}, {VALUES},
    lines AS (
        SELECT *, {_norm("text")} AS norm, lead(best) OVER o AS after,
               max(list_max(list_transform(regexp_extract_all(text, '\b(19[0-9]{{2}}|20[0-9]{{2}})\b', 1), lambda y: CAST(y AS INT)))) OVER (PARTITION BY src, ident, part ORDER BY line ROWS BETWEEN 3 PRECEDING AND 5 FOLLOWING) AS ctx
        FROM figures WINDOW o AS (PARTITION BY src, ident, part ORDER BY line)
    ), hits AS ({_AT}),
    hit AS (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY src, ident, part, line ORDER BY length(word) DESC, pos) = 1),
    m AS (
        SELECT l.*, metric_id, {_norm("expected")} AS e, best IS NULL AND after IS NOT NULL AS adjacent, coalesce(best, after) AS got FROM lines l JOIN hit x ON l.src = x.src AND l.ident IS NOT DISTINCT FROM x.ident AND l.part = x.part AND l.line = x.line
    ), u AS (SELECT *, {_norm("got.unit")} AS u, coalesce(nullif({_norm("got.unit")}, ''), e) AS key, TRY_CAST(got.value AS DOUBLE) AS n, regexp_replace(got.value, '[^0-9]', '', 'g') AS d FROM m),
    r AS (
        SELECT *, CASE WHEN got IS NULL THEN NULL WHEN u = '' AND length(d) = 4 AND CAST(d AS INT) BETWEEN 1990 AND 2035 THEN 'year_like_value'
               WHEN {_cases("key", {k: float(a) for k, (a, _) in M.RANGES.items()})} IS NOT NULL AND NOT coalesce(n BETWEEN {_cases("key", {k: float(a) for k, (a, _) in M.RANGES.items()})} AND {_cases("key", {k: float(b) for k, (_, b) in M.RANGES.items()})}, false) THEN 'implausible_value' END AS reason FROM u
    )"""


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    rows = said_lines(spark, d).select(F.struct("src", "ident", "part").alias("place"), "line", "text")
    return M.metric_candidates(rows, "place", "line", "text", CATALOG, F.lit(1996), loose=False)


@query(f"""
    WITH {NAMED}
    SELECT src, ident, part, line, metric_id, CASE WHEN reason IS NULL THEN got.value END AS raw_value, CASE WHEN reason IS NULL THEN got.unit END AS raw_unit, reason AS value_rejected_reason, ctx AS year_in_context, ctx = 1996 AS is_current_year,
           CAST(CASE WHEN got IS NULL OR reason IS NOT NULL THEN 0.10 ELSE CASE WHEN adjacent THEN 0.25 ELSE 0.30 END + CASE WHEN u <> '' AND e <> '' AND (contains(e, u) OR contains(u, e)) THEN 0.05 ELSE 0 END END AS DOUBLE) AS confidence
    FROM r
""")
def metric_lines(spark: SparkSession, d: str) -> DataFrame:
    """Every line of documents, turns and orders, and every heading of pages."""
    return _candidates(spark, d).select("place.*", "line", "metric_id", "raw_value", "raw_unit", "value_rejected_reason", "year_in_context", "is_current_year", "confidence")


@query(f"""
    WITH {NAMED}
    SELECT count(*) AS candidates, count(*) FILTER (got IS NOT NULL AND reason IS NULL) AS with_value, count(DISTINCT metric_id) AS metrics, count(*) FILTER (ctx = 1996) AS current_year, count(*) FILTER (ctx <> 1996) AS other_year,
           count(*) FILTER (ctx IS NULL) AS unknown_year, count(*) AS exact, count(*) FILTER (reason IS NOT NULL) AS rejected_values FROM r
""")
def metric_figures(spark: SparkSession, d: str) -> DataFrame:
    return M.metric_statistics(_candidates(spark, d))


_UNITS = ("MWh", "gwh", "tonnes", "parsec", "", "kt", "km3", "Gt", "TJ")
_QUANTITIES = ("emissions", "energy", "volume", "mass", "other")


def _fit(i: int) -> str:
    fits = {"emissions": lambda s: f"starts_with(key, '{s}')", "energy": lambda s: f"contains(key, '{s}')"}
    return "CASE " + " ".join(f"WHEN quantity = '{q}' AND {fits.get(q, lambda s: f"key = '{s}'")(rule[0])} THEN {quoted([rule[i]]) if i == 1 else rule[i]}" for q, rules in M.BY_QUANTITY.items() for rule in rules) + " END"


@query(rf"""
    WITH {SAID}, {VALUES},
    v AS (
        SELECT src, ident, part, line, best.value AS value, best.unit AS unit, CASE src WHEN 'document' THEN 'mass' WHEN 'turn' THEN 'volume' WHEN 'order' THEN 'energy' END AS quantity FROM figures UNION ALL
        SELECT 'lineitem', l_orderkey, CAST(l_linenumber AS INT), CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS INT), CASE WHEN l_suppkey % 4 <> 0 THEN CAST(CAST(l_quantity * 7 AS INT) AS VARCHAR) || CASE WHEN l_suppkey % 3 = 0 THEN ',5' ELSE '' END END,
               [{quoted(_UNITS)}][l_partkey % {len(_UNITS)} + 1], [{quoted(_QUANTITIES)}][l_suppkey % {len(_QUANTITIES)} + 1] FROM lineitem
    ), k AS (SELECT *, lower(trim(coalesce(unit, ''))) AS key, TRY_CAST(replace(value, ',', '.') AS DOUBLE) AS n FROM v),
    c AS (SELECT *, coalesce({_fit(1)}, {_cases("key", {k: u for k, (u, _) in M.CANONICAL.items()})}) AS known, CAST(coalesce({_fit(2)}, {_cases("key", {k: f for k, (_, f) in M.CANONICAL.items()})}) AS DOUBLE) AS times FROM k)
    SELECT src, ident, part, line, CASE WHEN n IS NULL THEN 'no_value' WHEN key = '' OR known IS NOT NULL THEN 'ok' ELSE 'unknown_unit' END AS status, CASE WHEN n IS NOT NULL AND key <> '' THEN known END AS unit, CASE WHEN key = '' THEN n ELSE round(n * times, 6) END AS value FROM c
""")
def unit_normalization(spark: SparkSession, d: str) -> DataFrame:
    """The value of every line, and quantities of order lines under nine spellings and five kinds of quantity."""
    rows = said_lines(spark, d)
    of = F.when(F.col("src") == "document", F.lit("mass")).when(F.col("src") == "turn", F.lit("volume")).when(F.col("src") == "order", F.lit("energy"))
    told = rows.select(*KEY, M.value_unit(F.col("text")).alias("m"), of.alias("quantity")).select(*KEY, "m.value", "m.unit", "quantity")
    pick = lambda names, i: F.element_at(F.array(*map(F.lit, names)), (i % len(names) + 1).cast("int"))
    half = F.when(F.col("l_suppkey") % 3 == 0, F.lit(",5")).otherwise(F.lit(""))
    value = F.when(F.col("l_suppkey") % 4 != 0, F.concat((F.col("l_quantity") * 7).cast("int").cast("string"), half))
    orders = _numbered(spark, d).select(
        F.lit("lineitem").alias("src"), F.col("l_orderkey").alias("ident"), F.col("l_linenumber").cast("int").alias("part"), "line", value.alias("value"), pick(_UNITS, F.col("l_partkey")).alias("unit"), pick(_QUANTITIES, F.col("l_suppkey")).alias("quantity")
    )
    n = M.normalized_unit(F.col("value"), F.col("unit"), F.col("quantity"))
    return told.unionByName(orders).select(*KEY, n.alias("n")).select(*KEY, "n.status", "n.unit", "n.value")


_TERMS = ("energy", "water", "Token", "the ", "que", "nothing", "und", "version", "of")
_CANON = _cases("lower(unit)", {k: u for k, (u, _) in M.CANONICAL.items()})


@query(rf"""
    WITH {SAID}, {VALUES},
    f AS (SELECT src, ident, part, line, text, best.value AS value, best.unit AS unit, CASE src WHEN 'document' THEN ['%', 'tCO2e'] WHEN 'order' THEN ['mwh'] WHEN 'page' THEN ['HA'] ELSE [] END AS wanted, CASE src WHEN 'document' THEN 'paragraph' WHEN 'order' THEN 'table_cell_context' WHEN 'page' THEN 'section' ELSE 'evidence' END AS kind FROM figures),
    w AS (SELECT *, list_bool_or(list_transform(wanted, lambda e: contains(lower(unit), lower(e)) OR contains(lower(e), lower(unit)))) AS fits, list_bool_or(list_transform(wanted, lambda e: contains(lower({_CANON}), lower(e)) OR contains(lower(e), lower({_CANON})))) AS near FROM f)
    SELECT src, ident, part, line,
           CAST(CASE WHEN value IS NULL THEN 0.1 WHEN unit = '' THEN 0.4 WHEN len(wanted) = 0 THEN 0.6 WHEN fits THEN 1.0 WHEN coalesce(near, false) THEN 0.9 ELSE 0.3 END AS DOUBLE) AS coherence,
           CAST(CASE WHEN text = '' THEN 0 ELSE 0.3 + CASE WHEN value IS NOT NULL AND contains(text, value) THEN 0.3 ELSE 0 END + CASE kind WHEN 'table_cell_context' THEN 0.3 WHEN 'section' THEN 0.1 ELSE 0.2 END + CASE WHEN length(text) >= 30 THEN 0.1 ELSE 0 END END AS DOUBLE) AS quality,
           CAST(CASE WHEN text = '' THEN 0 ELSE least(1.0, 0.12 * len(list_filter([{quoted(_TERMS)}], lambda t: contains(lower(text), lower(t))))) END AS DOUBLE) AS context
    FROM w
""")
def extraction_scores(spark: SparkSession, d: str) -> DataFrame:
    """Each line as the quote of the value that it holds; what its source expects as a unit differs by the kind of source."""
    src = F.col("src")
    rows = said_lines(spark, d).withColumn("m", M.value_unit(F.col("text")))
    value, unit = F.col("m.value"), F.col("m.unit")
    listed = lambda *units: F.array(*map(F.lit, units)).cast("array<string>")
    wanted = F.when(src == "document", listed("%", "tCO2e")).when(src == "order", listed("mwh")).when(src == "page", listed("HA")).otherwise(listed())
    kind = F.when(src == "document", F.lit("paragraph")).when(src == "order", F.lit("table_cell_context")).when(src == "page", F.lit("section")).otherwise(F.lit("evidence"))
    canonical = F.element_at(F.create_map(*[F.lit(x) for k, (u, _) in M.CANONICAL.items() for x in (k, u)]), F.lower(unit))
    return rows.select(
        *KEY, R.value_unit_coherence(value, unit, wanted, canonical).alias("coherence"), R.evidence_quality(F.col("text"), kind, value).alias("quality"), R.context_score(F.col("text"), F.array(*map(F.lit, _TERMS))).alias("context")
    )


_SHEET = ("token", "license", "version", "rights reserved", "total")


@query(rf"""
    WITH t AS (SELECT 'document' AS src, doc_id AS ident, 0 AS part, text FROM documents UNION ALL SELECT 'turn', conv_id, turn, text FROM conversations UNION ALL SELECT 'page', page_id, 0, html FROM pages)
    SELECT src, ident, part, len(list_filter([{quoted(_SHEET)}], lambda k: contains(lower(text), k))) >= 2 OR len(regexp_extract_all(text, '[0-9][0-9\s,]*%')) >= 3
           OR len(list_filter(string_split(text, chr(10)), lambda x: len(regexp_extract_all(x, '\b([0-9][0-9\s,.]*)\b', 1)) >= 3)) >= 3 AS table_like FROM t WHERE text IS NOT NULL
""")
def table_like_texts(spark: SparkSession, d: str) -> DataFrame:
    """Whole documents, turns and pages that look like a table."""
    rows = lambda name, src, ident, part, text: table(spark, d, name).select(F.lit(src).alias("src"), F.col(ident).alias("ident"), part.cast("int").alias("part"), F.col(text).alias("text"))
    every = rows("documents", "document", "doc_id", F.lit(0), "text").unionByName(rows("conversations", "turn", "conv_id", F.col("turn"), "text")).unionByName(rows("pages", "page", "page_id", F.lit(0), "html"))
    return every.filter("text IS NOT NULL").select("src", "ident", "part", B.table_like(F.col("text"), _SHEET).alias("table_like"))


@query(rf"""
    WITH {SAID}, {VALUES},
    told AS (
        SELECT src, ident, part, line, text, best.value AS raw, nullif(best.unit, '') AS unit, nullif(trim(regexp_extract(text, '([0-9]+)!', 1)), '') AS corrected, CASE WHEN best.unit <> '' THEN best.value || ' ' || lower(best.unit) END AS plain,
               nullif(regexp_extract(text, '\b((?:19|20)[0-9]{{2}})\b', 1), '') AS year FROM figures
    ), q AS (SELECT *, coalesce(corrected, plain, raw) AS value, CASE WHEN trim(text) <> '' AND length(text) >= 30 THEN text END AS evidence, (unit IS NULL)::INT + (coalesce(raw = year, false))::INT + (length(text) < 15)::INT AS n FROM told)
    SELECT src, ident, part, line, value, CASE WHEN corrected IS NOT NULL THEN 'corrected_value' WHEN plain IS NOT NULL THEN 'normalized_value' WHEN raw IS NOT NULL THEN 'raw_value' ELSE 'missing' END AS value_source,
           coalesce(nullif(concat_ws('|', CASE WHEN value IS NULL THEN 'missing_value' END, CASE WHEN unit IS NULL THEN 'missing_unit' END, CASE WHEN year IS NULL THEN 'missing_year' END, CASE WHEN evidence IS NULL THEN 'missing_evidence' END), ''), 'complete') AS quality,
           nullif(concat_ws('|', CASE WHEN unit IS NULL THEN 'no_unit' END, CASE WHEN raw = year THEN 'is_year' END, CASE WHEN length(text) < 15 THEN 'short_text' END), '') AS risk_reasons, CASE WHEN n >= 2 THEN 'high' WHEN n = 1 THEN 'medium' ELSE 'low' END AS risk FROM q
""")
def prepared_lines(spark: SparkSession, d: str) -> DataFrame:
    """The value of each line with where it comes from, what it lacks, and how likely it is none. A number before an exclamation mark stands for a correction."""
    x = F.col("text")
    rows = said_lines(spark, d).withColumn("m", M.value_unit(x))
    raw, unit = F.col("m.value"), F.nullif(F.col("m.unit"), F.lit(""))
    year = F.nullif(F.regexp_extract(x, r"\b((?:19|20)[0-9]{2})\b", 1), F.lit(""))
    value = C.prefer_corrected(F.regexp_extract(x, "([0-9]+)!", 1), F.when(unit.isNotNull(), F.concat(raw, F.lit(" "), F.lower(unit))), raw)
    rows = rows.withColumns({"value": value, "risk": C.false_positive_risk([(unit.isNull(), "no_unit"), (raw == year, "is_year"), (F.length(x) < 15, "short_text")])})
    quality = C.preparation_quality(F.col("value.value"), unit, year, F.when(F.length(x) >= 30, x))
    return rows.select(*KEY, F.col("value.value").alias("value"), F.col("value.source").alias("value_source"), quality.alias("quality"), F.col("risk.reasons").alias("risk_reasons"), F.col("risk.risk").alias("risk"))
