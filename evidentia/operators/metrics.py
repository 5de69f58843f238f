"""Metrics named in lines of text: keywords, values with units, plausibility, years around, confidence.

The catalog is data: rows of (keyword, metric_id, label, unit). Its keywords are compared without case, marks and runs of
white space; of equal keywords the later one counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import MARKED, PLAIN, collapse, first_case, fold_accents
from .matching import longest_keyword, loose_keyword, named_keyword  # noqa: F401  part of this module's interface

Entry = tuple[str, str, str, str]

#: A number and the unit behind it.
VALUE_UNIT = (
    r"(?i)(\d[\d\s,]*(?:\.\d+)?)\s*((?:k|m|g)?tco2e?|co2eq?|gco2e|kgco2e|gwh|mwh|kwh|thm|gj|mj|tep|toe|hm3|m3|m³"
    r"|\bkt\b|\bmt\b|tonnes?|\bha\b|hectares?|km2|m2|heures?|hours?|\bfte\b|\bratio\b|%)?"
)

#: The range in which a value of a unit is plausible.
RANGES = {
    "%": (0, 100), "ratio": (0, 10_000), "number": (0, 500_000_000), "tco2e": (0, 20_000_000_000), "ktco2e": (0, 20_000_000), "mtco2e": (0, 20_000), "co2e": (0, 20_000_000_000), "co2eq": (0, 20_000_000_000),
    "gco2e": (0, 1e18), "kgco2e": (0, 2e13), "gwh": (0, 100_000_000), "mwh": (0, 100_000_000_000), "kwh": (0, 1e14), "gj": (0, 1e12), "mj": (0, 1e15), "tep": (0, 1e10), "toe": (0, 1e10), "m3": (0, 1e12), "m³": (0, 1e12),
    "hm3": (0, 1e9), "t": (0, 1e11), "kt": (0, 1e8), "mt": (0, 1e5), "tonnes": (0, 1e11), "ha": (0, 1e9), "hectares": (0, 1e9), "km2": (0, 1e9), "m2": (0, 1e12), "heures": (0, 1e12), "hours": (0, 1e12), "fte": (0, 500_000_000),
}

#: The canonical unit and factor of a spelling. Tonnes count as tonnes of CO2e.
CANONICAL = {
    "tco2e": ("tCO2e", 1.0), "tco2": ("tCO2e", 1.0), "ktco2e": ("tCO2e", 1e3), "ktco2": ("tCO2e", 1e3), "mtco2e": ("tCO2e", 1e6), "mtco2": ("tCO2e", 1e6), "tonnes": ("tCO2e", 1.0), "t": ("tCO2e", 1.0),
    "kwh": ("MWh", 0.001), "mwh": ("MWh", 1.0), "gwh": ("MWh", 1e3), "thm": ("MWh", 0.029307), "gj": ("MWh", 0.27778), "mj": ("MWh", 0.00027778), "%": ("%", 1.0),
}

#: Factors by what a unit measures, tried in order; the first spelling that fits counts.
BY_QUANTITY = {
    "emissions": [("kt", "tCO2e", 1e3), ("mt", "tCO2e", 1e6), ("gt", "tCO2e", 1e9), ("t", "tCO2e", 1.0), ("kg", "tCO2e", 0.001)],
    "energy": [("kwh", "MWh", 0.001), ("mwh", "MWh", 1.0), ("gwh", "MWh", 1e3), ("twh", "MWh", 1e6), ("gj", "MWh", 0.27778), ("mj", "MWh", 0.00027778), ("tj", "MWh", 277.78), ("tep", "MWh", 11.63), ("toe", "MWh", 11.63)],
    "volume": [("hm3", "m3", 1e6), ("km3", "m3", 1e9), ("l", "m3", 0.001)],
    "mass": [("kt", "tonnes", 1e3), ("mt", "tonnes", 1e6), ("t", "tonnes", 1.0), ("kg", "tonnes", 0.001)],
}

#: Fixed value: digits that a value may have.
MOST_DIGITS = 15


def metric_text(text: Column) -> Column:
    """Lower case, no marks, single spaces; punctuation stays."""
    return collapse(fold_accents(text))


def catalog_index(entries: Sequence[Entry]) -> dict[str, tuple[str, str, str]]:
    """keyword to (metric_id, label, unit), in catalog order; the later of equal keywords wins."""
    table = str.maketrans(MARKED, PLAIN)
    out: dict[str, tuple[str, str, str]] = {}
    for keyword, *rest in entries:
        if key := " ".join(keyword.lower().translate(table).split()):
            out[key] = tuple(rest)
    return out


def first_substring(line: Column, keywords: Sequence[str]) -> Column:
    """The first keyword of the catalog that a line contains, even inside a word; NULL if none."""
    return F.try_element_at(F.filter(F.array(*map(F.lit, keywords)), lambda k: line.contains(k)), F.lit(1))


def digits(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"\D", ""))


def value_unit(line: Column) -> Column:
    """struct<value, unit>: ten points for a unit and one for each digit, the first on a tie; the value without spaces and
    commas, and no unit as an empty text. NULL without a number; one digit alone, or over 15, is none."""
    values = F.transform(F.regexp_extract_all(line, F.lit(VALUE_UNIT), 1), lambda v: F.regexp_replace(v, r"[\s,]", ""))
    units = F.transform(F.regexp_extract_all(line, F.lit(VALUE_UNIT), 2), F.trim)
    pairs = F.filter(F.zip_with(values, units, lambda v, u: F.struct(v.alias("v"), u.alias("u"))), lambda m: (digits(m["v"]) <= MOST_DIGITS) & ((digits(m["v"]) >= 2) | (m["u"] != "")))
    scored = F.transform(pairs, lambda m, i: F.struct((F.when(m["u"] != "", 10).otherwise(0) + digits(m["v"])).alias("score"), (-i).alias("early"), m["v"].alias("value"), m["u"].alias("unit")))
    best = F.array_max(scored)
    return F.when(best.isNotNull(), F.struct(best["value"].alias("value"), best["unit"].alias("unit")))


def raw_number(raw: Column) -> Column:
    """A double after spaces go and commas become points; NULL if it isn't one."""
    return F.regexp_replace(F.replace(raw, F.lit(","), F.lit(".")), "[  ]", "").try_cast("double")


def pointed_number(raw: Column) -> Column:
    """As :func:`raw_number`, but of several points the last is the decimal one."""
    plain = F.replace(F.replace(raw, F.lit(" "), F.lit("")), F.lit(","), F.lit("."))
    return F.regexp_replace(plain, r"\.(?=.*\.)", "").try_cast("double")


def is_year(value: Column, unit: Column) -> Column:
    """Four digits from 1990 to 2035 without a unit."""
    d = F.regexp_replace(value, r"\D", "")
    return (F.coalesce(unit, F.lit("")) == "") & (F.length(d) == 4) & d.try_cast("int").between(1990, 2035)


def is_plausible(value: Column, unit: Column, expected: Column) -> Column:
    """Whether a value lies in the range of its unit, or of the unit expected where it has none; units without a range allow any."""
    key = metric_text(F.when(F.coalesce(unit, F.lit("")) != "", unit).otherwise(expected))
    lo = F.create_map(*[F.lit(x) for u, (a, _) in RANGES.items() for x in (u, float(a))])
    hi = F.create_map(*[F.lit(x) for u, (_, b) in RANGES.items() for x in (u, float(b))])
    n = pointed_number(value)
    inside = F.coalesce(n.between(F.element_at(lo, key), F.element_at(hi, key)), F.lit(False))
    return (digits(value) <= MOST_DIGITS) & F.when(F.element_at(lo, key).isNull(), F.lit(True)).otherwise(inside)


def match_confidence(value: Column, unit: Column, expected: Column, adjacent: Column, loose: Column) -> Column:
    """0.10 without a value; 0.30, or 0.25 from the next line; 0.20 and 0.15 for a loose match; 0.05 more for a fitting unit."""
    u, e = metric_text(unit), metric_text(expected)
    fits = F.coalesce((u != "") & (e != "") & (e.contains(u) | u.contains(e)), F.lit(False))
    base = F.when(loose, F.when(adjacent, 0.15).otherwise(0.20)).otherwise(F.when(adjacent, 0.25).otherwise(0.30))
    return F.round(F.when(F.coalesce(value, F.lit("")) == "", F.lit(0.10)).otherwise(base + F.when(fits, 0.05).otherwise(0.0)), 2)


def document_lines(docs: DataFrame, document: str, text: str) -> DataFrame:
    """document, line (from 0), text of every line."""
    return docs.select(document, F.posexplode(F.split(F.col(text), r"\r?\n")).alias("line", "text"))


def metric_candidates(lines: DataFrame, document: str, line: str, text: str, entries: Sequence[Entry], fiscal_year: Column | None = None, loose: bool = True) -> DataFrame:
    """A candidate for each line that names a metric: the value of the line or else of the next one, dropped if it is a
    year or implausible, the latest year from three lines before to five after, and a confidence."""
    index = catalog_index(entries)
    w = Window.partitionBy(document).orderBy(line)
    norm = metric_text(F.col(text))
    years = F.transform(F.regexp_extract_all(text, F.lit(r"\b(19[0-9]{2}|20[0-9]{2})\b"), 1), lambda y: y.cast("int"))
    rows = lines.select(document, line, F.col(text).alias("_text"), named_keyword(norm, norm, index, loose).alias("_hit"), value_unit(F.col(text)).alias("_own"), F.array_max(years).alias("_year"))
    rows = rows.withColumns({"_next": F.lead("_own").over(w), "year_in_context": F.max("_year").over(w.rowsBetween(-3, 5))})
    rows = rows.filter("_hit.word IS NOT NULL")
    rows = rows.select("*", "_hit.metric_id", F.col("_hit.label").alias("metric_label"), F.col("_hit.unit").alias("unit_expected"), F.coalesce("_own", "_next").alias("_m"), (F.col("_own").isNull() & F.col("_next").isNotNull()).alias("_adjacent"))
    value, unit = F.col("_m.value"), F.col("_m.unit")
    reason = F.when(value.isNull(), None).when(is_year(value, unit), F.lit("year_like_value")).when(~is_plausible(value, unit, F.col("unit_expected")), F.lit("implausible_value"))
    rows = rows.withColumn("value_rejected_reason", reason)
    kept = F.col("value_rejected_reason").isNull()
    rows = rows.withColumns({"raw_value": F.when(kept, value), "raw_unit": F.when(kept, unit)})
    current = F.lit(None).cast("boolean") if fiscal_year is None else F.col("year_in_context") == fiscal_year
    return rows.select(
        document, line, "metric_id", "metric_label", "raw_value", "raw_unit", F.substring(F.trim("_text"), 1, 200).alias("context_snippet"),
        match_confidence(F.col("raw_value"), F.col("raw_unit"), F.col("unit_expected"), F.col("_adjacent"), F.col("_hit.likeness").isNotNull()).alias("confidence"),
        "year_in_context", current.alias("is_current_year"), F.when(F.col("_hit.likeness").isNull(), F.lit("exact")).otherwise(F.lit("fuzzy")).alias("match_type"), F.col("_hit.likeness").alias("fuzzy_score"), "value_rejected_reason",
    )


def normalized_unit(raw_value: Column, raw_unit: Column, quantity: Column | None = None) -> Column:
    """struct<value, unit, factor, status>: no_value, ok or unknown_unit.

    With ``quantity`` (emissions, energy, volume or mass) the unit is looked up among that quantity's spellings first.
    """
    n, key = raw_number(raw_value), F.lower(F.trim(F.coalesce(raw_unit, F.lit(""))))
    target = F.create_map(*[F.lit(x) for u, (t, _) in CANONICAL.items() for x in (u, t)])
    factor = F.create_map(*[F.lit(x) for u, (_, f) in CANONICAL.items() for x in (u, f)])
    unit, by = F.element_at(target, key), F.element_at(factor, key)
    if quantity is not None:
        for name, rules in reversed(BY_QUANTITY.items()):
            fits = {"emissions": lambda s: key.startswith(s), "energy": lambda s: key.contains(s)}.get(name, lambda s: key == s)
            first_unit, first_by = F.lit(None).cast("string"), F.lit(None).cast("double")
            for spelling, to, x in reversed(rules):
                first_unit, first_by = F.when(fits(spelling), F.lit(to)).otherwise(first_unit), F.when(fits(spelling), F.lit(x)).otherwise(first_by)
            here = (quantity == name) & first_unit.isNotNull()
            unit, by = F.when(here, first_unit).otherwise(unit), F.when(here, first_by).otherwise(by)
    status = first_case((n.isNull(), "no_value"), (key == "", "ok"), (unit.isNotNull(), "ok"), otherwise="unknown_unit")
    value = F.when(status == "ok", F.when(key == "", n).otherwise(F.round(n * by, 6)))
    return F.struct(value.alias("value"), F.when((status == "ok") & (key != ""), unit).alias("unit"), F.when((status == "ok") & (key != ""), by).alias("factor"), status.alias("status"))


def metric_statistics(candidates: DataFrame) -> DataFrame:
    """One row: candidates, with a value, distinct metrics, of the current, another and an unknown year, and by kind of match."""
    return candidates.agg(
        F.count(F.lit(1)).alias("candidates"), F.count("raw_value").alias("with_value"), F.count_distinct("metric_id").alias("metrics"), F.count_if(F.col("is_current_year")).alias("current_year"),
        F.count_if(~F.col("is_current_year")).alias("other_year"), F.count_if(F.col("is_current_year").isNull()).alias("unknown_year"), F.count_if(F.col("match_type") == "exact").alias("exact"),
        F.count_if(F.col("value_rejected_reason").isNotNull()).alias("rejected_values"),
    )


#: Words for standards and methods, and geographies, in the order in which they are looked for.
STANDARDS = [("ghg protocol", "GHG Protocol"), ("esrs", "ESRS"), ("gri", "GRI"), ("tcfd", "TCFD"), ("limited assurance", "limited assurance"), ("reasonable assurance", "reasonable assurance"), ("market-based", "market-based"), ("location-based", "location-based")]
GEOGRAPHIES = [("france", "France"), ("europe", "Europe"), ("asia", "Asia"), ("united states", "United States"), ("china", "China"), ("japan", "Japan")]
BOUNDARIES = [("group", "Group"), ("scope 1", "Scope 1"), ("scope 2", "Scope 2"), ("scope 3", "Scope 3"), *GEOGRAPHIES]


def is_target(text: Column, named: Column) -> Column:
    """A text that names a target (without a negation before it, see ``not_negated``) or a year by which."""
    return named | text.rlike(r"(?i)\bby\s+20[0-4][0-9]\b")


def target_year(text: Column) -> Column:
    """The year behind "by", else the last year of the text; NULL without one."""
    by = F.regexp_extract(text, r"(?i)\bby\s+(20[0-4][0-9])\b", 1)
    every = F.regexp_extract_all(text, F.lit(r"\b((?:19|20)\d{2})\b"), 1)
    return F.coalesce(F.nullif(by, F.lit("")), F.try_element_at(every, F.lit(-1)))


def baseline_year(text: Column) -> Column:
    """The year within 40 signs, none a digit, behind the word for a base year; NULL without one."""
    return F.nullif(F.regexp_extract(F.lower(text), r"(?:baseline|base year|reference year)[^0-9]{0,40}((?:19|20)[0-9]{2})", 1), F.lit(""))


def first_token(text: Column, tokens: Sequence[tuple[str, str]]) -> Column:
    """The name of the first token that a text contains: of STANDARDS, GEOGRAPHIES or BOUNDARIES; NULL if none."""
    low = F.lower(text)
    return first_case(*((low.contains(t), name) for t, name in tokens), otherwise=F.lit(None).cast("string"))


def metric_key(text: Column, category: Column) -> Column:
    """The scope that a text names, else its category, else revenue, else unknown_metric."""
    low = F.lower(text)
    scopes = [(low.contains(f"scope {i}"), f"scope_{i}_emissions") for i in (1, 2, 3)]
    return first_case(*scopes, otherwise=F.when(category != "general", category).when(low.contains("revenue"), F.lit("revenue")).otherwise(F.lit("unknown_metric")))


def keyword_class(text: Column, catalog: Mapping[str, Sequence[str]], default: str = "unknown") -> Column:
    """struct<name, confidence> of the class with most of its keywords in a text: 0.35 and 0.05 for each, 0.6 at most."""
    low = F.lower(text)
    scores = F.array(*(F.struct(F.size(F.filter(F.array(*map(F.lit, words)), lambda k: low.contains(k))).alias("n"), F.lit(-i).alias("early"), F.lit(name).alias("name")) for i, (name, words) in enumerate(catalog.items())))
    best = F.array_max(scores)
    found = best["n"] > 0
    return F.struct(F.when(found, best["name"]).otherwise(F.lit(default)).alias("name"), F.when(found, F.round(F.least(F.lit(0.6), F.lit(0.35) + best["n"] * 0.05), 2)).otherwise(0.2).alias("confidence"))


def merge_spans(found: DataFrame, spans: DataFrame, document: str, page: str, value: str, confidence: str, ident: str) -> DataFrame:
    """Candidates of two engines by (document, page, bare value): a span is added if no candidate has its key, else the
    first candidate of that key takes the spans' confidence if theirs is higher."""
    bare = F.regexp_replace(F.coalesce(F.col(value), F.lit("")), r"[\s,.]", "")
    left, right = found.withColumn("_k", bare), spans.withColumn("_k", bare)
    keys = [document, page, "_k"]
    best = right.groupBy(*keys).agg(F.max(confidence).alias("_theirs"))
    first = left.groupBy(*keys).agg(F.min(ident).alias("_first"))

    def beside(rows: DataFrame, other: DataFrame, how: str) -> DataFrame:
        """A join on the keys in which NULL equals NULL, without the other side's keys."""
        other = other.withColumnsRenamed({k: f"_of_{k}" for k in keys})
        same = [F.col(f"`{k}`").eqNullSafe(F.col(f"`_of_{k}`")) for k in keys]
        return rows.join(other, same, how).drop(*(f"_of_{k}" for k in keys))

    told = beside(beside(left, first, "inner"), best, "left")
    raised = F.when((F.col(ident) == F.col("_first")) & (F.col("_theirs") > F.col(confidence)), F.col("_theirs")).otherwise(F.col(confidence))
    told = told.withColumns({"engine": F.when(raised > F.col(confidence), F.lit("both")).otherwise(F.lit("rules")), confidence: raised}).drop("_first", "_theirs")
    added = beside(right, first, "left_anti").withColumn("engine", F.lit("spans"))
    return told.unionByName(added, allowMissingColumns=True).drop("_k")
