"""Numbers, units and years in text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import missing, years

#: Spellings of units and the unit that they stand for.
UNITS = {
    "%": "%", "percent": "%", "percentage": "%", "tco2e": "tCO2e", "tco2eq": "tCO2e", "kgco2e": "kgCO2e", "mwh": "MWh", "gwh": "GWh", "kwh": "kWh",
    "m3": "m3", "tonnes": "t", "tons": "t", "t": "t", "hours": "hours", "employees": "employees", "eur": "EUR", "million": "million", "billion": "billion",
}

#: Factor to the canonical unit of the same kind.
CONVERSIONS = {"kgCO2e": (0.001, "tCO2e"), "tCO2e": (1.0, "tCO2e"), "kWh": (0.001, "MWh"), "MWh": (1.0, "MWh"), "GWh": (1000.0, "MWh"), "%": (1.0, "%")}

NUMBER_UNIT = r"(-?\d[\d,]*(?:\.\d+)?)\s*(%|[A-Za-z][A-Za-z0-9]*)?"


def as_number(c: Column) -> Column:
    """A double of digits with commas or spaces between them; NULL if it is none."""
    return F.regexp_replace(c, r"[,\s ]", "").try_cast("double")


def number_units(text: Column) -> Column:
    """array<struct<value, unit>> of all numbers, with the word behind each if it is a unit, else NULL."""
    values = F.regexp_extract_all(text, F.lit(NUMBER_UNIT), 1)
    units = F.transform(F.regexp_extract_all(text, F.lit(NUMBER_UNIT), 2), lambda u: F.when(F.lower(u).isin(list(UNITS)), u))
    return F.zip_with(values, units, lambda v, u: F.struct(v.alias("value"), u.alias("unit")))


def first_metric(text: Column) -> Column:
    """The first number that is neither a year nor up to ten without a unit."""

    def good(m: Column) -> Column:
        n = as_number(m["value"])
        return m["unit"].isNotNull() | (~((n >= 1000) & (n <= 2099)) & (n > 10))

    return F.try_element_at(F.filter(number_units(text), good), F.lit(1))


def best_metric(text: Column) -> Column:
    """The number with most to say: ten points for a unit and one for each digit; the first on a tie. Numbers of over 15
    digits, or of one digit without a unit, don't count."""
    digits = lambda m: F.length(F.regexp_replace(m["value"], r"\D", ""))
    usable = F.filter(number_units(text), lambda m: (digits(m) <= 15) & (m["unit"].isNotNull() | (digits(m) >= 2)))
    scored = F.transform(usable, lambda m, i: F.struct((F.when(m["unit"].isNotNull(), 10).otherwise(0) + digits(m)).alias("score"), (-i).alias("early"), m["value"].alias("value"), m["unit"].alias("unit")))
    return F.array_max(scored)


def normalized_number(raw: Column) -> Column:
    return as_number(raw).cast("string")


def canonical_numeric(raw: Column, unit: Column | None = None, scales: Mapping[str, float] | None = None) -> Column:
    """A double of six significant digits, for the comparison of values: a comma is a decimal point, the first number
    counts, and the unit may scale it."""
    n = F.regexp_extract(F.replace(raw, F.lit(","), F.lit(".")), r"-?\d+(?:\.\d+)?", 0).try_cast("double")
    if unit is not None:
        for name, scale in (scales or {"million": 1e6, "billion": 1e9}).items():
            n = F.when(F.lower(unit) == name, n * scale).otherwise(n)
    return F.when(n == 0, F.lit(0.0)).when(n.isNotNull(), F.format_string("%.5e", n).try_cast("double"))


def unit_name(raw: Column) -> Column:
    """The unit that a spelling stands for, or the spelling itself."""
    pairs = [F.lit(x) for kv in UNITS.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.lower(F.trim(raw))), raw)


def converted(value: Column, unit: Column) -> Column:
    """struct<value, unit, status> in the canonical unit: converted, unknown_unit or no_value."""
    factor = F.create_map(*[F.lit(x) for u, (f, _) in CONVERSIONS.items() for x in (u, f)])
    target = F.create_map(*[F.lit(x) for u, (_, t) in CONVERSIONS.items() for x in (u, t)])
    known = F.element_at(target, unit).isNotNull()
    status = F.when(value.isNull(), F.lit("no_value")).when(~F.coalesce(known, F.lit(False)), F.lit("unknown_unit")).otherwise(F.lit("converted"))
    return F.struct(F.when(known, F.round(value * F.element_at(factor, unit), 6)).otherwise(value).alias("value"), F.when(known, F.element_at(target, unit)).otherwise(unit).alias("unit"), status.alias("status"))


def year_like(value: Column, unit: Column) -> Column:
    """Four digits, 1990 to 2035, without a unit."""
    return value.rlike(r"^\d{4}$") & value.try_cast("int").between(1990, 2035) & unit.isNull()


def plausible(value: Column, unit: Column, ranges: Mapping[str, tuple[float, float]]) -> Column:
    """Whether a value lies in its unit's range; units without a range allow any, and what is no number is implausible."""
    out = F.lit(True)
    for name, (lo, hi) in ranges.items():
        out = F.when(unit == name, value.between(lo, hi)).otherwise(out)
    return F.coalesce(value.isNotNull() & out, F.lit(False))


def year_with_source(year: Column, fiscal_year: Column, quote: Column) -> Column:
    """struct<year, source>: the year given, the fiscal year, or the latest year in the quote."""
    found = F.array_max(years(quote))
    given, fiscal = missing(year), missing(fiscal_year)
    source = F.when(given.isNotNull(), F.lit("year")).when(fiscal.isNotNull(), F.lit("fiscal_year")).when(found.isNotNull(), F.lit("quote")).otherwise(F.lit("missing"))
    return F.struct(F.coalesce(given, fiscal, found).alias("year"), source.alias("source"))


def unit_from(text: Column, units: Sequence[str]) -> Column:
    """The longest unit that a text contains, the first by name on a tie."""
    ordered = sorted(units, key=lambda u: (-len(u), u))
    return F.try_element_at(F.filter(F.array(*map(F.lit, ordered)), lambda u: F.lower(text).contains(F.lower(u))), F.lit(1))
