"""Filters over candidate rows. A blank argument, or a column that the frame hasn't, leaves the rows as they are."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import mapped

#: Families that are no indicator.
NOISY_FAMILIES = ["unknown", "boundary"]

#: A quote of fewer characters says nothing.
LEAST_QUOTE = 10


def equals(df: DataFrame, column: str, value: str | None) -> DataFrame:
    return df.filter(F.col(column).cast("string") == value) if value and column in df.columns else df


def has_value(df: DataFrame, column: str = "raw_value") -> DataFrame:
    return df.filter(F.trim(column) != "") if column in df.columns else df


def has_quote(df: DataFrame, column: str = "quote", least: int = LEAST_QUOTE) -> DataFrame:
    return df.filter(F.length(column) >= least) if column in df.columns else df


def matches(df: DataFrame, column: str, pattern: str | None) -> DataFrame:
    """Rows whose text matches a regular expression, whatever the case."""
    return df.filter(F.col(column).rlike(f"(?i){pattern}")) if pattern and column in df.columns else df


def filtered(df: DataFrame, equal: Mapping[str, str | None] | None = None, patterns: Mapping[str, str | None] | None = None, value: bool = False, quote: bool = False) -> DataFrame:
    """All of the given filters at once; Catalyst folds them into one and hands it to the scan."""
    for column, wanted in (equal or {}).items():
        df = equals(df, column, wanted)
    if value:
        df = has_value(df)
    if quote:
        df = has_quote(df)
    for column, pattern in (patterns or {}).items():
        df = matches(df, column, pattern)
    return df


def by_names(df: DataFrame, quote: str | None = None, **wanted: object) -> DataFrame:
    """Equality, as texts, on any columns by name, and a pattern on the quote."""
    return matches(filtered(df, {k: None if v is None else str(v) for k, v in wanted.items()}), "quote", quote)


def priority_queue(df: DataFrame) -> DataFrame:
    """Possible indicators of a known family with a value and a quote, which a person should see first."""
    rows = equals(df, "validation_status", "possible_indicator")
    if "indicator_family" in df.columns:
        rows = rows.filter(~F.coalesce(F.col("indicator_family").isin(NOISY_FAMILIES), F.lit(False)))
    return has_quote(has_value(rows))


def human_labels(df: DataFrame, labels: Mapping[str, str], columns: Mapping[str, str]) -> DataFrame:
    """Adds a readable column for each technical one; a value without a label stays as it is."""
    return df.withColumns({new: mapped(F.col(old), labels) for old, new in columns.items() if old in df.columns})


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The values of a column as sorted texts, without NULL."""
    return df.select(F.col(column).cast("string").alias("value")).filter("value IS NOT NULL").distinct().orderBy("value")


def business_view(df: DataFrame, columns: Mapping[str, str], labels: Mapping[str, str]) -> DataFrame:
    """The curated columns under their readable names, with readable values."""
    return df.select(*(mapped(F.col(old), labels).alias(new) if dict(df.dtypes)[old] == "string" else F.col(old).alias(new) for old, new in columns.items() if old in df.columns))


def table_outputs(row_text: Column, family: Column) -> Column:
    """The outputs that a table candidate goes to, as an array: observed, target (its row says so), context (unknown family)."""
    target = F.lower(F.coalesce(row_text, F.lit(""))).contains("target")
    unknown = F.coalesce(family == "unknown", F.lit(False))
    return F.array_compact(F.array(F.when(~target & ~unknown, F.lit("observed")), F.when(target, F.lit("target")), F.when(unknown, F.lit("context"))))


def sampled_head(df: DataFrame, order: Sequence[str | Column], n: int = 5) -> DataFrame:
    """The first n rows in a stated order: a report."""
    return df.orderBy(*order).limit(n)
