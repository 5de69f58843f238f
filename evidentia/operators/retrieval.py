"""Lexical and dense retrieval."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def tokens(docs: DataFrame, ident: str, text: str, pattern: str = "[^a-z0-9]+") -> DataFrame:
    """(ident, token, tf): counts of each document's tokens of two characters and more."""
    words = F.filter(F.split(F.lower(text), pattern), lambda w: F.length(w) >= 2)
    return docs.select(ident, F.explode(words).alias("token")).groupBy(ident, "token").agg(F.count(F.lit(1)).alias("tf"))


def distinct_tokens(docs: DataFrame, ident: str, text: str, pattern: str = "[^a-z0-9]+") -> DataFrame:
    """(ident, token): each document's tokens once, without a shuffle; enough to count the documents that have a token."""
    words = F.array_distinct(F.filter(F.split(F.lower(text), pattern), lambda w: F.length(w) >= 2))
    return docs.select(ident, F.explode(words).alias("token"))


def vocabulary(terms: DataFrame, ident: str, documents: int, size: int = 512) -> DataFrame:
    """(token, df, idf): tokens in at least 0.1 % and at most half of the documents, the rarest first, at most ``size``;
    if they are fewer, more frequent ones fill up. idf = ln((1 + n) / (1 + df)) + 1."""
    df = terms.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    low, high = max(1, documents // 1000), max(2, documents // 2)
    inside = F.col("df").between(low, high)
    # the limit is the size of the vocabulary; Spark keeps the top rows of each partition before it merges them
    first = df.filter(F.col("df") >= low).orderBy(F.desc(inside), F.when(inside, F.col("df")), F.desc("df"), "token").limit(size)
    return first.withColumn("idf", F.log((F.lit(documents) + 1.0) / (F.col("df") + 1.0)) + 1.0)


def tfidf(terms: DataFrame, vocab: DataFrame, ident: str) -> DataFrame:
    """(ident, token, weight): tf over the document's length, times idf, divided by the norm. The vocabulary has a fixed size."""
    length = terms.groupBy(ident).agg(F.sum("tf").alias("_length"))
    w = terms.join(F.broadcast(vocab), "token").join(length, ident).withColumn("w", F.col("tf") / F.col("_length") * F.col("idf"))
    return w.withColumn("weight", F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(ident)))).select(ident, "token", "weight")


def top(rows: DataFrame, by: Sequence[str], order: Sequence[Column | str], k: int) -> DataFrame:
    """The first k rows of each group; groups are cut before the shuffle."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= k)


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine of two arrays in double precision."""
    double = lambda x: F.transform(x, lambda v: v.cast("double"))
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v)
    x, y = double(a), double(b)
    dot = total(F.zip_with(x, y, lambda p, q: p * q))
    return dot / F.sqrt(total(F.transform(x, lambda v: v * v)) * total(F.transform(y, lambda v: v * v)))


def keyword_score(text: Column, terms: Column) -> Column:
    """Each contained term gives 0.05 + 0.005 for each letter, at most 0.15; at most 1 in all; repeats count again."""
    one = lambda t: F.least(F.lit(0.15), F.lit(0.05) + F.length(t) * 0.005)
    return F.least(F.lit(1.0), F.aggregate(F.filter(terms, lambda t: text.contains(t)), F.lit(0.0), lambda s, t: s + one(t)))


def unit_score(text: Column, units: Column) -> Column:
    return F.least(F.lit(1.0), F.size(F.filter(units, lambda u: text.contains(u))) * 0.35)


#: What a section adds by the variable's domain.
SECTION_BOOST = {"environmental": 0.15, "social": 0.10, "governance": 0.10, "sustainability": 0.12, "climate": 0.15, "financial": 0.08}

#: Patterns of structural noise.
NOISE = (r"(?i)\bISO\s*\d{4,5}\b", r"(?m)^\d{1,2}\.\d{1,2}$", r"(?i)\bpage\s+\d+\b", r"(?m)^\d{1}$")


def section_score(kind: Column, section: Column, domain: Column, doc_type: Column, preferred: Column) -> Column:
    """0.08 for a chunk of a table, half of its domain's boost for one in a section, 0.10 for a preferred type of document."""
    boost = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in SECTION_BOOST.items() for x in kv]), F.coalesce(domain, F.lit(""))), F.lit(0.0))
    one = lambda hit, x: F.when(hit, x).otherwise(0.0)
    return F.least(F.lit(1.0), one(kind.contains("table"), F.lit(0.08)) + one(F.length(section) > 0, boost * 0.5) + one(F.array_contains(preferred, doc_type), F.lit(0.10)))


def structural_penalty(text: Column, patterns: Sequence[str]) -> Column:
    """0.2 for each pattern found, at most 0.5."""
    return F.least(F.lit(0.5), sum((F.when(text.rlike(p), F.lit(0.2)).otherwise(0.0) for p in patterns), F.lit(0.0)))


def hybrid(semantic: Column, keyword: Column, unit: Column, section: Column, penalty: Column) -> Column:
    """The weighted sum of the parts, less the penalty, to four digits."""
    return F.round(semantic * 0.60 + keyword * 0.25 + unit * 0.10 + section * 0.05 - penalty, 4)


def candidate_score(retrieval: Column, value_unit: Column, evidence: Column, context: Column, penalty: Column) -> Column:
    extraction = value_unit * 0.35 + evidence * 0.35 + context * 0.30
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.round(retrieval * 0.40 + extraction * 0.35 + context * 0.25 - penalty, 4)))


def value_unit_coherence(value: Column, unit: Column, expected: Column, canonical: Column | None = None) -> Column:
    """0.1 without a value; 1 for an expected unit, 0.9 for its canonical form, 0.3 for another; 0.6 for a unit where none is
    expected, 0.4 without one."""
    has = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    fits = lambda u: F.exists(expected, lambda e: F.lower(u).contains(F.lower(e)) | F.lower(e).contains(F.lower(u)))
    asked = F.coalesce(F.size(expected), F.lit(0)) > 0
    near = F.lit(False) if canonical is None else F.coalesce(has(canonical) & fits(canonical), F.lit(False))
    known = F.when(fits(unit), 1.0).when(near, 0.9).otherwise(0.3)
    return F.when(~has(value), 0.1).when(has(unit) & asked, known).when(has(unit), 0.6).otherwise(0.4)


def evidence_quality(quote: Column, kind: Column, value: Column) -> Column:
    """0.3 for a quote, 0.3 if the value stands in it, 0.3, 0.2 or 0.1 by what it was taken from, 0.1 from 30 characters on."""
    one = lambda c, x: F.when(F.coalesce(c, F.lit(False)), F.lit(x)).otherwise(0.0)
    of = F.when(kind == "table_cell_context", 0.3).when(kind.isin("paragraph", "evidence"), 0.2).when(kind == "section", 0.1).otherwise(0.0)
    total = F.lit(0.3) + one((F.length(value) > 0) & quote.contains(value), 0.3) + of + one(F.length(quote) >= 30, 0.1)
    return F.when(F.coalesce(quote, F.lit("")) == "", 0.0).otherwise(F.round(F.least(F.lit(1.0), total), 4))


def context_score(quote: Column, terms: Column) -> Column:
    """0.12 for each of a variable's terms in the quote, at most 1."""
    found = F.size(F.filter(terms, lambda t: F.lower(quote).contains(F.lower(t))))
    return F.when(F.coalesce(quote, F.lit("")) == "", 0.0).otherwise(F.round(F.least(F.lit(1.0), found * 0.12), 4))


def hash_embedding(text: Column) -> Column:
    """A unit vector of 64 numbers out of the SHA-256 of a text, whose 32 bytes are followed by zeros. For tests: equal texts, equal vectors."""
    digest = F.sha2(F.coalesce(text, F.lit("")), 256)
    raw = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.conv(F.substring(digest, i * 2 + 1, F.lit(2)), 16, 10).cast("double") / 127.5 - 1.0)
    norm = F.sqrt(F.aggregate(raw, F.lit(0.0), lambda s, v: s + v * v))
    return F.concat(F.transform(raw, lambda v: v / norm), F.array_repeat(F.lit(0.0), 32))


def cell_context(cell: Column, column: Column, row: Column, title: Column, units: Sequence[str], iso: Column) -> Column:
    """struct<unit, unit_source, unit_conflict, is_footnote, is_iso, is_section_number> of a cell of a table: the unit of the
    cell, or of its column, its row, or the title; a conflict if column and row name different ones."""
    pattern = r"(?i)(" + "|".join(sorted(units, key=lambda u: -len(u))) + ")"
    first = lambda c: F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), pattern, 1), F.lit(""))
    own, col, line, head = first(cell), first(column), first(row), first(title)
    source = F.when(own.isNotNull(), F.lit("cell")).when(col.isNotNull(), F.lit("column_header")).when(line.isNotNull(), F.lit("row_header")).when(head.isNotNull(), F.lit("table_title"))
    t = F.trim(F.coalesce(cell, F.lit("")))
    return F.struct(
        F.coalesce(own, col, line, head).alias("unit"), source.alias("unit_source"), F.coalesce((source == "column_header") & (F.lower(line) != F.lower(col)), F.lit(False)).alias("unit_conflict"),
        t.rlike(r"^[(\[]?(\d|[a-zA-Z*])[)\]]?$").alias("is_footnote"), iso.alias("is_iso"), t.rlike(r"^\d{1,2}(\.\d{1,2})+$").alias("is_section_number"),
    )
