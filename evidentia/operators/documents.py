"""Blocks, sections, spans and evidence: operators over ordered rows inside a document."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .corpus import first_of
from .medians import with_medians


def repeated_lines(lines: DataFrame, page: str = "page", line: str = "line", least: int = 2) -> DataFrame:
    """Lines, with digits as #, that stand on at least ``least`` distinct pages: headers and footers."""
    norm = F.lower(F.trim(F.regexp_replace(line, r"\d", "#")))
    return lines.select(norm.alias("norm_line"), page).filter("norm_line <> ''").groupBy("norm_line").agg(F.count_distinct(page).alias("pages")).filter(F.col("pages") >= least)


def section_ranges(headings: DataFrame, document: str, page: str, order: str, last_page: str) -> DataFrame:
    """Adds page_end and end_order of each heading's section: up to the next heading; the last runs to the last page."""
    following = Window.partitionBy(document).orderBy(page, order)
    next_page, next_order = F.lead(page).over(following), F.lead(order).over(following)
    end = F.when(next_page.isNull(), F.col(last_page)).otherwise(F.greatest(F.col(page), next_page - 1))
    return headings.withColumn("page_end", end).withColumn("end_order", next_order).filter(F.col("page_end") >= F.col(page))


def page_to_section(pages: DataFrame, sections: DataFrame, document: str, page: str, start: str, end: str, section: str) -> DataFrame:
    """The section that a page lies in; of several the one that starts last. The join is on the document, so ranges meet only inside one."""
    s = sections.select(F.col(document).alias("_doc"), F.col(start).alias("_start"), F.col(end).alias("_end"), F.col(section).alias("_section"))
    inside = (F.col(document) == F.col("_doc")) & F.col(page).between(F.col("_start"), F.col("_end"))
    best = pages.join(s, inside).groupBy(*pages.columns).agg(F.max_by("_section", F.struct("_start", (-F.col("_section")))).alias(section))
    return pages.join(best, pages.columns, "left")


def block_to_section(blocks: DataFrame, sections: DataFrame, document: str, ident: str, page: str, order: str, section: str) -> DataFrame:
    """The section of a block by reading order inside the page range, with a confidence: 0.92 bounded, 0.88 open at the end, 0.65 by page alone."""
    s = sections.select(F.col(document).alias("_doc"), "page_start", "page_end", "start_order", "end_order", F.col(section).alias("_section"))
    met = blocks.join(s, (F.col(document) == F.col("_doc")) & F.col(page).between(F.col("page_start"), F.col("page_end")), "left")
    after = F.col(order) >= F.col("start_order")
    confidence = F.when(after & F.col("end_order").isNotNull() & (F.col(order) < F.col("end_order")), 0.92).when(after & F.col("end_order").isNull(), 0.88).when(F.col("_section").isNotNull(), 0.65)
    rank = first_of(met.withColumn("section_confidence", confidence), [ident], [F.desc_nulls_last("section_confidence"), F.asc_nulls_last("_section")])
    return rank.select(*blocks.columns, F.col("_section").alias(section), "section_confidence")


def islands(rows: DataFrame, by: Sequence[str], order: str, breaks: Column) -> DataFrame:
    """Numbers the runs inside which ``breaks`` (of a row against the one before) never holds."""
    w = Window.partitionBy(*by).orderBy(order)
    return rows.withColumn("_break", F.when(breaks, 1).otherwise(0)).withColumn("island", F.sum("_break").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_break")


def merge_paragraphs(blocks: DataFrame, document: str, order: str, text: str, limit: int = 800) -> DataFrame:
    """Joins neighbouring blocks of one document while the text stays within ``limit`` characters. The running length
    depends on where the last merge ended, so each document is folded in order; a document is one group."""

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        out: list[list] = []
        last = None
        for row in pdf.sort_values(order).itertuples(index=False):
            at, said = getattr(row, order), getattr(row, text) or ""
            if out and at == last + 1 and len(out[-1][2]) + 1 + len(said) <= limit:
                out[-1][2] += " " + said
                out[-1][3] += 1
            else:
                out.append([getattr(row, document), at, said, 1])
            last = at
        return pd.DataFrame(out, columns=[document, "first_order", "merged", "blocks"])

    kind = dict(blocks.dtypes)
    return blocks.groupBy(document).applyInPandas(fold, f"{document} {kind[document]}, first_order {kind[order]}, merged string, blocks long")


def segments(rows: DataFrame, document: str, order: str, text: str, limit: int = 1500) -> DataFrame:
    """Numbers segments of at most ``limit`` characters by a running length, as one fold over each document's ordered rows."""
    lengths = rows.groupBy(document).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.length(text).alias("n")))).alias("_all"))

    def add(state: Column, row: Column) -> Column:
        fits = state["used"] + row["n"] <= limit
        used = F.when(fits, state["used"] + row["n"]).otherwise(row["n"])
        seg = F.when(fits, state["seg"]).otherwise(state["seg"] + 1)
        return F.struct(used.cast("int").alias("used"), seg.cast("int").alias("seg"), F.concat(state["out"], F.array(F.struct(row["o"].alias("o"), seg.cast("int").alias("segment")))).alias("out"))

    kind = dict(rows.dtypes)[order]
    start = F.struct(F.lit(0).alias("used"), F.lit(0).alias("seg"), F.array().cast(f"array<struct<o:{kind},segment:int>>").alias("out"))
    placed = lengths.select(document, F.explode(F.aggregate("_all", start, add, lambda s: s["out"])).alias("p")).select(document, F.col("p.o").alias(order), F.col("p.segment").alias("segment"))
    return rows.join(placed, [document, order])


def window_max(rows: DataFrame, by: Sequence[str], order: Sequence[str], column: str, before: int = 3, after: int = 5) -> DataFrame:
    """The greatest value from ``before`` rows back to ``after`` rows on."""
    return rows.withColumn("context_max", F.max(column).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(-before, after)))


def or_next(rows: DataFrame, by: Sequence[str], order: Sequence[str], column: str) -> DataFrame:
    """The value of this row, or of the next one where it is NULL."""
    return rows.withColumn("value_or_next", F.coalesce(F.col(column), F.lead(column, 1).over(Window.partitionBy(*by).orderBy(*order))))


def nearest(left: DataFrame, right: DataFrame, on: Sequence[str], ident: str, at: str, other: str, other_at: str, within: float, bucket: float | None = None) -> DataFrame:
    """The nearest right row of the same key at a distance of at most ``within``, or NULL; the smaller ``other`` on a tie.

    Positions are cut into buckets as wide as the bound, and a row looks in its own and the two beside it, so a hot key
    doesn't meet itself in full.
    """
    width = bucket or within
    lefts = left.withColumn("_cell", F.explode(F.array(*(F.floor(F.col(at) / width) + d for d in (-1, 0, 1)))))
    rights = right.select(*(F.col(c).alias(f"_{c}") for c in on), F.col(other), F.col(other_at), F.floor(F.col(other_at) / width).alias("_bucket"))
    keys = F.col("_cell") == F.col("_bucket")
    for c in on:
        keys &= F.col(c) == F.col(f"_{c}")
    distance = F.abs(F.col(at) - F.col(other_at))
    met = lefts.join(rights, keys).withColumn("distance", distance).filter(F.col("distance") <= within)
    best = met.groupBy(ident).agg(F.min(F.struct("distance", other)).alias("_best"))
    return left.join(best.select(ident, F.col(f"_best.{other}").alias(other), F.col("_best.distance").alias("distance")), ident, "left")


def block_statistics(blocks: DataFrame, kind: str, text: str) -> DataFrame:
    """Count, share, mean and median length of each type."""
    out = with_medians(blocks, [kind], {"median_length": F.length(text)}, F.count(F.lit(1)).alias("blocks"), F.avg(F.length(text)).alias("mean_length"))
    return out.withColumn("share", F.col("blocks") / F.sum("blocks").over(Window.partitionBy()))


def page_diagnostics(blocks: DataFrame, page: Sequence[str], text: str, is_title: Column) -> DataFrame:
    """Low text, contents-like pages (8 titles and 5 ending in a number) and title density above 0.6."""
    out = blocks.groupBy(*page).agg(F.sum(F.length(text)).alias("characters"), F.count(F.lit(1)).alias("blocks"), F.count_if(is_title).alias("titles"), F.count_if(F.col(text).rlike(r"\d\s*$")).alias("ending_in_number"))
    return out.withColumns({"low_text": F.col("characters") < 100, "contents_like": (F.col("titles") >= 8) & (F.col("ending_in_number") >= 5), "title_dense": F.col("titles") > 0.6 * F.col("blocks")})


def section_type(title: Column, rules: Mapping[str, str]) -> Column:
    """struct<type, confidence> of the first rule whose pattern is in the title."""
    kind, sure = F.lit("unknown"), F.lit(0.25)
    for name, pattern in reversed(rules.items()):
        hit = title.rlike(pattern)
        kind, sure = F.when(hit, F.lit(name)).otherwise(kind), F.when(hit, F.lit(0.75)).otherwise(sure)
    return F.struct(kind.alias("type"), sure.alias("confidence"))


def use_policy(quarantined: Column, review: Column, empty: Column) -> Column:
    return F.when(quarantined | empty, F.lit("exclude")).when(review, F.lit("review_required")).otherwise(F.lit("eligible"))


def samples(rows: DataFrame, by: Sequence[str], order: Sequence[str], k: int) -> DataFrame:
    """The first k rows of each group."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn("sample", place).filter(F.col("sample") <= k)

