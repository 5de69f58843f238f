"""Table reconstruction over cells in long form (table, row, column, text)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .corpus import first_of


def matrix(cells: DataFrame, table: str, row: str, column: str, text: str, position: str) -> DataFrame:
    """rows, columns, filled cells, and the grid as an array of rows; of several texts for a cell the last stands."""
    last = first_of(cells, [table, row, column], [F.desc(position)])
    # a row's cells meet first, then a table's rows, so that no cell is looked for among all others of its table
    of_row = F.map_from_entries(F.collect_list(F.struct(F.col(column).cast("int").alias("c"), F.col(text).alias("t"))))
    rows = last.groupBy(table, row).agg(of_row.alias("_cells"), F.max(column).alias("_last"), F.count_if(F.length(F.trim(text)) > 0).alias("_filled"))
    size = rows.groupBy(table).agg(
        (F.max(row) + 1).alias("row_count"), (F.max("_last") + 1).alias("column_count"), F.sum("_filled").alias("cell_count"), F.map_from_entries(F.collect_list(F.struct(F.col(row).cast("int").alias("r"), F.col("_cells").alias("m")))).alias("_rows")
    )
    none = F.create_map().cast("map<int,string>")
    cell = lambda m: F.transform(F.sequence(F.lit(0), (F.col("column_count") - 1).cast("int")), lambda c: F.coalesce(F.element_at(m, c), F.lit("")))
    grid = F.transform(F.sequence(F.lit(0), (F.col("row_count") - 1).cast("int")), lambda r: cell(F.coalesce(F.element_at("_rows", r), none)))
    status = F.when(F.col("cell_count") == 0, F.lit("empty")).otherwise(F.lit("reconstructed"))
    return size.select(table, "row_count", "column_count", "cell_count", status.alias("status"), grid.alias("grid"))


def with_headers(cells: DataFrame, table: str, row: str, column: str, text: str) -> DataFrame:
    """Adds each cell's row header (its row's column 0) and column header (its column's row 0)."""
    rows = cells.filter(F.col(column) == 0).groupBy(table, row).agg(F.max(text).alias("row_header"))
    columns = cells.filter(F.col(row) == 0).groupBy(table, column).agg(F.max(text).alias("column_header"))
    return cells.join(rows, [table, row], "left").join(columns, [table, column], "left")


def dominant(rows: DataFrame, by: Sequence[str], value: str, position: str) -> DataFrame:
    """The most frequent value of each group; the first seen on a tie."""
    counts = rows.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"), F.min(position).alias("first_pos"))
    return first_of(counts, by, [F.desc("n"), "first_pos"]).select(*by, value, "n")


def structure(cells: DataFrame, table: str, row: str, column: str, text: str) -> DataFrame:
    """Header rows (in the first five, with a year), year columns and label columns (words in a quarter of the rows)."""
    has_year = F.col(text).rlike(r"\b(?:19|20)\d{2}\b")
    label = (F.length(F.trim(text)) > 3) & ~F.col(text).rlike(r"\d")
    per_row = cells.groupBy(table, row).agg(F.bool_or(has_year).alias("year"))
    headers = per_row.groupBy(table).agg(F.array_sort(F.collect_list(F.when((F.col(row) < 5) & F.col("year"), F.col(row)))).alias("header_rows"), F.count(F.lit(1)).alias("rows"))
    per_column = cells.groupBy(table, column).agg(F.bool_or(has_year).alias("year"), F.count_if(label).alias("labels"))
    kinds = per_column.join(headers.select(table, "rows"), table).groupBy(table).agg(F.array_sort(F.collect_list(F.when(F.col("year"), F.col(column)))).alias("year_columns"), F.array_sort(F.collect_list(F.when(F.col("labels") * 4 >= F.col("rows"), F.col(column)))).alias("label_columns"))
    return headers.select(table, F.when(F.size("header_rows") > 0, F.col("header_rows")).otherwise(F.array(F.lit(0).cast("long"))).alias("header_rows")).join(kinds, table)


def numeric_cells(cells: DataFrame, text: str, is_header: Column, unit: Column, context_unit: Column, year: Column, fiscal_year: Column) -> DataFrame:
    """A candidate for each cell that is a number and no header: unit and year of its own or of its context, and a confidence."""
    number = F.col(text).rlike(r"^\s*-?\d[\d,\s]*(?:\.\d+)?\s*%?\s*$")
    out = cells.filter(number & ~is_header)
    confidence = F.round(F.lit(0.45) + F.when(unit.isNotNull(), 0.05).otherwise(0.0) + F.when(year.isNotNull(), 0.05).otherwise(0.0), 2)
    return out.withColumns({"unit": F.coalesce(unit, context_unit), "year": F.coalesce(year, fiscal_year), "confidence": confidence})


def row_texts(cells: DataFrame, table: str, row: str, column: str, text: str) -> DataFrame:
    """The text of each row: its cells that say something, in order."""
    said = F.filter(F.array_sort(F.collect_list(F.struct(column, F.col(text).alias("_t")))), lambda c: F.length(F.trim(c["_t"])) > 0)
    return cells.groupBy(table, row).agg(F.array_join(F.transform(said, lambda c: c["_t"]), " ").alias("row_text"))


def context_unit(cells: DataFrame, table: str, row: str, column: str, unit: str, is_header: str) -> DataFrame:
    """A table's unit: that of the first cell of a header row with one, else of the first cell with one."""
    place = F.struct((~F.col(is_header)).alias("h"), F.col(row).alias("r"), F.col(column).alias("c"))
    return cells.filter(F.col(unit).isNotNull()).groupBy(table).agg(F.min_by(unit, place).alias("context_unit"))


def cell_quality(cells: DataFrame, table: str, text: str) -> DataFrame:
    """Shares of empty, fragmented (up to two characters) and numeric cells."""
    t = F.trim(F.coalesce(text, F.lit("")))
    return cells.groupBy(table).agg(F.count(F.lit(1)).alias("cells"), F.avg((t == "").cast("double")).alias("empty_ratio"), F.avg(((F.length(t) > 0) & (F.length(t) <= 2)).cast("double")).alias("fragmented_ratio"), F.avg(t.rlike(r"^-?[\d.,\s]+%?$").cast("double")).alias("numeric_ratio"))


def positions(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "pos") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
