"""Hilbert-curve sharding: equal-count runs of documents that are close in several metadata dimensions.

Native: DataFrame functions only. Every row gets a cell on an integer grid (size, language and source, ``BITS`` bits
each), cells are numbered along the Hilbert curve, and the curve is cut into runs whose row counts differ by one at most
(law ``rows``). A dimension is cut at its quantiles, in the order of its values (texts in the order of their bytes),
so neighbours on the grid are neighbours in value, and files written in this order hold narrower ranges of each dimension
than files in any order by other columns: footers prune on all three.

Defined cases: null language or source is a category of its own; null text has size 1 and the CRC of no bytes; rows that
repeat are placed one by one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch, has_columns, ranked, sized

#: Bits of each dimension; the grid has 2 ** (3 * BITS) cells, which bounds every table of cells.
BITS = 5


def _turns(n: int) -> tuple[list[int], list[int], list[int]]:
    """For each position on the n-cube's Gray path: inverse Gray code by corner, entry corner and direction by position."""
    size = 1 << n
    gray = [i ^ (i >> 1) for i in range(size)]
    inverse = [gray.index(i) for i in range(size)]
    entry = [0 if i == 0 else gray[2 * ((i - 1) // 2)] for i in range(size)]
    ones = lambda i: ((i + 1) & -(i + 1)).bit_length() - 1  # noqa: E731  trailing one bits
    turn = [0 if i == 0 else ones(i - 1) % n if i % 2 == 0 else ones(i) % n for i in range(size)]
    return inverse, entry, turn


def hilbert_index(dims: Sequence[Column], bits: int = BITS) -> Column:
    """Position on the Hilbert curve of a cell given by integers below 2 ** bits, as one fold over the bits."""
    n = len(dims)
    inverse, entry, turn = (F.array(*map(F.lit, x)) for x in _turns(n))
    full = (1 << n) - 1
    at = lambda table, i: F.element_at(table, (i + 1).cast("int"))

    def rotated(x: Column, by: Column, left: bool) -> Column:
        k = F.pmod(by, F.lit(n)) if left else F.pmod(F.lit(n) - by, F.lit(n))
        up = F.call_function("shiftleft", x, k.cast("int"))
        down = F.call_function("shiftright", x, (F.lit(n) - k).cast("int"))
        return up.bitwiseOR(down).bitwiseAND(F.lit(full))

    def step(state: Column, i: Column) -> Column:
        corner = F.lit(0)
        for j, d in enumerate(dims):
            bit = F.call_function("shiftright", d.cast("int"), i).bitwiseAND(F.lit(1))
            corner = corner + bit * (1 << j)
        w = at(inverse, rotated(corner.bitwiseXOR(state["e"]), state["d"] + 1, left=False))
        return F.struct(
            (state["h"] * (1 << n) + w).cast("long").alias("h"),
            state["e"].bitwiseXOR(rotated(at(entry, w), state["d"] + 1, left=True)).cast("int").alias("e"),
            F.pmod(state["d"] + at(turn, w) + 1, F.lit(n)).cast("int").alias("d"),
        )

    start = F.struct(F.lit(0).cast("long").alias("h"), F.lit(0).alias("e"), F.lit(0).alias("d"))
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), start, step, lambda s: s["h"])


def with_places(scratch: Scratch, rows: DataFrame, column: str) -> DataFrame:
    """Adds ``{column}_place``, a whole number in the order of a text column's whole values; -1 for none. Distinct values are
    sorted by ranges, and numbered in that order task by task; they meet the rows by a join."""
    values = rows.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_value")).agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    values = scratch.keep(values.orderBy("_value").withColumn(f"{column}_place", F.monotonically_increasing_id()), f"values_{column}")
    # a value counts as one narrow row for each 100 bytes
    size = values.agg(F.sum(F.ceil((F.octet_length("_value") + 1) / 100))).first()[0] or 0
    out = rows.join(sized(values, size), F.col(column) == F.col("_value"), "left").drop("_value")
    return out.withColumn(f"{column}_place", F.coalesce(f"{column}_place", F.lit(-1).cast("long")))


def _below(c: str) -> Callable[[Column], Column]:
    return lambda x: x < F.col(c)


def grid_cell(rows: DataFrame, places: Sequence[str], bits: int = BITS) -> DataFrame:
    """Adds ``cell``: the place on the curve of the quantiles of these whole numbers. One aggregation finds the cuts. Equal
    cuts all count, so a dimension of few values is spread over the whole grid, and its halves part at the first bit."""
    steps = 1 << bits
    cuts = rows.agg(*(F.percentile_approx(c, [i / steps for i in range(1, steps)], 1_000).alias(c) for c in places)).first()
    dims = []
    for c in places:
        found = F.array(*(F.lit(x).cast("long") for x in cuts[c] or []))
        dims.append(F.size(F.filter(found, _below(c))) if cuts[c] else F.lit(0))
    return rows.withColumn("cell", hilbert_index(dims, bits))


def hilbert_shards(spark: SparkSession, docs: DataFrame, shards: int = 16, bits: int = BITS) -> DataFrame:
    """doc_id, size, text_crc32, cell, law, shard, slot for every row."""
    scratch = Scratch(spark, "hilbert")
    slim = has_columns(docs, doc_id="long", text="string", lang="string", source="string").select(
        F.monotonically_increasing_id().alias("rid"),
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        "lang",
        "source",
    )
    slim = scratch.keep(slim, "narrow")
    for dimension in ("lang", "source"):
        slim = with_places(scratch, slim, dimension)
    slim = scratch.keep(slim.drop("lang", "source"), "places")
    slim = grid_cell(slim, ["size", "lang_place", "source_place"], bits).drop("lang_place", "source_place")
    slim = scratch.keep(slim, "slim")
    # rows that repeat are told apart, so that any number of them is spread
    spread = F.xxhash64("doc_id", "text_crc32", "rid")
    placed, totals = ranked(scratch, slim, "cell", 1 << (3 * bits), spread, ["doc_id", "text_crc32", "rid"])
    rows = totals.agg(F.sum("in_group")).first()[0] or 0
    placed = placed.withColumn("rank", F.col("before") + F.col("rank_in"))
    placed = placed.withColumn("shard", F.expr(f"int(rank * {shards} div {max(rows, 1)})"))
    placed = placed.withColumn("slot", F.expr(f"rank - (shard * {rows}L + {shards - 1}) div {shards}"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "cell")
