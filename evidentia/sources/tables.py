"""Readers and writers. Schemas are declared, never inferred; a missing path is an empty table where a schema is given."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def strings(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV file or folder with a header; columns are found by name, blanks become NULL, absent columns are NULL."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    first = [c.lstrip("﻿") for c in raw.columns]
    raw = raw.toDF(*first)
    return raw.select(*(F.nullif(F.trim(F.col(f"`{f.name}`")), F.lit("")).try_cast(f.dataType).alias(f.name) if f.name in first else F.lit(None).cast(f.dataType).alias(f.name) for f in schema))


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One object a line; blank lines are skipped."""
    return spark.read.schema(schema).json(path) if exists(spark, path) else spark.createDataFrame([], schema)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Whole-file objects, as manifests are."""
    return spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).json(path) if exists(spark, path) else spark.createDataFrame([], schema)


def discover(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """(path, length, modified) of all files below ``root`` whose names match, without their content."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root).select("path", "length", F.col("modificationTime").alias("modified"))


def path_parts(path: Column, root_depth: int, names: Sequence[str]) -> list[Column]:
    """Columns from the segments of a path below the root."""
    parts = F.split(path, "/")
    return [F.try_element_at(parts, F.lit(root_depth + i + 1)).alias(n) for i, n in enumerate(names)]


def year_in_path(path: Column) -> Column:
    """The year behind a company's name, as in name-2024 or name_2024."""
    return F.nullif(F.regexp_extract(path, r"[-_](20\d{2})(?:\D|$)", 1), F.lit(""))


def resolved(levels: Sequence[tuple[Column, Column]]) -> Column:
    """struct<company, fiscal_year> from the first level at which both are given."""
    pairs = [F.when(c.isNotNull() & y.isNotNull() & (F.trim(c) != "") & (F.trim(y) != ""), F.struct(c.alias("company"), y.alias("fiscal_year"))) for c, y in levels]
    return F.coalesce(*pairs)


def flat_manifest(manifests: DataFrame) -> DataFrame:
    """A registry row from a nested manifest; the reference year stands in for a missing fiscal year."""
    c = manifests.columns
    get = lambda path, default=None: F.coalesce(F.col(path), F.lit(default)) if path.split(".")[0] in c else F.lit(default)
    return manifests.select(
        get("company.name").alias("company"), get("company.slug").alias("company_slug"), F.coalesce(get("company.fiscal_year"), get("company.reference_year")).cast("string").alias("fiscal_year"),
        get("source.url").alias("url"), get("source.title").alias("title"), get("scoring.score").cast("double").alias("score"), get("file.sha256").alias("sha256"), get("file.path").alias("path"),
    )


def projected(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns in order; absent ones are blank, others are left out."""
    return df.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns))


def write_csv(df: DataFrame, path: str, columns: Sequence[str], overwrite: bool = False) -> None:
    """Fails if there is something at the path, unless it may be overwritten."""
    projected(df, columns).write.mode("overwrite" if overwrite else "errorifexists").option("header", True).csv(path)


def write_jsonl(df: DataFrame, path: str, overwrite: bool = False) -> None:
    df.write.mode("overwrite" if overwrite else "errorifexists").json(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], overwrite: bool = False) -> None:
    """A store of artifacts by family, company and year. Rows of a partition are brought together first, and split where they are many."""
    df.hint("rebalance", *by).write.mode("overwrite" if overwrite else "errorifexists").partitionBy(*by).parquet(path)


def split_by(df: DataFrame, column: str, values: Sequence[str]) -> Mapping[str, DataFrame]:
    return {v: df.filter(F.col(column) == v) for v in values}


def catalog(spark: SparkSession, entries: Mapping[str, Mapping], schema: str) -> DataFrame:
    """A fixed catalog, such as one read from YAML, as a table with its order."""
    return spark.createDataFrame([(i, k, *v.values()) for i, (k, v) in enumerate(entries.items())], schema)


def read_catalog(spark: SparkSession, path: str) -> Mapping[str, Mapping]:
    """A catalog file as nested mappings: JSON, or YAML where a parser for it is installed. A missing file is an empty
    catalog. Catalogs are small; the file is read on the driver, through Spark's own file systems."""
    if not exists(spark, path):
        return {}
    text = "\n".join(r.value for r in spark.read.option("wholetext", True).text(path).collect())
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as e:
        raise ValueError("no parser for YAML is installed; write the catalog as JSON") from e
    return yaml.safe_load(text) or {}


def metric_entries(catalog: Mapping[str, Mapping[str, Mapping]]) -> list[tuple[str, str, str, str]]:
    """(keyword, metric_id, label, unit) of a catalog of category, metric and its label_fr, label_en, unit_expected,
    keywords_fr and keywords_en, in file order; what isn't a mapping is passed over."""
    out = []
    for metrics in catalog.values():
        for metric, info in metrics.items() if isinstance(metrics, Mapping) else ():
            if isinstance(info, Mapping):
                label = info.get("label_fr") or info.get("label_en") or metric
                out += [(k, metric, label, info.get("unit_expected", "")) for k in [*info.get("keywords_fr", []), *info.get("keywords_en", [])]]
    return out


def manifests_of(spark: SparkSession, roots: Mapping[str, tuple[str, str]], schema: T.StructType) -> DataFrame:
    """The manifests of every family: ``roots`` has a folder and a name pattern for each. A family without a folder has none."""
    out = None
    for family, (root, pattern) in roots.items():
        there = exists(spark, root)
        read = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
        one = (read.json(root) if there else spark.createDataFrame([], schema)).withColumn("retriever", F.lit(family))
        out = one if out is None else out.unionByName(one)
    return out


def inferred_scope(path: Column, corpus: str) -> Column:
    """struct<company, fiscal_year> from a path: the two folders below the corpus root; else a name and the year behind it;
    else only what stands before the year. NULL parts where there is nothing."""
    parts = F.split(path, "/")
    at = F.array_position(parts, corpus)
    below = lambda i: F.when(at > 0, F.try_element_at(parts, (at + i).cast("int")))
    slug, year = (F.nullif(F.regexp_extract(path, r"([a-z0-9-]*[a-z0-9])[-_](20[0-9]{2})", i), F.lit("")) for i in (1, 2))
    good = below(2).rlike(r"^20[0-9]{2}$")
    return F.struct(F.when(good, below(1)).otherwise(slug).alias("company"), F.when(good, below(2)).otherwise(year).alias("fiscal_year"))


def json_list(text: Column) -> Column:
    """A list of texts written as JSON; an empty list where it doesn't parse or isn't one."""
    return F.coalesce(F.from_json(F.when(F.trim(text).startswith("["), text), "array<string>"), F.array().cast("array<string>"))


def markdown(rows: DataFrame, title: str, columns: Sequence[str], order: Sequence[str], n: int = 20) -> str:
    """A report's table of the first n rows, which are all that reaches the driver."""
    shown = rows.orderBy(*order).select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns)).limit(n).collect()
    cell = lambda x: x.replace("|", "\\|").replace("\n", " ")
    lines = [f"# {title}", "", "| " + " | ".join(columns) + " |", "|" + " --- |" * len(columns)]
    return "\n".join(lines + ["| " + " | ".join(cell(r[c]) for c in columns) + " |" for r in shown]) + "\n"


def template(spark: SparkSession, columns: Sequence[str]) -> DataFrame:
    """An empty table of text columns, for people to fill in."""
    return spark.createDataFrame([], strings(columns))


def keyword_map(entries: DataFrame, keywords: str, value: str, order: str) -> DataFrame:
    """(keyword, value): each keyword once; the last entry that lists it owns it."""
    words = entries.select(F.col(value), F.col(order), F.posexplode(keywords).alias("_at", "_word"))
    return words.groupBy(F.lower(F.trim("_word")).alias("keyword")).agg(F.max_by(value, F.struct(order, "_at")).alias(value))
