"""Artifacts of a document and rows built from several of them: loading, lookups, modalities, chunks, review rows.

Lookups take one row a key first (the last, or the first, by a stated position), so a join never multiplies rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import collapse, first_case, hash_id, missing
from .corpus import first_of
from .tables import dominant

#: The artifacts of a document, and the columns without which one says nothing.
ARTIFACTS = ["text_blocks", "section_index", "evidence_store", "table_cells", "table_index", "figure_index", "page_index", "multimodal_evidence_index"]
REQUIRED = ["document_id", "company", "fiscal_year"]


def load_artifacts(spark: SparkSession, folder: str, schemas: Mapping[str, str], names: Sequence[str] = ARTIFACTS) -> tuple[dict[str, DataFrame], DataFrame]:
    """(frames by artifact, warnings): every artifact of every document under a folder, each with its document_id.

    An artifact that is nowhere is an empty frame with a warning; nothing raises. Files are ``<document>/<artifact>.jsonl``
    at any depth, read with the given schemas, and lines that don't parse are dropped.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found, warned = {}, []
    for name in names:
        schema = schemas.get(name, "document_id string")
        files = store.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/*/{name}.jsonl"))
        if files is None or not len(files):
            warned.append((name, "artifact_missing"))
            found[name] = spark.createDataFrame([], schema)
            continue
        rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(f"{folder}/*/{name}.jsonl")
        if "document_id" in rows.columns:
            place = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
            rows = rows.withColumn("document_id", F.coalesce(missing(F.col("document_id")), place))
        found[name] = rows
    return found, spark.createDataFrame(warned, "artifact string, warning string")


def metadata_warnings(records: DataFrame, required: Sequence[str] = REQUIRED) -> DataFrame:
    """document_id and a warning for each required field that a record leaves empty; values are never made up."""
    empty = F.array_compact(F.array(*(F.when(missing(F.col(c).cast("string")).isNull(), F.lit(f"metadata_missing: {c}")) for c in required)))
    return records.select("document_id", F.explode(empty).alias("warning"))


def looked_up(rows: DataFrame, side: DataFrame, on: Sequence[str], carried: Sequence[str], position: str, last: bool = True) -> DataFrame:
    """Left join with one row of the side for each key: the last by position, or the first."""
    pick = F.max_by if last else F.min_by
    one = side.groupBy(*on).agg(pick(F.struct(*carried), position).alias("_one"))
    return rows.join(one, list(on), "left").select(*rows.columns, *(F.col(f"_one.{c}").alias(c) for c in carried))


def with_index(records: DataFrame, index: DataFrame, position: str) -> DataFrame:
    """Company name and source file of a record by (company, fiscal_year), the first entry of the index; a company without
    one is named by its slug."""
    out = looked_up(records, index, ["company", "fiscal_year"], ["company_name", "final_path"], position, last=False)
    return out.withColumns({"company_name": F.coalesce("company_name", "company"), "final_path": F.coalesce("final_path", F.lit(""))})


def indexed_documents(summaries: DataFrame, documents: str, position: str) -> DataFrame:
    """(company_slug, official_doc_type) and the rest of each document in a run's summary, one for each key: the last."""
    rows = summaries.select(position, F.posexplode(documents).alias("_at", "_d")).select(position, "_at", "_d.*")
    return first_of(rows, ["company_slug", "official_doc_type"], [F.desc(position), F.desc("_at")]).drop(position, "_at")


def source_modality(evidence_type: Column, element_type: Column) -> Column:
    """table, figure or text, by what the evidence was taken from."""
    said = F.lower(F.concat_ws(" ", evidence_type, element_type))
    return F.when(said.contains("table"), F.lit("table")).when(said.contains("figure"), F.lit("figure")).otherwise(F.lit("text"))


def multimodal_index(evidence: DataFrame, tables: DataFrame, figures: DataFrame) -> DataFrame:
    """Evidence with the flags and confidence of the table or figure it stands on: found by source_element_id, else by
    table_id or figure_id. ``tables`` has table_id, flags, confidence and status; ``figures`` figure_id, flags, confidence."""
    t = tables.groupBy("table_id").agg(F.max_by(F.struct("flags", "confidence", "status"), "pos").alias("t"))
    g = figures.groupBy("figure_id").agg(F.max_by(F.struct("flags", "confidence"), "pos").alias("g"))
    side = lambda df, key, value, name: df.select(F.col(key).alias(f"_{name}"), F.col(value).alias(name))
    rows = evidence.withColumn("source_modality", source_modality(F.col("evidence_type"), F.col("source_element_type")))
    # only evidence of a modality asks for that modality's objects
    for kind, df, key, value in (("table", t, "table_id", "t"), ("figure", g, "figure_id", "g")):
        of = F.col("source_modality") == kind
        rows = rows.join(side(df, key, value, f"{value}1"), of & (F.col("source_element_id") == F.col(f"_{value}1")), "left")
        rows = rows.join(side(df, key, value, f"{value}2"), of & F.col(f"{value}1").isNull() & (F.col(key) == F.col(f"_{value}2")), "left")
    one = lambda v: F.coalesce(F.col(f"{v}1"), F.col(f"{v}2"))
    empty = F.coalesce(one("t")["status"] == "empty_table", F.lit(False))
    flags = F.coalesce(one("t")["flags"], one("g")["flags"], F.array().cast("array<string>"))
    flags = F.when(empty, F.array_union(flags, F.array(F.lit("empty_table")))).otherwise(flags)
    return rows.select(*evidence.columns, "source_modality", flags.alias("object_quality_flags"), F.coalesce(one("t")["confidence"], one("g")["confidence"], F.col("evidence_confidence")).alias("object_confidence"))


def downstream_policy(quarantined: Column, policy: Column, review: Column, flags: Column) -> Column:
    """exclude for quarantine and artefacts, review_required for doubts, else eligible."""
    return first_case(
        (quarantined | (policy == "quarantine"), "exclude"),
        (F.arrays_overlap(flags, F.array(*map(F.lit, ("empty_table", "table_artifact_suspected")))), "exclude"),
        (review | (policy == "review_required") | (F.size(flags) > 0), "review_required"),
        otherwise="eligible",
    )


#: Words of a visual's type, in the order in which they are tried.
VISUAL_WORDS = {
    "chart": ["chart", "graph", "evolution", "trend", "progression", "emission", "target", "objective", "scope", "intensity", "reduction", "performance", "indicator", "kpi", "energy consumption", "ghg", "co2", "water withdrawal", "%", "gwh", "mwh", "tco2e"],
    "scanned_table": ["table", "rows", "columns", "gri", "esrs", "dpef", "indicator table"],
    "org_chart": ["holding", "company", "companies", "org chart", "subsidiary", "structure"],
    "map": ["map"],
    "diagram": ["diagram", "process", "flow"],
}


def visual_type(text: Column, page: Column) -> Column:
    """struct<type, confidence>: covers first (page 1, or named so), then the first type with a word in the text, else unknown."""
    low = F.lower(F.coalesce(text, F.lit("")))
    any_of = lambda words: F.exists(F.array(*map(F.lit, words)), lambda w: low.contains(w))
    kind = first_case((low.contains("cover") | (page == 1), "logo_or_cover"), *((any_of(words), name) for name, words in VISUAL_WORDS.items()), otherwise="unknown_visual")
    return F.struct(kind.alias("type"), F.when(kind == "logo_or_cover", 0.85).when(kind == "unknown_visual", 0.25).otherwise(0.55).alias("confidence"))


def visual_information(text: Column, value: Column) -> Column:
    """What a visual tells of: a target, a metric, a risk, a policy, or its context."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return first_case(
        (low.rlike(r"\btarget\b|\bby\s+20[0-4][0-9]\b|\bobjective\b|\bnet.zero\b"), "visual_target_candidate"),
        (F.coalesce(value, F.lit("")) != "", "visual_metric_candidate"),
        (low.rlike(r"\brisk\b"), "visual_risk_evidence"),
        (low.rlike(r"\bpolicy\b|\bcommitment\b|\bengagement\b"), "visual_policy_evidence"),
        otherwise="visual_context_evidence",
    )


def visual_candidates(figures: DataFrame, crops: DataFrame, ocr: DataFrame, metric: Column, position: str = "pos") -> DataFrame:
    """One candidate for each figure: caption and OCR text together, its type, what it tells of, and a confidence.

    ``figures`` has document_id, figure_id, page_number, caption and flags; the last crop and OCR row of a figure count.
    ``metric`` is a struct<value, unit> over the column ``said``.
    """
    rows = looked_up(looked_up(figures, crops, ["figure_id"], ["crop_id", "crop_image_path"], position), ocr, ["figure_id"], ["ocr_text"], position)
    rows = rows.withColumn("said", collapse(F.concat_ws(" ", "caption", "ocr_text")))
    rows = rows.withColumns({"_m": metric, "_v": visual_type(F.concat_ws(" ", "said", F.array_join("flags", " ")), F.col("page_number"))})
    bad = F.arrays_overlap("flags", F.array(*map(F.lit, ("low_resolution", "blurry", "partial_crop", "ocr_failed"))))
    one = lambda c, x: F.when(F.coalesce(c, F.lit(False)), F.lit(x)).otherwise(0.0)
    sure = F.lit(0.2) + one(F.length("ocr_text") > 0, 0.1) + one(F.col("_m.value").isNotNull() & F.col("_m.unit").isNotNull(), 0.1) + one(F.col("_v.type").isin("chart", "scanned_table", "diagram"), 0.05) - one(bad, 0.05)
    return rows.select(
        "document_id", "figure_id", "crop_id", "page_number", F.col("_v.type").alias("visual_type"), visual_information(F.col("said"), F.col("_m.value")).alias("information_type"), F.col("_m.value").alias("raw_value"), F.col("_m.unit").alias("raw_unit"),
        "caption", F.substring("ocr_text", 1, 1000).alias("ocr_text"), F.col("crop_image_path").alias("source_image_path"), F.round(F.least(sure, F.lit(0.5)), 2).alias("confidence"), F.lit(True).alias("review_required"),
    )


def figures_of_pages(images: DataFrame, captions: DataFrame, pages: DataFrame, document: str, page: str, order: str) -> DataFrame:
    """Figures of a page by the first that it has of: images, each with the caption of its own number; captions alone; a
    heuristic for the whole page (``looks_visual``). One of the three for each page."""
    key = [document, page]
    w = Window.partitionBy(*key).orderBy(order)
    i = images.select(*key, F.row_number().over(w).alias("no"), F.lit("image").alias("detection_method"))
    c = captions.select(*key, F.row_number().over(w).alias("no"), F.col("text").alias("caption"))
    with_images = i.join(c, [*key, "no"], "left")
    alone = c.join(images.select(*key).distinct(), key, "left_anti").withColumn("detection_method", F.lit("caption"))
    seen = images.select(*key).unionByName(captions.select(*key)).distinct()
    whole = pages.filter("looks_visual").select(*key).distinct().join(seen, key, "left_anti").select(*key, F.lit(1).alias("no"), F.lit("page_heuristic").alias("detection_method"), F.lit(None).cast("string").alias("caption"))
    out = with_images.unionByName(alone).unionByName(whole)
    confidence = F.when(F.col("detection_method") == "image", F.when(F.col("caption").isNotNull(), 0.7).otherwise(0.5)).when(F.col("detection_method") == "caption", 0.45).otherwise(0.25)
    ident = F.concat_ws("_", F.col(document).cast("string"), F.lit("page"), F.lpad(F.col(page).cast("string"), 4, "0"), F.lit("fig"), F.lpad(F.col("no").cast("string"), 3, "0"))
    return out.withColumns({"figure_id": ident, "figure_confidence": confidence})


def text_chunks(blocks: DataFrame) -> DataFrame:
    """document_id, page_number, section_id, source_type, chunk_id, text of blocks; running heads and notes are context of their page."""
    kind = F.when(F.col("block_type").isin("header", "footer", "footnote"), F.lit("page_context")).when(F.col("block_type") == "table_caption", F.lit("figure_caption")).otherwise(F.lit("paragraph"))
    return _chunks(blocks, kind, F.col("text_block_id"), F.col("text"), F.col("section_id"))


def section_chunks(sections: DataFrame) -> DataFrame:
    said = F.when(F.trim("section_title") != "", F.concat(F.lit("[SECTION: "), F.coalesce("section_type", F.lit("unknown")), F.lit("] "), F.trim("section_title")))
    return _chunks(sections, F.lit("section"), F.col("section_id"), said, F.col("section_id"))


def evidence_chunks(evidence: DataFrame) -> DataFrame:
    kind = F.when(F.col("evidence_type").contains("text"), F.lit("paragraph")).otherwise(F.lit("page_context"))
    return _chunks(evidence, kind, F.col("evidence_id"), F.col("quote"), F.col("section_id"), F.lit("evidence"))


def figure_chunks(figures: DataFrame) -> DataFrame:
    return _chunks(figures, F.lit("figure_caption"), F.col("figure_id"), F.col("caption"), F.lit(""))


def _chunks(rows: DataFrame, kind: Column, ident: Column, text: Column, section: Column, named: Column | None = None) -> DataFrame:
    out = rows.select(F.col("document_id").cast("string").alias("document_id"), F.col("page_number").cast("string").alias("page_number"), section.cast("string").alias("section_id"), kind.alias("source_type"), ident.cast("string").alias("_id"), F.trim(text).alias("text"), (named if named is not None else kind).alias("_named"))
    return out.filter("text <> ''").withColumn("chunk_id", hash_id("chunk_", F.col("document_id"), F.col("_named"), F.col("_id"))).drop("_id", "_named")


def cell_chunks(cells: DataFrame, units: Sequence[str], keep: int = 200) -> DataFrame:
    """A chunk for each of a table's first ``keep`` cells (the feature's own limit): its text with the headers of its row and
    column, and the unit most frequent in its column if the cell has none.

    ``cells`` has document_id, table_id, page_number, row, column, text and pos.
    """
    first = cells.withColumn("_n", F.row_number().over(Window.partitionBy("document_id", "table_id").orderBy("pos"))).filter(F.col("_n") <= keep).drop("_n")
    at = ["document_id", "table_id"]
    heads = first.filter("row = 0").groupBy(*at, "column").agg(F.max_by(F.trim("text"), "pos").alias("column_header"))
    names = first.filter("column = 0 AND row > 0").groupBy(*at, "row").agg(F.max_by(F.trim("text"), "pos").alias("row_header"))
    pattern = r"(?i)(" + "|".join(sorted(units, key=lambda u: -len(u))) + ")"
    has = lambda c: F.regexp_extract_all(F.lower(c), F.lit(pattern), 1)
    hits = first.select(*at, "column", "pos", F.posexplode(has(F.col("text"))).alias("_i", "unit")).withColumn("_at", F.col("pos") * 1000 + F.col("_i"))
    usual = dominant(hits, [*at, "column"], "unit", "_at").drop("n")
    rows = first.filter("row > 0").join(heads, [*at, "column"], "left").join(names, [*at, "row"], "left").join(usual, [*at, "column"], "left")
    t = F.trim("text")
    said = lambda name, c, n: F.when((F.col(c) != "") & (F.col(c) != t), F.concat(F.lit(f"{name}: "), F.substring(c, 1, n)))
    lent = F.when(F.col("unit").isNotNull() & (F.size(has(t)) == 0), F.concat(F.lit("unit: "), F.col("unit")))
    context = F.concat_ws(" | ", said("row", "row_header", 60), said("col", "column_header", 40), lent)
    rows = rows.withColumn("text", F.when((t != "") & (context != ""), F.concat(t, F.lit(" ["), context, F.lit("]"))).otherwise(t))
    ident = F.concat(F.col("table_id").cast("string"), F.lit("_r"), F.col("row").cast("string"), F.lit("_c"), F.col("column").cast("string"))
    return _chunks(rows, F.lit("table_cell_context"), ident, F.col("text"), F.lit(""))


def with_chunk(retrieved: DataFrame, chunks: DataFrame) -> DataFrame:
    """The chunk's own text behind a hit, or else the hit's snippet."""
    one = chunks.groupBy("chunk_id").agg(F.min("text").alias("_text"))
    return retrieved.join(one, "chunk_id", "left").withColumn("text", F.coalesce(missing(F.col("_text")), F.col("snippet"))).drop("_text")


def trace_type(evidence: Column, table: Column, cell: Column, figure: Column) -> Column:
    """mixed, table_cell, visual_figure, text_evidence or unknown, by which ids a row has."""
    has = lambda *c: F.coalesce(*(missing(x.cast("string")) for x in c)).isNotNull()
    text, tabular, visual = has(evidence), has(table, cell), has(figure)
    n = sum((F.when(x, 1).otherwise(0) for x in (text, tabular, visual)), F.lit(0))
    return first_case((n > 1, "mixed"), (tabular, "table_cell"), (visual, "visual_figure"), (text, "text_evidence"), otherwise="unknown")


def candidate_id(row: DataFrame, order: Sequence[str]) -> DataFrame:
    """The first id that a candidate has, else its number in a stated order. The window is global: for a review's rows."""
    number = F.concat(F.lit("candidate_"), F.lpad(F.row_number().over(Window.orderBy(*order)).cast("string"), 6, "0"))
    ids = [missing(F.col(c).cast("string")) for c in ("canonical_candidate_id", "evidence_id", "cell_id", "figure_id")]
    return row.withColumn("candidate_id", F.coalesce(*ids, number))


def prevalidated(rows: DataFrame, status: Column, confidence: Column, family: Column, accept: float = 0.30, reject: float = 0.20) -> DataFrame:
    """A candidate's record before review: status with its reason, and whether a person is to see it. Sure candidates are
    accepted, doubtful ones rejected whatever their status."""
    rejected, sure = confidence < reject, (status == "possible_indicator") & (confidence >= accept)
    said = F.format_string("%.2f", confidence)
    reason = F.when(rejected, F.concat(F.lit("auto-rejected: confidence "), said)).when(sure, F.concat(F.lit("auto-accepted: confidence "), said)).otherwise(F.lit("rules"))
    final = F.when(rejected, F.lit("reject_candidate")).otherwise(status)
    return rows.withColumns({
        "validation_status": final, "validation_reason": reason, "indicator_family": family, "is_validated_indicator": F.lit("False"), "score_produced": F.lit("False"),
        "ready_for_manual_review": F.when((final == "reject_candidate") | (confidence >= accept), F.lit("False")).otherwise(F.lit("True")),
    })


#: Columns of a review workspace that a person fills in.
TO_FILL = ["proposed_decision", "reviewer", "review_date", "decision_reason", "corrected_value", "corrected_unit", "corrected_year", "corrected_indicator_family", "corrected_indicator_key", "needs_more_evidence_reason", "reviewer_notes"]


def workspace(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of a review with an id and the empty columns of a decision."""
    return rows.withColumn("review_item_id", hash_id("review_", *(F.col(c) for c in key))).withColumns({c: F.lit("") for c in TO_FILL if c not in rows.columns})


def workspace_order() -> list[Column]:
    """Possible indicators first, then by priority, document, page (as text) and id."""
    priority = F.when(F.col("review_priority") == "high", 0).when(F.col("review_priority") == "medium", 1).when(F.col("review_priority") == "low", 2).otherwise(9)
    return [F.when(F.col("validation_status") == "possible_indicator", 0).otherwise(1), priority, F.col("document_id").cast("string"), F.col("page_number").cast("string"), F.col("review_item_id")]


def ranked_candidates(rows: DataFrame, score: str, position: str, by: Sequence[str] = ()) -> DataFrame:
    """Candidates of a group by their score, the earlier one first on a tie."""
    return rows.withColumn("candidate_rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(score), position)))
