"""Fixed cases for every type of a section and every status of a heading, and odd rows."""

import re

import pytest
from pyspark.sql import functions as F

from evidentia.operators import blocks as B
from evidentia.plans.queries import QUERIES

TITLES = {
    "Our anti-corruption programme": "anti_corruption", "Santé  Sécurité au siège": "health_safety", "RISK FACTORS": "risk_management", "Droits de l homme": "human_rights", "Remuneration of directors": "remuneration",
    "Biodiversité": "biodiversity", "The Board of Directors": "governance", "Plan de vigilance": "vigilance", "Limited assurance statement": "assurance", "GHG by site": "emissions", "EU taxonomy": "taxonomy",
    "Net-zero by design": "climate", "Énergie": "energy", "Gestion de l eau": "water", "Circular economy": "waste", "Gender equality": "diversity", "Talent": "workforce", "Code of conduct": "ethics", "Suppliers": "supply_chain",
    "Fondation": "community", "GRI index": "reporting", "Environment": "environment", "Social performance": "social", "Key figures": "general", "Watery tales": "unknown", "": "unknown", None: "unknown",
}

STATUSES = [
    ("Risk factors 9", "toc_entry", 0.5, "rejected_toc_entry"), ("Risk factors", "header", 0.5, "rejected_header_footer"), ("Risk factors", "footer", 0.5, "rejected_header_footer"), ("(1) A note", "footnote", 0.5, "rejected_footnote"),
    ("Table 3", "caption", 0.5, "rejected_structural_block"), ("- one", "list_item", 0.5, "rejected_list_item"), ("Risk factors", "paragraph", 0.9, "rejected_low_confidence"), ("  ", "title", 0.5, "rejected_too_short"),
    ("Sommaire", "title", 0.5, "rejected_toc_heading"), ("Annual Report", "title", 0.5, "rejected_document_title"), ("For the fiscal year ended in May", "title", 0.5, "rejected_front_matter"), ("Ab", "title", 0.5, "rejected_too_short"),
    ("12.5 EUR", "title", 0.5, "rejected_numeric_value"), ("ab 12 cd 345", "title", 0.5, "rejected_too_numeric"), ("2019 Acquisition of sites", "title", 0.5, "rejected_timeline_like"), ("In the last century", "title", 0.5, "rejected_timeline_like"),
    ("of the group", "title", 0.5, "rejected_heading_fragment"), ("Other Holding", "title", 0.5, "rejected_org_chart_like"), ("Shares: five % and seven % of all that there is", "title", 0.5, "rejected_org_chart_like"),
    ("What we said of it. And what we then did", "title", 0.5, "rejected_sentence_like_heading"), ("Our way of working", "title", 0.3, "rejected_low_confidence"), ("Way out", "title", 0.5, "rejected_low_confidence"), ("Climate strategy", "title", 0.5, "accepted"),
]


def test_every_section_type(spark):
    rows = spark.createDataFrame([(t,) for t in TITLES], "text string")
    got = {r.text: r.x for r in rows.select("text", B.section_class(F.col("text")).alias("x")).collect()}
    assert got == TITLES and set(TITLES.values()) >= set(B.SECTION_TYPES)


def test_section_types_by_single_patterns(spark):
    """One expression for each type gives what all its patterns give one by one."""
    words = [re.sub(r"\\b|[?]|\[- \]", lambda m: " " if "[" in m[0] else "", p) for patterns in B.SECTION_TYPES.values() for p in patterns]
    texts = [f"{a} {b}" for a, b in zip(words, reversed(words))] + [f"x{w}y" for w in words] + [f"the {w}." for w in words]
    want = [next((name for name, patterns in B.SECTION_TYPES.items() if any(re.search(p, t, re.ASCII) for p in patterns)), "unknown") for t in texts]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", B.section_class(F.col("text")).alias("x")).orderBy("i").collect()
    assert [r.x for r in got] == want


def test_every_status(spark):
    rows = spark.createDataFrame([(i, *s[:3]) for i, s in enumerate(STATUSES)], "i int, text string, kind string, sure double")
    got = rows.select("i", B.heading_status(F.col("text"), F.col("kind"), F.col("sure")).alias("x")).orderBy("i").collect()
    assert [(s[0], r.x) for r, s in zip(got, STATUSES)] == [(s[0], s[3]) for s in STATUSES]


@pytest.mark.parametrize("name", ["block_predicates", "section_classes", "heading_statuses", "heading_checks", "merged_headings", "visual_types"])
def test_null_and_empty_texts(spark, tmp_path, name):
    """A null text has no lines; an empty one has one."""
    spark.createDataFrame([(1, None), (2, ""), (None, "A, b,\r\nRISK FACTORS\n\n")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0, None)], "conv_id long, turn int, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    spark.createDataFrame([(5, "<h1 class='x'>Water</h1><h1></h1>"), (6, None)], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    out = QUERIES[name](spark, str(tmp_path))
    expected = {"heading_checks": 10, "merged_headings": 6}.get(name, 1 + 4 + 2)
    assert out.count() == expected
