"""Rules over blocks, metrics, artifacts, statistics and audits, on small rows and against plain loops."""

import hashlib
import json
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from evidentia.functions import numbers as N, text as T
from evidentia.operators import artifacts as A, audits as Q, blocks as B, candidates as C, corpus, documents as D, evidence as E, filters, grams as G, kpi, metrics as M, retrieval as R, scoring, statistics as ST
from evidentia.operators.families import FAMILIES
from evidentia.plans import rules as P
from evidentia.plans.corpus import _search_hits
from evidentia.plans.queries import QUERIES
from evidentia.sources import tables as IO

from .conftest import DATA


def one(spark, column, **values):
    names = list(values)
    return spark.createDataFrame([tuple(values[n] for n in names)], ", ".join(f"{n} string" for n in names)).select(column.alias("x")).first().x


def test_block_predicates_on_single_texts(spark):
    true = [
        (B.is_contents_entry, "RISK AND CONTROL 12"), (B.is_footer_pattern, "12 2024 Universal Registration Document"), (B.is_timeline, "1998 Foundation of the house"), (B.is_timeline, "from 1999 to 2003"), (B.is_number_like, "12.5 million EUR"), (B.is_number_like, ""),
        (B.too_numeric, "A1 22 333"), (B.is_fragment, "(as of December 31)"), (B.is_fragment, "of the year"), (B.is_org_chart, "Dior Holding"), (B.is_diagram, "20% of 30%"), (B.is_sentence, "The results that are proposed by the board in this document"),
        (B.is_front_matter, "Fiscal year ended December 31"), (B.is_list_item, "12) second"), (B.is_caption, "Tableau 3 : x"), (B.is_footnote, "(a) a note that explains what it says"),
    ]
    false = [
        (B.is_contents_entry, "Risk and control"), (B.is_timeline, "2019 Highlights"), (B.is_number_like, "Chapter 3"), (B.is_fragment, "Offers of the year"), (B.is_org_chart, "CLIMATE RISK"), (B.is_sentence, "Climate change is used as a word that was not expected"),
        (B.is_footnote, "(a) too short"), (B.is_list_item, "plain - text"),
    ]
    assert [f.__name__ + x for f, x in true if not one(spark, f(F.col("t")), t=x)] == []
    assert [f.__name__ + x for f, x in false if one(spark, f(F.col("t")), t=x)] == []


def test_blocks_are_refined_by_the_first_rule(spark):
    rows = [
        (1, 1, "Annual report 7", "paragraph", 750.0, 780.0, False), (1, 2, "Annual report 8", "paragraph", 750.0, 780.0, False), (1, 1, "ACME", "title", 10.0, 20.0, False), (1, 2, "ACME", "title", 10.0, 20.0, False),
        (1, 1, "(1) a note that explains what it says", "paragraph", 720.0, 760.0, False), (1, 3, "OUR RISKS 12", "title", 300.0, 310.0, True), (1, 3, "- a point", "paragraph", 300.0, 310.0, False), (1, 3, "Figure 2 x", "title", 300.0, 310.0, False),
        (1, 4, "plain words", "paragraph", 300.0, 310.0, False), (1, 4, "2024 Universal Registration Document 9", "title", 750.0, 780.0, False),
    ]
    df = spark.createDataFrame(rows, "doc int, page int, text string, kind string, y0 double, y1 double, toc boolean").withColumn("h", F.lit(800.0))
    got = {(r.page, r.text): (r.kind, r.block_type_confidence) for r in B.refined(df, "doc", "page", "text", "kind", "y0", "y1", "h", "toc").collect()}
    assert got == {
        (1, "Annual report 7"): ("footer", 0.78), (2, "Annual report 8"): ("footer", 0.78), (1, "ACME"): ("header", 0.75), (2, "ACME"): ("header", 0.75), (1, "(1) a note that explains what it says"): ("footnote", 0.75),
        (3, "OUR RISKS 12"): ("toc_entry", 0.8), (3, "- a point"): ("list_item", 0.85), (3, "Figure 2 x"): ("caption", 0.85), (4, "plain words"): ("paragraph", 0.5), (4, "2024 Universal Registration Document 9"): ("footer", 0.85),
    }


def test_merged_headings_against_a_loop(spark):
    r, rows = random.Random(1), []
    for d in range(3):
        for i in range(40):
            rows.append((d, 1, i + (i // 13), r.choice(["Climate strategy,", "Water plans;", "Energy", "12 EUR"]), r.choice(["accepted"] * 3 + ["rejected_x"])))
    want = {}
    for d in range(3):
        mine = [list(x) for x in rows if x[0] == d]
        for x in mine:
            want[d, x[2]] = [x[3], False, x[4]]
        for x, y in zip(mine, mine[1:], strict=False):
            a, b = want[d, x[2]], want[d, y[2]]
            if a[2] == b[2] == "accepted" and y[2] == x[2] + 1 and "12 EUR" not in (x[3], y[3]) and x[3][-1] in ",;:":
                a[0], a[1], b[2] = f"{x[3]} {y[3]}", True, "rejected_heading_fragment"
    df = spark.createDataFrame(rows, "d int, page int, at int, text string, status string").repartition(4)
    assert {(x.d, x.at): [x.heading_text, x.was_merged, x.status] for x in B.merged_headings(df, "d", "page", "at", "text", "status").collect()} == want


def plain_evidence(rows, limit=800):
    out, last = [], None
    for d, s, p, o, t in sorted(rows, key=lambda x: (x[0], x[3])):
        q = t[:limit]
        if last and (last[0], last[1]) == (d, s) and o - last[3] == 1 and p - last[2] in (0, 1):
            now = out[-1][1]
            follows = len(now) < 120 or not re.search(r"[.!?;:]$", now) or re.match(r"(and|or|to|of|in|with|for|as|that|which|while|including)\b", q, re.I) or q[:1].islower()
            if len(now) + 1 + len(q) <= limit and follows:
                out[-1][1] += " " + q
                out[-1][2] += 1
                last = (d, s, p, o)
                continue
        out.append([(d, o), q, 1])
        last = (d, s, p, o)
    return sorted((*k, q, n) for k, q, n in out if len(q) >= 30)


def test_paragraph_evidence_against_a_loop(spark):
    r, rows = random.Random(7), []
    for d in range(5):
        o = page = 0
        for _ in range(60):
            o += r.choice([1, 1, 1, 1, 2])
            page += r.choice([0, 0, 0, 1, 2])
            rows.append((d, r.choice("aaab"), page, o, r.choice(["And so on ", "then more ", "A new one "]) + "x" * r.randrange(0, 300) + r.choice([".", "", ";"])))
    df = spark.createDataFrame(rows, "d int, s string, p int, o int, t string").repartition(3)
    got = B.paragraph_evidence(df, "d", "s", "p", "o", "t")
    assert sorted((x.d, x.o, x.quote, x.blocks) for x in got.collect()) == plain_evidence(rows)
    assert got.filter("review_short").count() == sum(len(x[2]) < 60 for x in plain_evidence(rows))
    heads = df.filter("o < 3").withColumn("quote", F.lit("  A title "))
    store = B.evidence_store(heads, got, "d", "s", "p", "o").collect()
    assert len({x.evidence_id for x in store}) == len(store) == heads.count() + got.count()
    assert min(x.evidence_id for x in store if x.d == 2) == "2_evidence_000001" and {x.quote for x in store if x.evidence_type == "section_heading"} == {"A title"}


def test_paragraph_evidence_of_nulls_and_long_blocks(spark):
    rows = [(None, "a", 1, 1, "first part of a sentence that goes"), (None, "a", 1, 2, "on here."), (7, "a", 1, 1, "y" * 1_000), (8, "a", 1, 1, None), (8, "a", 1, 2, "Z" * 40)]
    got = B.paragraph_evidence(spark.createDataFrame(rows, "d int, s string, p int, o int, t string").repartition(3), "d", "s", "p", "o", "t")
    assert {(x.d, x.o, len(x.quote), x.blocks, x.characters, x.truncated) for x in got.collect()} == {(None, 1, 43, 2, 42, False), (7, 1, 800, 1, 1_000, True), (8, 2, 40, 1, 40, False)}


def plain_value(line):
    best = None
    for m in re.finditer(M.VALUE_UNIT, line, re.ASCII):
        value, unit = re.sub(r"[\s,]", "", m[1]), (m[2] or "").strip()
        digits = len(re.sub(r"\D", "", value))
        if digits <= 15 and (digits >= 2 or unit) and (best is None or (10 if unit else 0) + digits > best[0]):
            best = ((10 if unit else 0) + digits, value, unit)
    return best and best[1:]


def test_metrics_of_whole_documents_against_a_loop(spark):
    """Exact and loose matches of every line of the registered table, by plain Python with the true ratio."""
    from .test_matching import plain_best, plain_longest

    words = {"in the": "m1", "und der": "m2", "the tion and": "m3", "que los": "m4"}
    plain = lambda t: " ".join(t.lower().translate(str.maketrans(T.MARKED, T.PLAIN)).split())
    want = {}
    for doc in spark.read.parquet(f"{DATA}/documents.parquet").collect():
        for i, line in enumerate(re.split("\r?\n", doc.text or "")):
            if hit := plain_longest(plain(line), words):
                want[doc.doc_id, i] = (words[hit], "exact", None)
            elif near := plain_best(plain(line), {k: (m,) for k, m in words.items()}):
                want[doc.doc_id, i] = (words[near[0]], "fuzzy", round(near[1], 4))
    got = QUERIES["metrics_of_documents"](spark, DATA).collect()
    assert {(r.doc_id, r.line): (r.metric_id, r.match_type, r.fuzzy_score) for r in got} == want
    assert {k for _, k, _ in want.values()} == {"exact", "fuzzy"}


def test_spans_of_null_keys_are_kept(spark):
    schema = "i int, d string, p int, v string, c double"
    left = spark.createDataFrame([(1, "a", None, "1,000", 0.3), (2, "a", None, "1000", 0.3), (3, None, 2, None, 0.2)], schema)
    right = spark.createDataFrame([(7, "a", None, "1 000", 0.9), (8, None, 2, "", 0.1), (9, None, None, "5", 0.4)], schema)
    got = {(r.i, r.c, r.engine) for r in M.merge_spans(left, right, "d", "p", "v", "c", "i").collect()}
    assert got == {(1, 0.9, "both"), (2, 0.3, "rules"), (3, 0.2, "rules"), (9, 0.4, "spans")}


def test_values_with_units_against_a_loop(spark):
    r = random.Random(3)
    lines = [" ".join(r.choice(["12", "1,250.5", "7", "2024", "MWh", "tCO2e", "%", "sites", "kt", "kto", "5 ha", "9 m3", "-", "1 000 000", "12345678901234567"]) for _ in range(r.randrange(1, 7))) for _ in range(300)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, t string").select("i", M.value_unit(F.col("t")).alias("m"))
    assert {x.i: x.m and (x.m.value, x.m.unit) for x in df.collect()} == {i: plain_value(x) for i, x in enumerate(lines)}


def test_metric_details(spark):
    assert one(spark, M.pointed_number(F.col("t")), t="1.234.5") == 1234.5 and one(spark, M.pointed_number(F.col("t")), t="1 234,5") == 1234.5
    assert one(spark, M.raw_number(F.col("t")), t="1.234.5") is None
    assert one(spark, M.is_plausible(F.col("v"), F.col("u"), F.lit("%")), v="120", u="") is False and one(spark, M.is_plausible(F.col("v"), F.col("u"), F.lit("%")), v="120", u="MWh") is True
    assert one(spark, M.is_year(F.col("v"), F.col("u")), v="2024", u="") is True and one(spark, M.is_year(F.col("v"), F.col("u")), v="2024", u="t") is False
    index = M.catalog_index([("renewable energy share", "m1", "a", "%"), ("Water", "m2", "b", "m3"), ("water", "m3", "c", "m3")])
    assert index["water"][0] == "m3"
    # the weighted ratio of edits, in place of a share of words: 75.3 for three right words among six
    assert one(spark, M.loose_keyword(F.col("t"), index), t="share of renewabl energy in all") is None
    assert one(spark, M.loose_keyword(F.col("t"), index), t="the renewabl energy share")["word"] == "renewable energy share"
    assert one(spark, M.loose_keyword(F.col("t"), index), t="energy of all the sites we have") is None
    assert one(spark, M.longest_keyword(F.col("t"), ["water", "water use", "use"]), t="waters, water use and use") == "water use"
    assert one(spark, M.first_substring(F.col("t"), ["use", "water"]), t="waters used") == "use"
    assert tuple(one(spark, M.keyword_class(F.col("t"), {"a": ["x", "y"], "b": ["z"]}), t="X and y and z")) == ("a", 0.45)
    assert tuple(one(spark, M.normalized_unit(F.col("v"), F.col("u"), F.lit("emissions")), v="2", u="ktCO2e"))[:2] == (2000.0, "tCO2e")


def test_embedding_is_the_hash(spark):
    raw = [b / 127.5 - 1 for b in hashlib.sha256(b"abc").digest()]
    norm = sum(x * x for x in raw) ** 0.5
    assert one(spark, R.hash_embedding(F.col("t")), t="abc") == pytest.approx([x / norm for x in raw] + [0.0] * 32)


def test_many_labels_are_found_by_their_inner_words(spark):
    r = random.Random(2)
    words = [f"w{i}" for i in range(30)]
    quotes = [" ".join(r.choice(words) for _ in range(40)) for _ in range(20)]
    labels = [" ".join(r.choice(words) for _ in range(r.randrange(1, 5))) for _ in range(80)] + [q[3:25] for q in quotes]
    q, x = spark.createDataFrame([(t,) for t in quotes], "q string"), spark.createDataFrame([(i, t) for i, t in enumerate(labels)], "i int, l string")
    want = sorted(i for i, t in enumerate(labels) if any(t in s for s in quotes))
    assert sorted(row.i for row in G.contained_labels(q, x, "q", "l").collect()) == want
    assert sorted(row.i for row in G.contained_labels(q, x.filter("size(split(l, ' ')) > 2"), "q", "l").collect()) == [i for i in want if len(labels[i].split(" ")) > 2]


def test_artifacts_are_loaded_without_raising(spark, tmp_path):
    os.makedirs(f"{tmp_path}/doc1")
    with open(f"{tmp_path}/doc1/text_blocks.jsonl", "w") as f:
        f.write(json.dumps({"text": "a"}) + "\n\n{broken\n" + json.dumps({"document_id": "x", "text": "b"}) + "\n")
    found, warned = A.load_artifacts(spark, str(tmp_path), {"text_blocks": "document_id string, text string"})
    assert sorted(map(tuple, found["text_blocks"].select("document_id", "text").collect())) == [("doc1", "a"), ("x", "b")]
    assert warned.count() == len(A.ARTIFACTS) - 1 and found["page_index"].count() == 0
    records = spark.createDataFrame([("d", "", None)], "document_id string, company string, fiscal_year int")
    assert [r.warning for r in A.metadata_warnings(records).collect()] == ["metadata_missing: company", "metadata_missing: fiscal_year"]


def test_cells_carry_their_headers(spark):
    cells = [(0, 0, "Item", 0), (0, 1, "2024", 1), (1, 0, "Energy", 2), (1, 1, "12 MWh", 3), (2, 0, "Heat", 4), (2, 1, "7", 5), (3, 1, "", 6), (4, 1, "9", 7)]
    df = spark.createDataFrame([("d", "t", 3, *c) for c in cells], "document_id string, table_id string, page_number int, row int, column int, text string, pos int")
    got = {r.text for r in A.cell_chunks(df, ["MWh", "GWh"], keep=7).collect()}
    assert got == {"Energy [col: Item]", "12 MWh [row: Energy | col: 2024]", "Heat [col: Item]", "7 [row: Heat | col: 2024 | unit: mwh]"}
    chunks = A.cell_chunks(df, ["MWh"], keep=7)
    hits = chunks.filter("text LIKE '7%'").select("chunk_id", F.lit("short").alias("snippet")).unionByName(spark.createDataFrame([("none", "said")], "chunk_id string, snippet string"))
    assert sorted(r.text for r in A.with_chunk(hits, chunks).collect()) == ["7 [row: Heat | col: 2024 | unit: mwh]", "said"]
    for f, cols in ((A.section_chunks, "section_id string, section_title string, section_type string"), (A.evidence_chunks, "section_id string, evidence_id string, evidence_type string, quote string"), (A.figure_chunks, "figure_id string, caption string")):
        row = spark.createDataFrame([("d", 1, *["text"] * (cols.count(",") + 1)), ("d", 2, *[" "] * (cols.count(",") + 1))], "document_id string, page_number int, " + cols)
        assert f(row).count() == 1


def test_figures_and_visuals(spark):
    images = spark.createDataFrame([(1, 1, 1), (1, 1, 2)], "d int, p int, o int")
    captions = spark.createDataFrame([(1, 1, 1, "one"), (1, 2, 1, "two")], "d int, p int, o int, text string")
    pages = spark.createDataFrame([(1, 1, True), (1, 3, True), (1, 4, False)], "d int, p int, looks_visual boolean")
    got = {r.figure_id: (r.detection_method, r.caption, r.figure_confidence) for r in A.figures_of_pages(images, captions, pages, "d", "p", "o").collect()}
    assert got == {"1_page_0001_fig_001": ("image", "one", 0.7), "1_page_0001_fig_002": ("image", None, 0.5), "1_page_0002_fig_001": ("caption", "two", 0.45), "1_page_0003_fig_001": ("page_heuristic", None, 0.25)}
    figures = spark.createDataFrame([("d", "f1", 3, "Energy chart", []), ("d", "f2", 1, None, ["blurry"])], "document_id string, figure_id string, page_number int, caption string, flags array<string>")
    crops = spark.createDataFrame([("f1", "c1", "a.png", 1), ("f1", "c2", "b.png", 2)], "figure_id string, crop_id string, crop_image_path string, pos int")
    ocr = spark.createDataFrame([("f1", "12 MWh", 1)], "figure_id string, ocr_text string, pos int")
    out = {r.figure_id: r for r in A.visual_candidates(figures, crops, ocr, N.first_metric(F.col("said"))).collect()}
    assert (out["f1"].crop_id, out["f1"].visual_type, out["f1"].information_type, out["f1"].raw_value, out["f1"].confidence) == ("c2", "chart", "visual_metric_candidate", "12", 0.45)
    assert (out["f2"].visual_type, out["f2"].confidence) == ("logo_or_cover", 0.15)


def test_review_rows(spark):
    rows = spark.createDataFrame([("a", "possible_indicator", 0.5, "low", "2"), ("b", "possible_indicator", 0.1, "high", "10"), ("c", "needs_review", 0.25, "high", "1")], "document_id string, s string, c double, review_priority string, page_number string")
    out = A.workspace(A.prevalidated(rows, F.col("s"), F.col("c"), F.lit("energy")), ["document_id"])
    got = {r.document_id: (r.validation_status, r.ready_for_manual_review, r.proposed_decision) for r in out.collect()}
    assert got == {"a": ("possible_indicator", "False", ""), "b": ("reject_candidate", "False", ""), "c": ("needs_review", "True", "")}
    assert [r.document_id for r in out.orderBy(*A.workspace_order()).collect()] == ["a", "b", "c"]
    ids = spark.createDataFrame([(1, None, "e", None, None), (2, " ", None, None, None)], "n int, canonical_candidate_id string, evidence_id string, cell_id string, figure_id string")
    assert [r.candidate_id for r in A.candidate_id(ids, ["n"]).orderBy("n").collect()] == ["e", "candidate_000002"]
    assert [r.candidate_rank for r in A.ranked_candidates(rows, "c", "document_id").orderBy("document_id").collect()] == [1, 3, 2]
    summary = spark.createDataFrame([(1, [("x", "t", "old"), ("x", "t", "new")]), (2, [("y", "t", "z")])], "pos int, documents array<struct<company_slug:string,official_doc_type:string,path:string>>")
    assert sorted(r.path for r in A.indexed_documents(summary, "documents", "pos").collect()) == ["new", "z"]
    no, yes = F.lit(False), F.lit(True)
    policy = lambda *a: one(spark, A.downstream_policy(*a), t="")
    empty = F.array().cast("array<string>")
    assert [policy(yes, F.lit("normal"), no, empty), policy(no, F.lit("normal"), no, F.array(F.lit("empty_table"))), policy(no, F.lit("normal"), no, F.array(F.lit("x"))), policy(no, F.lit("normal"), no, empty)] == ["exclude", "exclude", "review_required", "eligible"]


def test_sections_that_break_their_promise(spark):
    sections = spark.createDataFrame([(1, "a", "Report on the Certification", True), (1, "b", "Assurance", False), (1, "c", "Climate", True)], "d int, s string, title string, is_suspicious boolean")
    said = spark.createDataFrame([(1, "a", i, "nothing of it" if i < 5 else "the auditor") for i in range(8)] + [(1, "b", 1, "the auditor"), (1, "c", 1, "x")], "d int, s string, o int, quote string")
    assert [r.s for r in ST.title_mismatches(sections, said, "d", "s", "title", "quote", "o").collect()] == ["a"]
    got = {r.s: (r.evidence_count, len(r.sample_quotes)) for r in ST.suspicious_sections(sections, said, "d", "s", "quote", "o").collect()}
    assert got == {"a": (8, 5), "c": (1, 1)}
    objects = spark.createDataFrame([("d", 1, "t1", "x", ["empty_table"]), ("d", 1, "t2", "y", ["low"]), ("d", 1, "t3", " ", [])], "document_id string, page_number int, t string, q string, flags array<string>")
    assert [(r.source_element_id, r.review_required) for r in ST.object_evidence(objects, "t", F.col("q"), "flags", ["empty_table"]).collect()] == [("t2", True)]
    figures = ST.quantities(said, ["s"], {"size": F.length("quote")}).orderBy("s").first()
    assert (figures.n, figures.mean_size, figures.median_size) == (8, 12.25, 13.0)


def counts(df):
    return {r.check_name: (r.n, r.severity, r.status) for r in df.collect()}


def test_engine_audits(spark):
    text = "evidence_id string, information_type string, label string, quote string, raw_value string, raw_unit string, target_year string, confidence double, review_required boolean"
    rows = [("e1", "observed_metric", "l", "q", "1", None, None, 0.7, True), ("e1", "observed_metric", "l", None, " ", "t", None, 0.5, None), ("e2", "target", "l", "q", None, None, "", 0.3, True), ("e3", "visual_evidence", "l", "q", None, None, None, None, True)]
    got = counts(Q.audit(spark.createDataFrame(rows, text), Q.text_rules()))
    assert {k: v[0] for k, v in got.items()} == {"candidates_without_quote": 1, "observed_metric_without_value": 1, "observed_metric_without_unit": 1, "target_without_target_year": 1, "visual_evidence_low_confidence": 1, "confidence_above_0_6": 1, "review_required_missing_or_false": 1, "duplicate_evidence_type_label": 2}
    assert got["candidates_without_quote"][1:] == ("error", "needs_review")
    tables = "table_id string, cell_id string, metric_key string, raw_unit string, reported_year string, inferred_year string, validation_notes string, raw_value string, confidence double, review_required boolean, extraction_status string"
    rows = [("t", "c", "m", None, "2024", "True", "a;low_confidence_table", "1,2 3.4", 0.5, True, "candidate_only"), ("t", "c", "m", "t", None, "no", None, "12%", 0.9, False, None)]
    got = counts(Q.audit(spark.createDataFrame(rows, tables), Q.table_rules(), {"score_column_detected": (Q.columns_like(["a_score", "b"], "score"), "error")}))
    assert {k: v[0] for k, v in got.items()} == {k: 2 if k == "duplicate_candidates" else 1 for k in got} and got["score_column_detected"] == (1, "error", "needs_review")
    visual = "crop_status string, visual_warning string, ocr_status string, source_image_path string, figure_id string, confidence double, review_required boolean, visual_type string, raw_value string, raw_unit string, ocr_text string"
    rows = [("failed", "w", "ocr_failed", None, "", 0.6, False, "chart", "1", "", ""), ("ok", None, "ok", "p", "f", 0.4, True, "scanned_table", None, None, None), ("ok", None, "ok", "p", "f", 0.4, True, "unknown_visual", None, None, None), ("ok", None, "ok", "p", "f", 0.4, True, "cat", None, None, None)]
    got = counts(Q.audit(spark.createDataFrame(rows, visual), Q.visual_rules()))
    assert {v[0] for v in got.values()} == {1}
    clean = counts(Q.audit(spark.createDataFrame([], visual), Q.visual_rules()))
    assert {v for v in clean.values()} == {(0, "info", "pass")}


def test_dataset_rules_and_contract(spark):
    long = spark.createDataFrame([("c", 1, "v", "12", "", "found", "q"), ("c", 1, "w", "score 3", None, "conflicting_values", "see https://x"), ("c", 1, "w", None, None, "odd", None), ("c", 1, "z", None, None, "missing_from_corpus", None)], "company string, year int, variable_name string, value string, unit string, value_status string, quote string")
    evidence = spark.createDataFrame([("c", 1, "q")], "company string, year int, variable_name string")
    rows = long.withColumn("has_evidence", F.lit(False))
    hit = {k for k, v in counts(Q.audit(rows, Q.dataset_rules())).items() if v[0]}
    assert hit == {"found_without_evidence", "missing_variable", "conflicting_values", "unit_missing", "score_detected", "external_source_detected"}
    got = {k: v[0] for k, v in counts(Q.dataset_contract(long, evidence, ["v", "gone"], ["company", "year", "v", "my_score"])).items()}
    assert got == {"duplicate_cell": 2, "invalid_status": 1, "found_without_evidence": 1, "external_source_detected": 1, "missing_column": 1, "score_column_detected": 1}
    page = spark.createDataFrame([("", 2023, 2024, "x", None, 0.1), ("p", 2024, 2024, "x" * 60, "e", 0.9)], "path string, fiscal_year int, document_year int, text string, evidence_id string, confidence double")
    assert {v[0] for v in counts(Q.audit(page, Q.generic_checks())).values()} == {1}


def test_families_against_a_loop(spark):
    """Every family's score over the registered hits, rule by rule, from the family's own data."""
    norm = lambda t: " ".join(re.sub("[^a-z0-9]+", " ", t.lower().translate(str.maketrans(T.MARKED, T.PLAIN))).split())
    got = {(r.family, r.o_orderkey): (r.score, r.decision) for r in QUERIES["candidate_score_families"](spark, DATA).collect()}
    hits = _search_hits(spark, DATA).collect()
    assert len(got) == len(hits) * len(FAMILIES)
    for name, f in FAMILIES.items():
        p = lambda k: f.points.get(k, 0)  # noqa: B023, E731
        for h in hits:
            path = re.sub(r"^[a-z]+://[^/?#]*", "", h.url).split("#")[0]
            text, whole = norm(h.title + '  ' + path), f"{h.title} {h.url} {h.snippet}"
            has = lambda words: any(w in text for w in words)  # noqa: B023, E731
            years = set(re.findall(r"\b((?:19|20)\d{2})\b", whole))
            strong, second, weak0 = has(f.strong), has(f.secondary), has(f.weak)
            weak = weak0 and not strong
            company = norm(h.company).replace(" ", "") in norm(whole).replace(" ", "")
            pdf = ".pdf" in h.url.lower()
            file = norm(h.url.split('/')[-1])
            score = p("year") if "2024" in years else p("other_year") if years else p("no_year")
            score += p("strong") if strong else p("secondary") if second else 0
            score += p("weak") * weak + p("none") * (not strong and not second and not weak) + p("company") * company + p("no_company") * (not company)
            score += p("official") * (h.domain == h.official_domain or h.domain.endswith("." + h.official_domain)) + p("platform") * (h.domain in f.platforms) + p("pdf") * pdf + p("no_pdf") * (not pdf)
            score += p("filename") * (pdf and any(w in file for w in f.strong)) + p("low_trust") * (h.domain in f.low_trust)
            cap = 100.0
            score += sum(points for words, points in f.bonuses.values() if has(words) and (strong or second or weak)) + sum(points for domains, points in f.domains.values() if h.domain in domains)
            for k, (words, points, most) in f.penalties.items():
                if has(words) and not (k in f.without_keyword and (strong or second or weak)):
                    score, cap = score + points, min(cap, most)
            if not strong and not second and not weak:
                cap = min(cap, f.unknown_cap)
            score = max(0.0, min(score, cap))
            decision = "reject" if not (strong or second) or score < f.review else "pdf_resolution_required" if not pdf else "auto_download" if score >= f.accept else "human_review_required"
            assert got[name, h.o_orderkey] == (pytest.approx(score), decision), (name, h)


def test_all_families_in_one_pass(spark, monkeypatch):
    """Few distinct hits are scored once each, many row by row; both as one family at a time, also with nulls. No scan for each family."""
    hits = _search_hits(spark, DATA).limit(300)
    odd = hits.limit(3).withColumns({"title": F.lit(None).cast("string"), "official_domain": F.lit(None).cast("string")}).unionByName(hits.limit(2).withColumn("url", F.lit(None).cast("string")))
    hits = hits.unionByName(odd).localCheckpoint()
    rows = lambda df: sorted(map(tuple, df.select("family", "o_orderkey", "score", "decision").collect()))
    want = sorted(r for name, f in FAMILIES.items() for r in rows(scoring.score(hits, f).withColumn("family", F.lit(name))))
    assert rows(scoring.scored_by_all(hits, FAMILIES)) == want
    monkeypatch.setattr(scoring, "REPEATED", -1)
    assert rows(scoring.scored_by_all(hits, FAMILIES)) == want
    monkeypatch.undo()
    plan = QUERIES["candidate_score_families"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2


def test_class_decisions(spark):
    df = spark.createDataFrame([(True, False, 90.0, True), (False, True, 70.0, True), (False, False, 90.0, False), (True, False, 85.0, False), (False, False, 10.0, True)], "report boolean, notice boolean, score double, pdf boolean")
    kind = scoring.classified(df, [("notice", "notice"), ("report", "report")])
    out = df.withColumn("kind", kind)
    got = [r.x for r in out.select(scoring.class_decision(F.col("kind"), F.col("score"), F.col("pdf"), ["report"], ["notice"]).alias("x")).collect()]
    assert got == ["auto_download", "human_review_required", "pdf_resolution_required", "pdf_resolution_required", "reject"]


def test_corpus_plans(spark):
    rows = spark.createDataFrame([(1, ["a", "b"], "s", None), (2, ["a"], "s", "s"), (3, ["a"], "s", "x")], "id int, families array<string>, expected string, found string")
    got = sorted((r.id, r.family, r.target, r.copy_status) for r in corpus.organized(rows, "families", F.concat("family", F.lit("/x")), F.col("expected"), F.col("found")).collect())
    assert got == [(1, "a", "a/x", "to_copy"), (1, "b", "b/x", "to_copy"), (2, "a", "a/x", "present"), (3, "a", "a/x", "checksum_mismatch")]
    s = corpus.canonical_summary(spark.createDataFrame([(["a", "b"], 3), (["a"], 1)], "f array<string>, n int"), "f", "n").first()
    assert tuple(s) == (2, 1, 2, 3)
    groups = corpus.exact_duplicate_groups(spark.createDataFrame([(1, "h"), (2, "h"), (3, "g")], "document_id int, sha256 string"))
    docs = spark.createDataFrame([(1, "h"), (2, "h"), (3, "g")], "document_id int, sha256 string")
    assert sorted(map(tuple, corpus.duplicate_members(docs, groups).collect())) == [("exact_dup_0001", 1), ("exact_dup_0001", 2)]
    assert [r.x for r in filters.sampled_head(docs, [F.desc("document_id")], 2).select(F.col("document_id").alias("x")).collect()] == [3, 2]


def test_catalogs_and_reports(spark, tmp_path):
    path = f"{tmp_path}/c.json"
    json.dump({"env": {"m1": {"label_fr": "É", "unit_expected": "t", "keywords_fr": ["a"], "keywords_en": ["b"]}, "odd": 3}, "bad": 1}, open(path, "w"))
    assert IO.metric_entries(IO.read_catalog(spark, path)) == [("a", "m1", "É", "t"), ("b", "m1", "É", "t")] and IO.read_catalog(spark, f"{tmp_path}/none.json") == {}
    assert tuple(one(spark, IO.inferred_scope(F.col("t"), "Corpus"), t="/x/Corpus/acme/2024/d")) == ("acme", "2024")
    assert tuple(one(spark, IO.inferred_scope(F.col("t"), "Corpus"), t="/x/y/acme-2023_urd")) == ("acme", "2023") and tuple(one(spark, IO.inferred_scope(F.col("t"), "Corpus"), t="/x")) == (None, None)
    assert one(spark, IO.json_list(F.col("t")), t='["a", "b"]') == ["a", "b"] and one(spark, IO.json_list(F.col("t")), t="{bad") == [] and one(spark, IO.json_list(F.col("t")), t=None) == []
    df = spark.createDataFrame([(2, "b|c"), (1, "a\nd"), (3, None)], "n int, t string")
    assert IO.markdown(df, "T", ["n", "t"], ["n"], 2) == "# T\n\n| n | t |\n| --- | --- |\n| 1 | a d |\n| 2 | b\\|c |\n"
    assert IO.template(spark, ["a", "b"]).columns == ["a", "b"]
    os.makedirs(f"{tmp_path}/m")
    json.dump({"k": 1}, open(f"{tmp_path}/m/x_manifest.json", "w"))
    schema = IO.T.StructType.fromDDL("k int")
    assert [tuple(r) for r in IO.manifests_of(spark, {"a": (f"{tmp_path}/m", "*manifest.json"), "b": (f"{tmp_path}/gone", "*")}, schema).collect()] == [(1, "a")]
    store = f"{tmp_path}/store"
    IO.write_partitioned(spark.createDataFrame([("f", 1), ("g", 2)], "family string, n int"), store, ["family"])
    assert sorted(os.path.basename(x) for x in os.listdir(store) if "=" in x) == ["family=f", "family=g"] and {k: v.count() for k, v in IO.split_by(spark.read.parquet(store), "family", ["f", "z"]).items()} == {"f": 1, "z": 0}


def test_small_rules(spark):
    assert one(spark, D.use_policy(F.col("a") == "1", F.col("b") == "1", F.lit(False)), a="0", b="1") == "review_required"
    assert one(spark, T.safe_filename(F.col("t")), t=" a/b c.pdf ") == "a_b_c.pdf" and one(spark, T.plain_key(F.col("t")), t="É-a B") == "a b"
    assert one(spark, T.occurrences(F.col("t"), F.lit("ab")), t="ababxab") == 3 and one(spark, N.normalized_number(F.col("t")), t="1,250.5") == "1250.5"
    assert tuple(one(spark, IO.resolved([(F.col("a"), F.col("b")), (F.lit("c"), F.lit("2024"))]), a="x", b=" ")) == ("c", "2024")
    assert tuple(one(spark, E.section_quality([(F.lit(True), 0.3)], F.lit(False)), t="")) == (0.7, "review")
    assert one(spark, E.candidate_confidence(F.lit(0.5), F.lit(True), F.lit(False), F.lit(True)), t="") == pytest.approx(0.47)
    assert one(spark, E.constrained_status(F.col("v"), F.lit(True), F.lit(False), F.lit(0.05)), v="1") == "rejected_irrelevant"
    sections = spark.createDataFrame([("s", 0.4, "quarantine")], "section string, section_score double, section_policy string")
    got = E.with_section_policy(spark.createDataFrame([("s",), ("x",)], "section string"), sections, "section").collect()
    assert {r.section: (r.section_score, r.section_policy) for r in got} == {"s": (0.4, "quarantine"), "x": (1.0, "normal")}
    keys = lambda *k: spark.createDataFrame([(x,) for x in k], "k string")
    assert [r.k for r in kpi.missed(keys("a", "b"), keys("b"), ["k"]).collect()] == ["a"]
    attempts = spark.createDataFrame([([(200, "application/pdf")],), ([(403, "")],), ([(404, "")],), ([],)], "a array<struct<status_code:int,content_type:string>>")
    assert [r.x for r in attempts.select(scoring.download_status(F.col("a")).alias("x")).collect()] == ["ok", "blocked", "not_found", "failed"]
    assert callable(C.priority_rank)


def test_document_checks_fire_once_each(spark):
    from evidentia.operators import document_checks as K

    def hits(rules, schema, *rows):
        return {k: v[0] for k, v in counts(Q.audit(spark.createDataFrame(rows, schema), rules)).items()}

    got = hits(K.block_rules(), "block_type string, repeated int", ("toc_entry", 1), ("header", 2), ("footer", 1), ("footnote", 1), ("paragraph", 9))
    assert got == {"toc_entries_detected": 1, "header_footer_detected": 2, "repeated_header_footer_warning": 1, "footer_detection_refined": 1, "footnotes_detected": 1}
    got = hits(K.section_rules(), "page_start int, page_end int, section_type string, confidence double, last_page int", (1, 3, "climate", 0.9, 9), (0, 3, "unknown", 0.9, 9), (4, 3, "x", None, 9), (4, 10, "x", 0.7, 9))
    assert got == {"section_range_valid": 3, "section_unknown_ratio_warning": 1, "section_low_confidence_warning": 1, "sections_created": 4}
    schema = "quote string, source_element_id string, section_id string, section_known boolean, has_bbox boolean, policy string, review_required boolean, blocks int"
    got = hits(K.evidence_rules(), schema, ("x" * 70, "e", "s", True, True, "normal", False, 2), (" ", None, None, False, False, "odd", True, 1), ("short", "e", "gone", False, True, "quarantine", False, 1))
    assert got == {
        "evidence_store_created": 3, "evidence_quote_not_empty": 1, "evidence_source_exists": 1, "evidence_without_section_warning": 1, "evidence_section_link_valid": 1, "evidence_bbox_available": 1, "evidence_policy_assigned": 1,
        "evidence_policy_consistency_check": 1, "quarantined_evidence_detected": 1, "short_evidence_review_required": 1, "evidence_paragraph_merge_applied": 1,
    }
    schema = "figure_id string, extraction_status string, figure_type string, section_id string, has_bbox boolean, caption string, confidence double, detection_method string"
    got = hits(K.figure_rules(["chart"]), schema, ("f", "detected", "chart", "s", True, "c", 0.9, "image"), ("", "odd", "cat", None, False, "", 0.1, "page_heuristic"))
    assert set(got.values()) == {1}
    schema = "source_modality string, use_policy string, policy string, review_required boolean"
    rows = [("text", "eligible", "normal", False), ("sound", "", "normal", False), ("table", "maybe", "quarantine", False), ("figure", "eligible", "normal", True)]
    assert hits(K.multimodal_rules(), schema, *rows) == {"multimodal_evidence_index_created": 4, "modality_assignment_valid": 1, "downstream_use_policy_assigned": 1, "multimodal_evidence_policy_valid": 1, "quarantined_evidence_excluded_from_automatic_extraction": 1, "review_required_evidence_not_marked_eligible": 1}
    assert K.findings(spark.createDataFrame(rows, schema), K.multimodal_rules(), ["source_modality"]).count() == 5
