"""The end-to-end paths on small inputs."""

from pyspark.sql import functions as F

from evidentia.plans import paths


def test_value_path(spark):
    schema = "ident string, document_id string, company string, fiscal_year string, information_type string, page_number int, family string, label string, raw_value string, raw_unit string, year string, quote string, confidence double, pos int"
    table = spark.createDataFrame(
        [
            ("t1", "d1", "", "", "metric", 3, "steel", "steel output", "12.5", "t", "2024", "steel output was 12.5 t", 0.5, 1),
            ("t2", "d1", "Acme", "2024", "metric", 4, "brass", "brass output", "7", "t", "2024", "brass output was 7 t", 0.5, 2),
            ("t3", "d1", "Acme", "2024", "metric", 5, "brass", "brass output", "8", "t", "2024", "brass output was 8 t", 0.5, 3),
        ],
        schema,
    )
    csv = spark.createDataFrame([("c1", "d1", "Acme", "2024", "metric", 3, "steel", "steel output", "12.5", "t", "2024", "Steel  output was 12.5 t", 0.4, 4)], schema)
    decisions = spark.createDataFrame([("t1", "reject_candidate", 1), ("t1", "accept_candidate", 2), ("t2", "accept_candidate", 3), ("t3", "accept_candidate", 4)], "ident string, decision string, pos int")
    dictionary = spark.createDataFrame([(0, "steel_out", ["x"], ["steel"], ["steel"]), (1, "brass_out", ["x"], ["brass"], ["brass"]), (2, "tin_out", ["x"], ["tin"], ["tin"])], "variable_order int, variable_name string, keys array<string>, families array<string>, keywords array<string>")
    out = paths.value_path({"table": table, "csv": csv}, {}, decisions, dictionary, ["steel_out", "brass_out", "tin_out"])
    assert {r.ident: r.deduplication_status for r in out["consolidated"].collect()} == {"t1": "canonical", "c1": "duplicate", "t2": "unique_candidate", "t3": "unique_candidate"}
    assert {r.variable_name: (r.company, r.value_status, r.value) for r in out["selected"].collect()} == {"steel_out": ("Acme", "found", "12.5"), "brass_out": ("Acme", "conflicting_values", None), "tin_out": ("Acme", "missing_from_corpus", None)}
    assert out["wide"].select("steel_out").first()[0] == "12.5" and [r.document_id for r in out["lineage"].collect()] == ["d1"]
    assert {r.value_status for r in out["missing"].collect()} == {"conflicting_values", "missing_from_corpus"}


def test_corpus_path(spark):
    rows = [
        ("a", "h1", "acme", "2024", "annual", 90.0, 1, True, 120, "valid_pdf"),
        ("b", "h1", "acme", "2024", "annual", 95.0, 2, True, 120, "valid_pdf"),
        ("c", "h2", "acme", "2024", "annual", 99.0, 1, False, 2, "valid_pdf"),
        ("d", "h3", "acme", "2024", "annual", 99.0, 1, True, 80, "not_pdf"),
        ("e", None, "acme", "2024", "annual", 99.0, 1, True, 80, "valid_pdf"),
    ]
    registry = spark.createDataFrame(rows, "document_id string, sha256 string, company_slug string, fiscal_year string, document_family string, score double, candidate_rank int, official boolean, pages int, technical_status string")
    validation = spark.createDataFrame([("b", "likely_valid", 0.9), ("b", "needs_review", 0.8), ("c", "likely_wrong_company", 0.9)], "document_id string, status string, confidence double")
    out = paths.corpus_path(registry, validation, ["annual"])
    assert [r.document_id for r in out["selected"].collect()] == ["b"] and out["selected"].first().audit_bucket == "review"
    assert {r.document_id: r.selection_reason for r in out["rejected"].collect()} == {"c": "wrong_company", "d": "unreadable"}
    assert [r.members for r in out["duplicates"].collect()] == [["a", "b"]]


def test_retrieval_path(spark):
    chunks = spark.createDataFrame([(1, "carbon emissions were 12 tco2e", 0), (2, "the board met", 1), (3, "carbon emissions were 12 tco2e", 2), (1, "carbon emissions were 12 tco2e", 3)], "doc int, text string, pos int")
    catalog = spark.createDataFrame([("ghg", ["carbon", "emissions"], ["tco2e"]), ("board", ["board"], ["%"])], "variable_name string, terms array<string>, units array<string>")
    out = paths.retrieval_path([("text", chunks)], catalog, "doc", "text", "pos", k=5)
    assert out["chunks"].count() == 3
    got = out["retrieved"].orderBy("variable_name", "rank").select("variable_name", "document_id", "rank").collect()
    assert {(r.variable_name, r.document_id) for r in got} == {("ghg", "1"), ("ghg", "3"), ("board", "2")}
    assert out["retrieved"].filter(F.col("score") < 0).count() == 0
