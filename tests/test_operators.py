"""Operators on small inline rows, against plain loops where SQL has no form for them."""

import random

import pytest
from pyspark.sql import functions as F

from evidentia.functions import numbers as N, text as T
from evidentia.operators import candidates as C, corpus, documents as D, retrieval as R, scoring as S, tables as M, variables as V
from evidentia.sources import links, tables as IO
from evidentia.streaming import ingest


def one(spark, column, **values):
    names = list(values)
    return spark.createDataFrame([tuple(values[n] for n in names)], ", ".join(f"{n} string" for n in names)).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "text, want",
    [("Été  à l'Œuvre!", "ete a l uvre"), ("  ", ""), ("ÇA--Va_1", "ca va 1"), (None, None)],
)
def test_normalize(spark, text, want):
    assert one(spark, T.normalize(F.col("t")), t=text) == want


def test_urls(spark):
    assert one(spark, T.domain(F.col("t")), t="https://WWW.Site.com:80/a?b#c") == "site.com:80"
    assert one(spark, T.path_and_query(F.col("t")), t="https://a.b/c/d?e=f#g") == "/c/d?e=f"
    for url, want in (("http://a/b.PDF", True), ("http://a/b.pdf?x=1", True), ("http://a/get?f=b.pdf&y", True), ("http://a/pdf/b.html", False)):
        assert one(spark, T.is_pdf_url(F.col("t")), t=url) is want
    page = "http://a.com/x/y.html?q"
    for link, want in (("/z", "http://a.com/z"), ("z.pdf", "http://a.com/x/z.pdf"), ("//b.com/z", "http://b.com/z"), ("https://c.com", "https://c.com")):
        assert one(spark, links.absolute(F.col("p"), F.col("l")), p=page, l=link) == want


def test_years_and_companies(spark):
    assert one(spark, T.years(F.col("t")), t="from 2024 to 1999, 2024 and 12024 or 1899") == ["1999", "2024"]
    assert one(spark, T.years_relevant(F.col("t"), F.lit(2024)), t="report 2023") is True
    assert one(spark, T.years_relevant(F.col("t"), F.lit(2024)), t="report 2020") is False
    assert one(spark, T.years_relevant(F.col("t"), F.lit(2024)), t="report") is True
    for text, want in (("airliquide results", True), ("the liquide air group", True), ("water only", False)):
        assert one(spark, T.company_matches(F.col("t"), F.lit("Air Liquide")), t=text) is want


def test_negation_window(spark):
    found = lambda t: one(spark, T.not_negated(F.col("t"), "target", ["no ", "without "]), t=t)
    assert found("we set a target") and not found("there is no target") and found("no plan. " + "x" * 70 + " a target") and not found("nothing")
    assert found("no target, but later " + "y" * 60 + " a target")


def test_short_quote(spark):
    text = "a" * 200 + ". " + "b" * 200
    assert one(spark, T.short_quote(F.col("t")), t=text) == "a" * 200 + "."
    assert one(spark, T.short_quote(F.col("t")), t="c" * 400) == "c" * 300 and one(spark, T.short_quote(F.col("t")), t=" d  e ") == "d e"


def test_numbers(spark):
    assert one(spark, N.first_metric(F.col("t")), t="In 2024 we had 7 plants and 1,250.5 MWh").asDict() == {"value": "1,250.5", "unit": "MWh"}
    assert one(spark, N.first_metric(F.col("t")), t="in 2024, 7") is None
    assert one(spark, N.best_metric(F.col("t")), t="5 and 12345 or 12 %")["value"] == "12"
    assert one(spark, N.canonical_numeric(F.col("t")), t="1234567") == one(spark, N.canonical_numeric(F.col("t")), t="1234568")
    assert one(spark, N.canonical_numeric(F.col("t")), t="102,887") == pytest.approx(102.887) and one(spark, N.canonical_numeric(F.col("t")), t=None) is None
    assert one(spark, N.canonical_numeric(F.col("t"), F.lit("million")), t="2.5") == 2.5e6
    assert tuple(one(spark, N.converted(F.lit(1500.0), F.col("t")), t="kWh")) == (1.5, "MWh", "converted")
    assert one(spark, N.converted(F.lit(1.0), F.col("t")), t="apples")["status"] == "unknown_unit"
    assert one(spark, N.unit_from(F.col("t"), ["t", "tCO2e", "MWh"]), t="12 tco2e") == "tCO2e"
    assert one(spark, N.year_like(F.col("t"), F.lit(None)), t="2024") is True and one(spark, N.plausible(F.lit(120.0), F.col("t"), {"%": (0, 100)}), t="%") is False


def test_merge_and_segments_match_loops(spark):
    r = random.Random(1)
    rows = [(d, i * (2 if r.random() < 0.1 else 1) + 100 * d, "x" * r.randrange(0, 500)) for d in range(4) for i in range(30)]
    rows = sorted({(d, o): (d, o, t) for d, o, t in rows}.values())
    df = spark.createDataFrame(rows, "doc long, ord long, text string")
    want = []
    for d in range(4):
        last, length = None, 0
        for _, o, t in (x for x in rows if x[0] == d):
            if last is not None and o == last + 1 and length + 1 + len(t) <= 800:
                want[-1][2] += 1
                length += 1 + len(t)
            else:
                want.append([d, o, 1])
                length = len(t)
            last = o
    got = D.merge_paragraphs(df, "doc", "ord", "text").orderBy("doc", "first_order").collect()
    assert [[g.doc, g.first_order, g.blocks] for g in got] == want
    seg = {}
    for d in range(4):
        used, n = 0, 0
        for _, o, t in (x for x in rows if x[0] == d):
            if used + len(t) <= 1500:
                used += len(t)
            else:
                used, n = len(t), n + 1
            seg[d, o] = n
    assert {(g.doc, g.ord): g.segment for g in D.segments(df, "doc", "ord", "text", 1500).collect()} == seg


def test_components_match_union_find(spark):
    r = random.Random(2)
    rows = [(i, [r.gauss(0, 1) for _ in range(3)], i % 2) for i in range(60)]
    to = list(range(60))

    def root(i):
        while to[i] != i:
            i = to[i]
        return i

    norm = lambda v: sum(x * x for x in v) ** 0.5
    for i, v, s in rows:
        for j, w, q in rows[:i]:
            if s == q and sum(a * b for a, b in zip(v, w, strict=True)) >= 0.9 * norm(v) * norm(w):
                a, b = root(i), root(j)
                to[max(a, b)] = min(a, b)
    df = spark.createDataFrame(rows, "id long, v array<double>, s int")
    assert {g.id: g.component for g in C.similar_components(df, "id", "v", ["s"], 0.9).collect()} == {i: root(i) for i in range(60)}


def test_long_chains_are_one_component(spark):
    # neighbours in the chain 0-20-19-...-1 share one of their two dimensions: cosine 0.5, all others 0
    chain = [0, *range(20, 0, -1)]
    rows = [(i, [float(k in (at, at + 1)) for k in range(22)], s) for s in (0, 1) for at, i in enumerate(x + 100 * s for x in chain)]
    df = spark.createDataFrame(rows, "id long, v array<double>, s int")
    assert {g.id: g.component for g in C.similar_components(df, "id", "v", ["s"], 0.45).collect()} == {i: 100 * s for i, _, s in rows}


def test_nearest_is_bounded(spark):
    left = spark.createDataFrame([(1, "a", 100.0), (2, "a", 500.0), (3, "b", 100.0)], "id int, k string, at double")
    right = spark.createDataFrame([(10, "a", 60.0), (11, "a", 140.0), (12, "a", 700.0), (13, "b", 181.0)], "other int, k string, other_at double")
    assert [tuple(x) for x in D.nearest(left, right, ["k"], "id", "at", "other", "other_at", 80.0).select("id", "other", "distance").orderBy("id").collect()] == [(1, 10, 40.0), (2, None, None), (3, None, None)]


def test_duplicates_and_consensus(spark):
    rows = [("c1", "table", "k", 0.50, "qq", 1), ("c2", "csv", "k", 0.58, "q", 2), ("c3", "visual", "z", 0.4, "q", 3)]
    df = spark.createDataFrame(rows, "ident string, source_engine string, key string, confidence double, quote string, pos int")
    out = C.consensus_boost(C.mark_duplicates(df, "key", [C.engine_rank(F.col("source_engine")), -F.col("confidence"), F.length("quote")], "pos", "ident"))
    assert {r.ident: (r.deduplication_status, round(r.confidence, 3)) for r in out.collect()} == {"c1": ("canonical", 0.55), "c2": ("duplicate", 0.58), "c3": ("unique_candidate", 0.4)}


def test_value_statuses(spark):
    rows = [("a", 2024, "x", "10", "u", "q", 1), ("a", 2024, "x", "10.0", "u", "q", 2), ("a", 2024, "y", "10", "u", "q", 3), ("a", 2024, "y", "11", "u", "q", 4), ("a", 2024, "z", None, None, "q", 5), ("a", 2024, "w", None, None, None, 6)]
    df = spark.createDataFrame(rows, "company string, year int, variable_name string, value string, unit string, quote string, ident int")
    out = V.select_values(df, df.select("company", "year").distinct(), ["x", "y", "z", "w", "v"], N.canonical_numeric(F.col("value")), ["ident"])
    assert {r.variable_name: (r.value_status, r.value) for r in out.collect()} == {"x": ("found", "10"), "y": ("conflicting_values", None), "z": ("qualitative_only", None), "w": ("needs_review", None), "v": ("missing_from_corpus", None)}


def test_selection_groups_null_hashes(spark):
    rows = [(1, "g", None, 5), (2, "g", None, 4), (3, "g", "h", 3), (4, "h", None, 1)]
    out = corpus.ranked_selection(spark.createDataFrame(rows, "id int, g string, sha string, s int"), ["g"], [F.desc("s"), "id"], [(F.col("s") < 0, "never")], same="sha")
    assert {r.id: (r.selection_status, r.selection_reason) for r in out.collect()} == {1: ("selected", None), 2: ("rejected", "same_hash"), 3: ("rejected", "lower_ranked"), 4: ("selected", None)}


def test_scorer(spark):
    rows = [("ACME annual report 2024", "https://acme.com/annual-report-2024.pdf", "acme.com"), ("notice of meeting annual report", "https://acme.com/n.pdf", "acme.com"), ("cats", "https://x.com/a", "x.com"), ("ACME annual report 2024", "https://acme.com/annual", "acme.com")]
    df = spark.createDataFrame(rows, "title string, url string, domain string").withColumns({"snippet": F.lit(""), "company": F.lit("Acme"), "official_domain": F.lit("acme.com"), "fiscal_year": F.lit(2024)})
    family = S.Family("annual", strong=["annual report"], points=S.POINTS["annual"], penalties={"notice": (["notice of meeting"], -50, 55)})
    got = S.score(df, family).collect()
    assert [r.decision for r in got] == ["auto_download", "reject", "reject", "pdf_resolution_required"] and got[0].score == 100 and "notice" in got[1].negative_signals
    assert set(S.POINTS) >= {"annual", "climate", "cdp", "policy"} and len(S.POINTS) == 14


def test_matrix_last_cell_wins(spark):
    cells = spark.createDataFrame([("t", 0, 0, "a", 1), ("t", 1, 1, "b", 2), ("t", 1, 1, "c", 3)], "t string, r int, c int, x string, p int")
    r = M.matrix(cells, "t", "r", "c", "x", "p").first()
    assert (r.row_count, r.column_count, r.cell_count, r.status, r.grid) == (2, 2, 2, "reconstructed", [["a", ""], ["", "c"]])


def test_keyword_score_counts_repeats(spark):
    terms = F.array(F.lit("abc"), F.lit("abc"), F.lit("none"))
    assert one(spark, R.keyword_score(F.col("t"), terms), t="xabcx") == pytest.approx(0.13)


def test_csv_reader_and_sinks(spark, tmp_path):
    path = f"{tmp_path}/a.csv"
    with open(path, "w", encoding="utf-8-sig") as f:
        f.write('id,name,extra\n1," x ",z\nbad,,z\n')
    got = IO.read_csv(spark, path, IO.T.StructType.fromDDL("id int, name string, absent double"))
    assert [tuple(r) for r in got.collect()] == [(1, "x", None), (None, None, None)]
    assert IO.read_csv(spark, f"{tmp_path}/none.csv", got.schema).count() == 0
    out = f"{tmp_path}/out"
    IO.write_csv(got, out, ["name", "id", "other"])
    assert spark.read.option("header", True).csv(out).columns == ["name", "id", "other"]
    with pytest.raises(Exception, match="(?i)exist"):
        IO.write_csv(got, out, ["name"])
    IO.write_csv(got, out, ["name"], overwrite=True)
    IO.write_jsonl(got, f"{tmp_path}/j")
    assert IO.read_jsonl(spark, f"{tmp_path}/j", got.schema).count() == 2


def test_manifests_and_paths(spark, tmp_path):
    import json
    import os

    os.makedirs(f"{tmp_path}/m/acme/2023")
    json.dump({"company": {"name": "Acme", "slug": "acme", "reference_year": 2023}, "source": {"url": "u"}, "file": {"sha256": "s"}}, open(f"{tmp_path}/m/acme/2023/manifest.json", "w"))
    schema = IO.T.StructType.fromDDL("company struct<name:string,slug:string,fiscal_year:int,reference_year:int>, source struct<url:string,title:string>, scoring struct<score:double>, file struct<sha256:string,path:string>")
    row = IO.flat_manifest(IO.read_json(spark, f"{tmp_path}/m", schema)).first()
    assert (row.company, row.fiscal_year, row.sha256, row.score) == ("Acme", "2023", "s", None)
    found = IO.discover(spark, f"{tmp_path}/m", "*.json")
    depth = len(str(tmp_path).split("/")) + 1
    assert tuple(found.select(*IO.path_parts(F.regexp_replace("path", "^file:", ""), depth, ["slug", "year"])).first()) == ("acme", "2023")
    assert one(spark, IO.year_in_path(F.col("t")), t="data/acme-2024/x") == "2024"


def test_keyword_map_keeps_the_last(spark):
    entries = spark.createDataFrame([(0, "m1", ["A ", "b"]), (1, "m2", ["b", "c"])], "o int, id string, words array<string>")
    assert {r.keyword: r.id for r in IO.keyword_map(entries, "words", "id", "o").collect()} == {"a": "m1", "b": "m2", "c": "m2"}


def test_ingest_takes_new_files_once(spark, tmp_path):
    schema = IO.T.StructType.fromDDL("id long, ts timestamp, kind string")
    source, target, mark = (f"{tmp_path}/{x}" for x in ("in", "out", "mark"))
    put = lambda lo, hi: spark.range(lo, hi).selectExpr("id", "timestamp_seconds(id * 60) AS ts", "'k' AS kind").write.mode("append").parquet(source)
    for lo, hi in ((0, 10), (10, 25)):
        put(lo, hi)
        ingest.catch_up(ingest.new_files(spark, source, schema), target, mark).awaitTermination()
        assert sorted(r.id for r in spark.read.parquet(target).collect()) == list(range(hi))
    batches = []
    ingest.each_batch(ingest.new_files(spark, source, schema), lambda df, n: batches.append((n, df.count())), f"{mark}2").awaitTermination()
    assert sum(n for _, n in batches) == 25
    counts = ingest.windowed_counts(ingest.new_files(spark, source, schema), "ts", ["kind"], "10 minutes", "1 minute")
    q = counts.writeStream.format("memory").queryName("w").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r.n for r in spark.table("w").collect()} == {10}


def test_families_score_their_own_documents(spark):
    from evidentia.operators.families import FAMILIES

    titles = {"annual": "Acme group universal registration document 2024", "agm": "Acme AGM voting results 2024", "assurance": "Acme limited assurance report 2024", "cdp": "Acme CDP climate change response 2024", "sbti": "Acme SBTi commitment letter 2024", "earnings": "Acme earnings call transcript 2024", "investor": "Acme investor presentation 2024", "half_year": "Acme rapport semestriel 2024", "climate": "Acme climate report 2024", "sustainability": "Acme sustainability report 2024", "governance": "Acme corporate governance report 2024", "remuneration": "Acme remuneration report 2024", "vigilance": "Acme plan de vigilance 2024", "policy": "Acme code of conduct 2024"}
    for name, family in FAMILIES.items():
        rows = [(n, t, f"https://acme.com/{n}.pdf") for n, t in titles.items()]
        df = spark.createDataFrame(rows, "n string, title string, url string").withColumns({"snippet": F.lit(""), "domain": F.lit("acme.com"), "company": F.lit("Acme"), "official_domain": F.lit("acme.com"), "fiscal_year": F.lit(2024)})
        got = {r.n: r for r in S.score(df, family).collect()}
        assert got[name].decision == "auto_download", (name, got[name])
        assert max(got.values(), key=lambda r: r.score).score == got[name].score
