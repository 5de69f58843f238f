import math
import re
from collections import Counter

import pytest

from evidentia.functions.numbers import NUMBER_UNIT, UNITS
from evidentia.operators.retrieval import NOISE, SECTION_BOOST
from evidentia.plans.evidence import TYPES
from evidentia.plans.queries import ORACLE_SQL, QUERIES
from evidentia.plans.structure import document_catalog

from .conftest import DATA
from .parity import differences, oracle


@pytest.fixture(scope="module")
def con():
    return oracle(DATA)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(spark, con, name):
    assert differences(QUERIES[name](spark, DATA), con, ORACLE_SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, name):
    out = QUERIES[name](spark, DATA)
    assert out.columns and out.count() > 0


def turns_at(spark, folder, *texts):
    rows = [(1, i, "user", t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    spark.createDataFrame([(7, "all rights reserved, 2,500 EUR")], "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def plain_candidates(text):
    """(information_type, raw_value, raw_unit) of an eligible text, number by number."""
    out = []
    for m in re.finditer(NUMBER_UNIT, text, re.ASCII):
        unit = m[2] if m[2] and m[2].lower() in UNITS else None
        n = float(m[1].replace(",", ""))
        if unit or (n > 10 and not 1000 <= n <= 2099):
            out.append(("metric", m[1], unit))
            break
    return out + [(name, None, None) for name, words in TYPES.items() if any(w in text.lower() for w in words)]


def test_typed_candidate_rows_by_a_plain_loop(spark, tmp_path):
    made = turns_at(spark, tmp_path, "in 2024 emissions were 1,200 tCO2e, call us", "7 of our sites and 2030 goals stand", "only 3 % of all sites are left", "12 MWh", "no number here at all, idiot")
    metrics = 0
    for d in (made, DATA):
        turns = [("turn", t.conv_id, t.turn, t.text) for t in spark.read.parquet(f"{d}/conversations.parquet").collect()]
        docs = [("document", r.doc_id, None, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
        want = [(*key, *c) for *key, text in turns + docs if text and len(text) >= 20 and text.strip(" ") for c in plain_candidates(text)]
        got = [(r.kind, r.ident, r.turn, r.information_type, r.raw_value, r.raw_unit) for r in QUERIES["typed_candidate_rows"](spark, d).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
        metrics += sum(x[3] == "metric" for x in got)
    assert metrics >= 2


def test_section_types_see_markers_beyond_forty_characters(spark, tmp_path):
    d = turns_at(spark, tmp_path, "x" * 60 + " the", "x" * 60 + " und", "x" * 60)
    got = QUERIES["section_types_of_whole_texts"](spark, d).orderBy("turn").collect()
    assert [(r.section_type, r.confidence) for r in got] == [("english", 0.75), ("german", 0.75), ("unknown", 0.25)]


def test_document_retrieval_by_a_plain_loop(spark):
    split = lambda t: [w for w in re.split("[^a-z0-9]+", t.lower()) if len(w) >= 2]
    docs = [r for r in spark.read.parquet(f"{DATA}/documents.parquet").collect() if r.text and r.text.strip(" ")]
    counts = {r.doc_id: Counter(split(r.text)) for r in docs}
    df = Counter(w for c in counts.values() for w in c)
    n = len(docs)
    low, high = max(1, n // 1000), max(2, n // 2)
    order = sorted((t for t in df if df[t] >= low), key=lambda t: (0, df[t], -df[t], t) if df[t] <= high else (1, 0, -df[t], t))
    idf = {t: math.log((n + 1) / (df[t] + 1)) + 1 for t in order[:512]}

    def encode(c):
        w = {t: k / sum(c.values()) * idf[t] for t, k in c.items() if t in idf}
        norm = math.sqrt(sum(x * x for x in w.values())) or 1.0
        return {t: x / norm for t, x in w.items()}

    vectors = {i: encode(c) for i, c in counts.items()}
    got, semantic_parts = QUERIES["document_retrieval"](spark, DATA).collect(), 0
    for v in document_catalog(spark, DATA).collect():
        asked, want = encode(Counter(split(" ".join(v.terms[:8])))), {}
        for r in docs:
            text = r.text.lower()
            semantic = min(1.0, sum(x * vectors[r.doc_id].get(t, 0.0) for t, x in asked.items()))
            keyword = min(1.0, sum(min(0.15, 0.05 + len(t) * 0.005) for t in v.terms if t in text))
            unit = min(1.0, 0.35 * sum(u in text for u in v.units))
            section = (SECTION_BOOST[v.domain] * 0.5 if r.source else 0.0) + (0.10 if r.lang in v.preferred else 0.0)
            penalty = min(0.5, sum(0.2 for p in NOISE if re.search(p, r.text, re.ASCII)))
            score = semantic * 0.60 + keyword * 0.25 + unit * 0.10 + section * 0.05 - penalty
            if score >= 0.25 or keyword > 0:
                want[str(r.doc_id)] = score
                semantic_parts += semantic > 0
        mine = sorted((g for g in got if g.variable_name == v.variable_name), key=lambda g: g.rank)
        best = sorted(want.values(), reverse=True)[:20]
        assert [g.rank for g in mine] == list(range(1, len(best) + 1))
        assert all(g.score == pytest.approx(want[g.document_id], abs=6e-5) and g.score == pytest.approx(b, abs=6e-5) for g, b in zip(mine, best, strict=True))
    assert semantic_parts > 0


def test_section_score(spark):
    from pyspark.sql import functions as F

    from evidentia.operators.retrieval import section_score

    rows = [("table", "s1", "climate", "urd", ["urd"], 0.255), ("text", "", "climate", "urd", ["x"], 0.0), ("text", "s", None, None, ["x"], 0.0), ("text", None, "social", "x", ["x"], 0.1)]
    df = spark.createDataFrame(rows, "kind string, section string, domain string, doc string, preferred array<string>, want double")
    for r in df.withColumn("got", section_score(*(F.col(c) for c in ("kind", "section", "domain", "doc", "preferred")))).collect():
        assert r.got == pytest.approx(r.want)


def test_cells_are_shuffled_once(spark):
    """Lines are dealt out by order, and neither cells nor rows of a table are dealt out again."""
    plan = QUERIES["table_matrix_rebuild"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Union" not in plan
