"""Posting lists, the similarity join and the gram index, against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from evidentia.operators import grams as G, postings as P, similarity as S
from evidentia.plans.queries import QUERIES
from evidentia.plans.registry import table

from .conftest import DATA


def half_up(x, digits=6):
    import math

    return math.floor(x * 10**digits + 0.5) / 10**digits


@pytest.mark.parametrize(("block", "shard_postings", "kind"), [(4, 150, "long"), (64, 10**6, "long"), (3, 10**6, "string")])
def test_postings_equal_scoring_all(spark, block, shard_postings, kind):
    r = random.Random(block)
    docs = {i: {f"t{min(int(r.expovariate(0.15)), 60)}": round(r.random(), 3) for _ in range(r.randrange(1, 12))} for i in range(300)}
    docs |= {1_000 + i: dict(docs[7]) for i in range(40)}  # ties
    queries = {f"q{i}": {f"t{r.randrange(62)}": round(r.random(), 3) for _ in range(4)} for i in range(25)} | {"none": {"zz": 1.0}}
    name = (lambda i: f"d{i:05}") if kind == "string" else (lambda i: i)
    weights = spark.createDataFrame([(name(i), t, w) for i, d in docs.items() for t, w in d.items()] + [(None, "t1", 1.0), (name(3), None, 1.0), (name(3), "t5", None)], f"doc {kind}, token string, weight double")
    asked = spark.createDataFrame([(q, t, w) for q, d in queries.items() for t, w in d.items()], "q string, token string, weight double")
    rows, measured = P.postings_topk(weights, asked, "doc", "q", 5, block=block, shard_postings=shard_postings)
    want = set()
    for q, d in queries.items():
        scored = sorted((-half_up(sum(w * doc[t] for t, w in d.items() if t in doc)), name(i)) for i, doc in docs.items() if any(t in doc for t in d))
        want |= {(q, i, -s, n + 1) for n, (s, i) in enumerate(scored[:5])}
    assert {(x.q, x.doc, x.score, x.rank) for x in rows.collect()} == want
    told = measured.collect()
    assert {x.q for x in told} == set(queries) and all(x.postings == weights.dropna().count() for x in told)
    if block == 4:
        assert sum(x.postings_read for x in told) < 0.7 * sum(x.postings for x in told)


def test_lexical_topk_reads_part_of_the_postings(spark):
    """The registered query's weights: what its search reads."""
    from evidentia.operators import retrieval as R

    docs = table(spark, DATA, "documents")
    terms = R.tokens(docs, "doc_id", "text")
    weights = R.tfidf(terms, R.vocabulary(terms, "doc_id", docs.count()), "doc_id")
    queries = weights.filter("doc_id % 20 = 0").select(F.col("doc_id").cast("string").alias("query"), "token", "weight")
    rows, measured = P.postings_topk(weights, queries, "doc_id", "query", 20, block=8)
    assert rows.count() == QUERIES["lexical_topk"](spark, DATA).count()
    read, held = measured.agg(F.sum("postings_read"), F.sum("postings")).first()
    assert 0 < read < held


def plain_components(rows, least):
    label = {i: i for i, *_ in rows}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    norm = lambda v: sum(x * x for x in v) ** 0.5
    real = [(i, v, s) for i, v, s in rows if v and all(x is not None for x in v) and 0 < norm(v) < float("inf")]
    for n, (i, v, s) in enumerate(real):
        for j, w, t in real[:n]:
            if s == t and len(v) == len(w) and sum(a * b for a, b in zip(v, w, strict=True)) >= least * norm(v) * norm(w):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return {i: root(i) for i in label}


@pytest.mark.parametrize(("least", "how"), [(0.95, {"small": 4, "pivots": 6, "block": 9}), (0.9, {"small": 0, "pivots": 3, "block": 1_000}), (0.99, {})])
def test_similarity_join_equals_union_find(spark, least, how):
    r = random.Random(3)
    centres = [[r.gauss(0, 1) for _ in range(4)] for _ in range(12)]
    rows = [(i, [c + r.gauss(0, 0.12) for c in r.choice(centres)], "hot" if i % 3 else f"s{i % 21}") for i in range(260)]
    rows += [(900, None, "hot"), (901, [0.0] * 4, "hot"), (902, [1.0, 2.0], "hot"), (903, [None] * 4, "hot"), (904, rows[1][1], None), (905, rows[1][1], None), (906, [float("inf")] * 4, "hot")]
    df = spark.createDataFrame(rows, "id long, v array<double>, s string").repartition(3)
    report = []
    got = {x.id: x.component for x in S.similar_components(df, "id", "v", ["s"], least, report, **how).collect()}
    assert got == plain_components(rows, least)
    if how.get("pivots") == 6:
        compared, pairs = report[0]
        assert 0 < compared < pairs  # cells cut some pairs off


def test_similarity_join_without_rows(spark):
    assert S.similar_components(spark.createDataFrame([], "id long, v array<double>, s string"), "id", "v", ["s"]).count() == 0


def test_labels_of_every_length_are_found(spark, monkeypatch):
    monkeypatch.setattr(G, "PIECE", 37)
    r = random.Random(4)
    quotes = ["".join(r.choice("abé 漢\n") for _ in range(r.randrange(0, 120))) for _ in range(30)] + ["", None, "x" * 200, "x" * 200]
    labels = [q[i : i + n] for q in quotes[:30] for n in (1, 2, 3, 5, 14, 15, 16, 40) for i in [r.randrange(max(1, len(q)))]]
    labels += ["".join(r.choice("abé 漢\n") for _ in range(n)) for n in (1, 2, 3, 4, 6, 15, 22) for _ in range(12)] + ["", None, "zz", "x" * 15, "x" * 201, "y"]
    q, x = spark.createDataFrame([(t,) for t in quotes], "q string").repartition(3), spark.createDataFrame(list(enumerate(labels)), "i int, l string")
    want = sorted(i for i, t in enumerate(labels) if t is not None and any(t in s for s in quotes if s is not None))
    assert sorted(row.i for row in G.contained_labels(q, x, "q", "l").collect()) == want
    assert G.contained_labels(q.limit(0), x, "q", "l").count() == 0 and G.contained_labels(q, x.limit(0), "q", "l").count() == 0


def test_many_short_labels_do_not_raise(spark):
    labels = spark.range(6_000).select(F.format_string("%04d", "id").alias("l"))
    quotes = spark.createDataFrame([("0001 0002 5999",), ("12345",)], "q string")
    assert {r.l for r in G.contained_labels(quotes, labels, "q", "l").collect()} == {"0001", "0002", "5999", "1234", "2345"}
