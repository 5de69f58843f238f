from collections import Counter

import pytest

import corpus_pipeline
from evidentia.llm.mixing import mix
from evidentia.llm.packing import optimal_bounds
from evidentia.llm.quality_knn import quality_scores
from evidentia.llm.queries import ORACLE_SQL, QUERIES
from evidentia.llm.tokens import PieceEncoder, default_path

from ..conftest import DATA
from ..parity import differences, oracle
from .fixtures import SCHEMA, frame, labels
from .test_dedup import brute_classes, norm


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(spark, name):
    assert differences(QUERIES[name](spark, DATA), oracle(DATA), ORACLE_SQL[name]) == []


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_of_odd_rows(spark, tmp_path):
    labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    docs = frame(spark)
    columns = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        assert i == 4 or docs.columns == columns
    assert "batch" in docs.columns and docs.count() > 0


def stored(spark, folder, docs, known):
    docs.write.parquet(f"{folder}/documents.parquet")
    known.write.parquet(f"{folder}/labels.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"), str(folder)


def pairs(rows):
    return Counter((r.doc_id, r.text) for r in rows)


def test_pipeline_against_brute_force(spark, tmp_path):
    """Each stage on what the one before kept, by plain Python; and run() against the last of them."""
    docs, known, folder = stored(spark, tmp_path, frame(spark), labels(spark))
    kept = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        given = docs if not kept else kept[-1]
        stage(spark, given, folder).write.parquet(f"{tmp_path}/stage{i}")
        kept.append(spark.read.parquet(f"{tmp_path}/stage{i}"))
    rows = [k.collect() for k in kept[:4]]
    # quality: the rows that the scores accept, with repeats
    good = Counter()
    for r in quality_scores(spark, docs.withColumn("doc_id", docs.doc_id), known).filter("predicted = 1").collect():
        good[r.doc_id] += 1
    assert Counter(r.doc_id for r in rows[0]) == good
    # exact: of equal texts the longest, then the smallest doc_id
    groups = {}
    for r in rows[0]:
        groups.setdefault(norm(r.text), []).append((-len(r.text or ""), r.doc_id is None, r.doc_id or 0, r.text))
    assert pairs(rows[1]) == Counter((None if b[1] else b[2], b[3]) for b in (min(g, key=lambda x: x[:3]) for g in groups.values()))
    # near: one of each class of all pairs
    classes = brute_classes([(r.doc_id, r.text) for r in rows[1]])
    assert len(rows[2]) == len(classes) and all(len({r.doc_id for r in rows[2]} & set(c)) >= 1 for c in classes.values())
    assert not pairs(rows[2]) - pairs(rows[1])
    # mixing: as many copies as the fit says
    copies = Counter()
    for r in mix(spark, kept[2], known, tilt=corpus_pipeline.TILT).collect():
        copies[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in rows[3]) == +copies
    # packing: every row once, at its length, with the least padding
    library = PieceEncoder(default_path()).library
    sizes = sorted((r.doc_id is None, r.doc_id or 0, len(library.encode(r.text or "", add_special_tokens=False).ids) + 1) for r in rows[3])
    last = kept[4].collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in last) == sizes
    count = Counter(n for *_, n in sizes)
    import numpy as np

    assert sum(r.padding for r in last) == optimal_bounds(np.array(sorted(count)), np.array([count[n] for n in sorted(count)]), 16)[1]
    whole = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r.doc_id, r.n_tokens, r.padded_to) for r in whole) == Counter((r.doc_id, r.n_tokens, r.padded_to) for r in last)


@pytest.mark.parametrize("case", ["no documents", "no labels", "all rejected"])
def test_pipeline_of_empty_stages(spark, tmp_path, case):
    docs = spark.createDataFrame([], SCHEMA) if case == "no documents" else frame(spark)
    known = labels(spark, empty=case == "no labels")
    if case == "all rejected":
        known = known.withColumn("quality", known.quality * 0)
    *_, folder = stored(spark, tmp_path, docs, known)
    n = corpus_pipeline.run(spark, folder).count()
    assert n > 0 if case == "no labels" else n == 0


def test_pipeline_keeps_clean_documents(spark):
    """On the registered tables the mixing stage drops toxic text alone, and repeats nothing often."""
    folder = DATA.replace("sf0.001", "sf0.01")
    docs, known = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    given = corpus_pipeline.quality(spark, docs, folder)
    fit = {r.doc_id: r for r in mix(spark, given, known, tilt=corpus_pipeline.TILT).collect()}
    out = Counter(r.doc_id for r in corpus_pipeline.mixing(spark, given, folder).collect())
    clean = [i for i, r in fit.items() if r.p_quality1_toxic0 > 0.9]
    assert len(clean) > 100 and all(out[i] >= 1 for i in clean) and max(out.values()) <= 3
    toxic = [i for i, r in fit.items() if r.p_quality1_toxic1 > 0.9]
    assert 0 < sum(out[i] for i in toxic) < len(toxic) and {r.off_target < 1e-5 for r in fit.values()} == {True}
    shares = [sum(r.n_tokens * r.rate * r[f"p_quality{q}_toxic{t}"] for r in fit.values()) for q, t in ((1, 0), (1, 1))]
    before = [sum(r.n_tokens * r[f"p_quality{q}_toxic{t}"] for r in fit.values()) for q, t in ((1, 0), (1, 1))]
    assert shares[1] / shares[0] == pytest.approx(0.5 * before[1] / before[0], rel=1e-3)
