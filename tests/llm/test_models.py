import math
import zlib

import numpy as np
import pytest

from evidentia.llm import mixing as M, quality_knn as Q
from evidentia.llm.quality_knn import good_rows, quality_scores

from .fixtures import SCHEMA, documents, frame, labels, prose

DATA = "/root/testdata/sf0.01"


def test_quality_on_held_out_labels(spark):
    docs, known = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_scores(spark, docs, known).join(known, "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95


def test_quality_of_odd_rows(spark):
    got = quality_scores(spark, frame(spark), labels(spark)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((d is None, d or 0) for d, *_ in documents())
    assert all(r.score is not None for r in got)
    out = good_rows(spark, frame(spark), labels(spark))
    assert out.columns == frame(spark).columns and out.count() == sum(r.predicted for r in got)


def test_quality_without_labels_or_rows(spark):
    assert {r.score for r in quality_scores(spark, frame(spark), labels(spark, empty=True)).collect()} == {0.5}
    assert quality_scores(spark, spark.createDataFrame([], SCHEMA), labels(spark)).count() == 0


def test_labels_other_than_0_and_1_are_ignored(spark):
    docs, known = frame(spark), labels(spark)
    odd = known.selectExpr("doc_id", "2 AS quality", "0 AS toxic").unionByName(known.selectExpr("doc_id", "-1 AS quality", "0 AS toxic"))
    pair = lambda k: sorted((r.doc_id or -1, round(r.score, 6)) for r in quality_scores(spark, docs, k).collect())
    assert pair(known.select("doc_id", "quality", "toxic").unionByName(odd)) == pair(known)
    assert {r.score for r in quality_scores(spark, docs, odd).collect()} == {0.5}


def test_fit_spans_the_space_of_a_dense_decomposition():
    """The leading right singular vectors, by a decomposition of the whole matrix."""
    raw = Q.raw_features([prose(i, 40 + i) for i in range(40)])
    model = Q.fit(raw, np.zeros(40, np.float32))
    seen = (raw > 0).sum(axis=0)
    idf = np.log(41 / (1 + seen)) + 1
    idf[Q.PAIRS :] = 1
    dense = raw * idf
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    values, vectors = np.linalg.svd(dense, full_matrices=False)[1:]
    top = vectors[: len(model["top"])]
    found = np.linalg.norm(dense @ model["top"].T, axis=0)
    assert found == pytest.approx(values[: len(top)], rel=2e-2, abs=1e-3)


def plain_vote(model, vectors, labels, latent):
    """Every labelled vector against one document, by plain Python."""
    near = sorted(((-float(np.dot(latent, v)), i) for i, v in enumerate(vectors)))[: Q.NEIGHBOURS]
    weights = [max(-c, 0.0) ** Q.POWER for c, _ in near]
    if sum(weights) <= 0:
        return float(np.mean(labels))
    return sum(w * labels[i] for w, (_, i) in zip(weights, near, strict=True)) / sum(weights)


def test_vote_equals_a_plain_loop_over_all_labelled_vectors():
    texts = [prose(i, 30 + i) for i in range(60)] + ["WORD!! " * 20, "again again " * 9, "", "x"]
    labels = np.array([i % 3 == 0 for i in range(60)], np.float32)
    # the second half repeats the first, so that cosines tie in pairs at every rank
    raw = Q.raw_features(texts[:30] * 2)
    model = Q.fit(raw, labels)
    got = Q.score(model, texts)
    for text, s in zip(texts, got, strict=True):
        latent = Q.unit(Q.unit(Q.raw_features([text]) * model["idf"]) @ model["top"].T)[0]
        assert s == pytest.approx(plain_vote(model, model["vectors"], model["labels"], latent), abs=2e-3)


def test_ties_go_to_the_first_vectors():
    cosine = np.array([[0.5, 0.9, 0.5, 0.5, 0.1, 0.5], [0.2, 0.2, 0.2, 0.2, 0.2, 0.2], [0.6, 0.1, 0.5, 0.4, 0.3, 0.2]], np.float32)
    assert [sorted(r) for r in Q.nearest_of(cosine, 3).tolist()] == [[0, 1, 2], [0, 1, 2], [0, 2, 3]]


def test_a_repeated_doc_id_is_learnt_by_a_rule(spark):
    rows = [(1, "bbb"), (1, "aaa"), (2, "ccc"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    known = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    got = {r.doc_id: (r.text, r.quality) for r in Q.labelled_sample(docs, known, {"quality": "int"}, 9).collect()}
    assert got == {d: v for d, v in {1: ("aaa", 1), 2: ("", 0)}.items() if zlib.crc32(str(d).encode()) % 5}


def table_of(spark, n, p):
    return spark.createDataFrame([(i, int(k), [float(x) for x in q]) for i, (k, q) in enumerate(zip(n, p, strict=True))], "doc_id long, n_tokens long, p array<double>")


def least_distance(p, n, targets):
    """The distance from the targets by a loop of plain projected gradient over all rates, with small steps and momentum."""
    a = p * np.sqrt(n / n.sum())[:, None]
    size = 1 / np.linalg.norm(a.T @ a, 2)
    rate = ahead = np.sqrt(n / n.sum())  # of rate 1, in the metric in which each token counts alike
    best, k = np.inf, 0
    for _ in range(40_000):
        off = a.T @ ahead - targets
        new = np.maximum(0, ahead - size * (a @ off))
        k = 0 if (ahead - new) @ (new - rate) > 0 else k + 1
        rate, ahead = new, new + k / (k + 3) * (new - rate)
        best = min(best, np.linalg.norm(a.T @ rate - targets))
    return best


def fitted(spark, n, p, targets):
    """(rates, told distance) of the fit."""
    steps, off = M.fit_rates(table_of(spark, n, p), targets)
    return np.array([r.rate for r in M.stepped(table_of(spark, n, p), steps).orderBy("doc_id").collect()]), off


def test_rates_are_as_near_as_those_of_a_plain_loop(spark):
    """Targets in reach, with rates at 0 and without, and out of reach: the distance of a slow loop of its own."""
    rng = np.random.default_rng(2)
    cases = [(rng.dirichlet([0.4, 0.4, 0.4], 200), [0.6, 0.3, 0.1]), (rng.dirichlet([3, 1, 1], 200), [0.1, 0.1, 0.8]), (rng.dirichlet([8, 1, 1], 150), [0.02, 0.08, 0.9]), (rng.dirichlet([20, 20, 1], 60), [0.05, 0.05, 0.9]), (rng.dirichlet([5, 5, 5], 40), [0.98, 0.01, 0.01])]
    reached = []
    for p, targets in cases:
        n = rng.integers(1, 100, len(p))
        rate, off = fitted(spark, n, p, targets)
        got = (p * (n * rate)[:, None]).sum(axis=0) / n.sum() - targets
        assert (rate >= 0).all() and np.abs(got).max() == pytest.approx(off, abs=1e-9)
        assert np.linalg.norm(got) <= least_distance(p, n, np.array(targets)) + 3e-6
        reached.append(off <= 1e-6)
    assert True in reached and False in reached


def test_rates_stay_near_one_where_they_may():
    """Without rates at 0 the first step is the least change that meets the targets."""
    rng = np.random.default_rng(4)
    p = rng.dirichlet([5, 5, 5], 100)
    a = p / 100
    goal = np.array([0.35, 0.33, 0.32])
    steps, off, settled = M.solve(lambda s, ends: np.array([M.rates_after(p, [*s, e]) @ a for e in ends]), lambda s, y: (p.T @ a, float((p @ y).min())), goal, 5, 1e-9)
    assert settled and len(steps) <= 2 and np.abs(off).max() <= 1e-9
    rate = 1 - sum(p @ x for x, _ in steps)
    least = 1 - a @ np.linalg.solve(a.T @ a, a.sum(axis=0) - goal)
    assert np.allclose(rate, least, atol=1e-6)


def test_an_unsettled_fit_is_told(spark):
    rng = np.random.default_rng(6)
    p, n = rng.dirichlet([8, 1, 1], 100), rng.integers(1, 100, 100)
    with pytest.warns(UserWarning, match="settled"):
        M.fit_rates(table_of(spark, n, p), [0.02, 0.08, 0.9], iterations=1)


def test_posteriors_equal_a_plain_softmax():
    texts, words = ["Good words here, yes", "!!! bad bad", "", "x" * 50], {"bad": 0, "good": 1, "yes": 2}
    x = M.features(texts, words)
    weights = np.random.default_rng(3).standard_normal((x.shape[1], 4))
    got = M.posteriors({"words": words, "weights": weights}, texts)
    for row, q in zip(x, got, strict=True):
        e = [math.exp(sum(float(a) * float(b) for a, b in zip(row, w, strict=True))) for w in weights.T]
        assert q.tolist() == pytest.approx([v / sum(e) for v in e])
    assert x[1, -3:].tolist() == [1, 0, 0] and x[0, -3:].tolist() == [0, 1, 1]


def test_softmax_fits_separable_domains():
    rng = np.random.default_rng(5)
    y = rng.integers(0, 3, 300)
    x = np.c_[np.ones(300), np.eye(3)[y] + rng.normal(0, 0.1, (300, 3))]
    p = M.softmax(x @ M.fit_softmax(x, y, 3))
    assert (p.argmax(axis=1) == y).mean() > 0.99 and p[np.arange(300), y].mean() > 0.9


def test_mixing_of_odd_rows(spark):
    docs = frame(spark)
    got = M.mix(spark, docs, labels(spark)).collect()
    assert len(got) == len(documents()) and all(r.rate >= 0 and r.copies in (int(r.rate), int(r.rate) + 1) for r in got)
    assert all(sum(r[f"p_quality{q}_toxic{t}"] for q, t in M.DOMAINS) == pytest.approx(1) for r in got)
    # the distance that is told is the one that the rates have
    tokens = np.array([r.n_tokens for r in got], float)
    share = [sum(r.rate * r.n_tokens * r[f"p_quality{q}_toxic{t}"] for r in got) / tokens.sum() for q, t in M.DOMAINS]
    assert np.abs(np.array(share) - M.TARGETS).max() == pytest.approx(got[0].off_target, abs=1e-6)
    out = M.mixed_rows(spark, docs, labels(spark))
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in got)


def test_mixing_without_labels_or_rows(spark):
    assert M.mix(spark, frame(spark), labels(spark, empty=True)).count() == len(documents())
    assert M.mix(spark, spark.createDataFrame([], SCHEMA), labels(spark)).count() == 0


def test_rates_meet_targets_of_a_rare_domain(spark):
    rng = np.random.default_rng(3)
    p = rng.dirichlet([0.3, 0.1, 0.05, 0.05], 2000)
    n = rng.integers(1, 100, 2000)
    found = spark.createDataFrame([(i, int(k), [float(x) for x in q]) for i, (k, q) in enumerate(zip(n, p, strict=True))], "doc_id long, n_tokens long, p array<double>")
    steps, off = M.fit_rates(found, M.TARGETS)
    rate = np.array([r.rate for r in M.stepped(found, steps).orderBy("doc_id").collect()])
    got = (p * (n * rate)[:, None]).sum(axis=0) / n.sum()
    assert off <= 1e-6 and (rate >= 0).all() and rate.max() > 4
    assert np.abs(got - M.TARGETS).max() == pytest.approx(off, abs=1e-9)


def test_targets_out_of_reach_are_met_as_nearly_as_can_be(spark):
    # every row has equal posteriors: the totals are equal, and the nearest ones are a quarter each
    found = spark.createDataFrame([(i, 10, [0.25] * 4) for i in range(50)], "doc_id long, n_tokens long, p array<double>")
    steps, off = M.fit_rates(found, M.TARGETS)
    assert off == pytest.approx(0.66) and {round(r.rate, 6) for r in M.stepped(found, steps).collect()} == {1.0}


def test_sums_read_blocks_rather_than_rows(spark):
    """A block holds a batch's numbers as they are, and the sums over blocks are those of a plain loop over rows and steps."""
    rng = np.random.default_rng(8)
    p, n = rng.dirichlet([1, 1, 1], 2500), rng.integers(1, 100, 2500)
    held = M.blocks(M.Scratch(spark, "test"), table_of(spark, n, p).repartition(1).sortWithinPartitions("doc_id"), 2500)
    got = held.collect()
    assert len(got) == 3
    assert np.concatenate([np.frombuffer(r.n) for r in got]).tolist() == n.tolist() and (np.concatenate([np.frombuffer(r.p) for r in got]).reshape(-1, 3) == p).all()
    steps, ends = [[(rng.normal(0, 1, 3), rng.normal(0, 1, 3)) for _ in range(k)] for k in (6, 4)]

    def plain(row, moves):
        rate = 1.0
        for s, y in moves:
            rate = 0.0 if rate <= 0 and sum(row * y) > 0 else max(rate - sum(row * s), 0.0)
        return rate

    want = [sum(k * plain(row, [*steps, end]) * row for k, row in zip(n, p, strict=True)) for end in ends]
    assert np.allclose(M.totals_of(n.astype(float), p, steps, ends), want)
    assert np.allclose(M._summed(held, 3, lambda n, p: (M.totals_of(n, p, steps, ends), 0.0))[0].reshape(4, 3), want)
    assert np.allclose(M.rates_after(p, steps), [plain(row, steps) for row in p])


def test_words_of_split_text_are_those_of_the_lowered_text():
    for text in ("Some (Words), \"some\" 'WORDS' -- more.", "ΟΔΟΣ ΣΑΣ. İstanbul IJ Straẞe\x1cǅ", "", " ... !! "):
        assert M.words_of(text.split()) == {w.strip(M._MARKS) for w in text.lower().split()} - {""}
    # nothing becomes white space, or stops being it, in lower case
    assert all([c.isspace() for c in chr(i).lower()] == [chr(i).isspace()] * len(chr(i).lower()) for i in range(0x110000))
