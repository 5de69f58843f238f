import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from evidentia.llm import bagminhash as B
from evidentia.llm.bagminhash import near_dedup, one_of_each_class, signatures
from evidentia.llm.radix_dedup import distinct_rows, exact_dedup
from evidentia.llm.shingles import WordHashes, mix, multiset, overlap

from .fixtures import SCHEMA, documents, frame, prose


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_exact_groups_of_odd_rows(spark):
    got = exact_dedup(spark, frame(spark)).collect()
    rows = [(d, t or "") for d, t, *_ in documents()]
    groups = defaultdict(list)
    for d, t in rows:
        groups[norm(t)].append((d, t))
    assert len(got) == len(rows)
    kept = Counter()
    for r in got:
        g = [m for m in groups.values() if (r.doc_id, r.group_size) in {(d, len(m)) for d, _ in m}]
        best = [min(m, key=lambda x: (-len(x[1]), x[0] is None, x[0] or 0))[0] for m in g]
        assert r.keep_id in best
        kept[r.text_sha256] += r.kept
    assert set(kept.values()) == {1} and len(kept) == len(groups)


def test_long_equal_texts_are_compared_to_the_end(spark):
    long = prose(9, 30_000)
    rows = [(1, long), (2, long), (3, long[:-1] + "#"), (4, "#" + long[1:]), (5, long + " ")]
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (5, 3), 2: (5, 3), 5: (5, 3), 3: (3, 1), 4: (4, 1)}


def test_extreme_doc_ids(spark):
    low, high = -(2**63), 2**63 - 1
    rows = [(low, "a b"), (high, "ab"), (0, "a  b"), (None, "ab"), (low, "x"), (high, "x "), (None, "y"), (None, "y")]
    got = sorted(map(tuple, exact_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "keep_id", "group_size", "kept").collect()), key=repr)
    want = [(low, 0, 4, False), (high, 0, 4, False), (0, 0, 4, True), (None, 0, 4, False), (low, high, 2, False), (high, high, 2, True), (None, None, 2, True), (None, None, 2, False)]
    assert got == sorted(want, key=repr)


def test_components_grow_as_if_all_links_were_there(spark):
    from evidentia.llm.scratch import Scratch

    r, scratch = random.Random(6), Scratch(spark, "grown")
    pairs = [tuple(r.sample(range(60), 2)) for _ in range(45)]
    of = lambda x: spark.createDataFrame(x, "a long, b long")
    labels = B.components(scratch, of(pairs[:15]), "one")
    for i in (15, 30):
        labels = B.grown(scratch, labels, of(pairs[i : i + 15]), f"more_{i}")
    whole = B.components(scratch, of(pairs), "all")
    assert sorted(map(tuple, labels.collect())) == sorted(map(tuple, whole.collect()))


def test_distinct_rows_keep_all_columns(spark):
    docs = frame(spark)
    out = distinct_rows(spark, docs)
    assert out.columns == docs.columns
    assert Counter(norm(r.text) for r in out.collect()) == Counter({norm(t) for _, t, *_ in documents()})


@pytest.mark.parametrize("f", [exact_dedup, near_dedup, distinct_rows, one_of_each_class])
def test_empty_table(spark, f):
    assert f(spark, spark.createDataFrame([], SCHEMA)).count() == 0


def test_signatures_estimate_weighted_jaccard():
    rng, off = np.random.default_rng(1), []
    for trial in range(20):
        a = rng.integers(0, 9, 60)
        b = np.maximum(0, a + rng.integers(-2, 3, 60))
        e = mix(np.arange(60).astype(np.uint64) + np.uint64(1000 * trial))
        owner = np.r_[np.zeros((a > 0).sum(), int), np.ones((b > 0).sum(), int)]
        s = signatures(owner, np.r_[e[a > 0], e[b > 0]], np.r_[a[a > 0], b[b > 0]], 2, 1024)
        off.append((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(off)) < 0.012 and np.std(off) < 0.03


def brute_classes(rows, least=0.8):
    known = WordHashes()
    sets = [multiset(t or "", known) for _, t in rows]
    to = list(range(len(rows)))

    def root(i):
        while to[i] != i:
            i = to[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if overlap(sets[i], sets[j]) >= least - 1e-12:
                to[root(i)] = root(j)
    groups = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        groups[root(i)].append(d)
    return groups


def classes_match(spark, rows, got):
    groups = brute_classes(rows)
    want = sorted(((d, min((x for x in m if x is not None), default=None), len(m)) for m in groups.values() for d in m), key=repr)
    assert sorted(((r.doc_id, r.class_id, r.class_size) for r in got), key=repr) == want
    assert sum(r.kept for r in got) == len(groups)


def test_near_classes_of_odd_rows(spark):
    classes_match(spark, [(d, t) for d, t, *_ in documents()], near_dedup(spark, frame(spark)).collect())


def test_large_buckets_lose_no_link(spark, monkeypatch):
    """Many copies of one base, changed a little or a lot, so that buckets are large and hold several components."""
    monkeypatch.setattr(B, "SMALL_BUCKET", 4)
    r, base, rows = random.Random(3), prose(8, 150).split(), []
    for i in range(120):
        words = list(base)
        for _ in range(r.choice([0, 1, 2, 3, 4, 6, 9])):
            words[r.randrange(len(words))] = f"new{r.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    classes_match(spark, rows, near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect())


def test_one_of_each_class_keeps_columns(spark):
    docs = frame(spark)
    out = one_of_each_class(spark, docs)
    assert out.columns == docs.columns and out.count() == len(brute_classes([(d, t) for d, t, *_ in documents()]))
