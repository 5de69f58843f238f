import hashlib
import io

import numpy as np
import pytest

from evidentia.llm.vptree import Tree, nearest
from evidentia.llm.warc_zstd import ArchiveWriter, BadArchive, parse, read_archive, record, warc_round_trip

PAGES = "page_id long, url string, html string, digest string, payload string, path string"


def pages():
    big = "<p>" + "x" * 200 + "é</p>"
    rows = [(5, "http://a/ b", big), (3, "http://a", big), (9, None, big), (3, "http://a", big), (1, "u", "short"), (2, "u", "short"), (4, "u", None), (6, "u", ""), (None, "u", big), (None, "u", None), (7, "u", "y" * 3_000_000), (8, "u", "a" * 100), (10, "u", "a" * 100), (11, "u", "a" * 99), (12, "u", "a" * 99)]
    return [(*r, "d", "p", "x") for r in rows]


def test_round_trip_of_odd_pages(spark):
    got = warc_round_trip(spark, spark.createDataFrame(pages(), PAGES).repartition(3)).collect()
    want = []
    for i, _, html, *_ in pages():
        raw = (html or "").encode()
        first = min((p for p, _, h, *_ in pages() if p is not None and (h or "") == (html or "")), default=None)
        revisit = len(raw) >= 100 and i is not None and i > first
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert warc_round_trip(spark, spark.createDataFrame([], PAGES)).count() == 0


def archive(records):
    out = io.BytesIO()
    out.close = lambda: None
    w = ArchiveWriter(out)
    for r in records:
        w.add(r)
    w.close()
    return out.getvalue()


def one(i, body):
    return record(i, "http://x", body, hashlib.sha256(body).hexdigest(), None)


def test_archive_is_read_frame_by_frame():
    bodies = [bytes([i]) * (i * 37) for i in range(100)] + [b"z" * 5_000_000]
    got = list(read_archive(io.BytesIO(archive(one(i, b) for i, b in enumerate(bodies))), chunk=100))
    assert [r["payload"] for r in got] == bodies and [r["page_id"] for r in got] == list(range(101))


def test_damage_is_found():
    raw = archive([one(1, b"payload" * 50)])
    for bad in (raw[:-3], b"xxxx" + raw[4:], raw[:20]):
        with pytest.raises(BadArchive):
            list(read_archive(io.BytesIO(bad)))
    good = one(1, b"payload" * 50)
    for old, new in ((b"WARC/1.1", b"WARC/0.9"), (b"payloadpayload", b"payloadpayloae"), (b"WARC-Date: 1", b"WARC-Date: x"), (b"Content-Length: 350", b"Content-Length: 351"), (b"WARC-Type: response", b"WARC-Type: other")):
        assert old in good
        with pytest.raises(BadArchive):
            parse(good.replace(old, new, 1))
    with pytest.raises(BadArchive):
        parse(good + b"x")


def brute(rows, k):
    ok = [(i, v) for i, v in rows if i is not None and v is not None and len(v) == 4 and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in ok:
        if q % 20 == 0:
            out[q] = sorted(((-float(np.dot(v, w)), i) for i, w in ok if i != q))[:k]
    return out


def test_factor_one_is_exact(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.integers(-3, 4, 4).astype(float).tolist()) for i in range(600)]
    rows += [(1000 + i, [1.0, 1.0, 1.0, 1.0]) for i in range(300)]
    rows += [(2000, None), (2001, [0.0] * 4), (2002, [1.0, None, 1.0, 1.0]), (2003, [float("nan")] * 4), (2004, [float("inf"), 1.0, 1.0, 1.0]), (2020, [1.0, 2.0]), (None, [1.0] * 4)]
    df = spark.createDataFrame([(i, v, 0, "s", 1.0) for i, v in rows], "vec_id long, embedding array<double>, shard int, tree string, score double")
    got = {}
    for r in nearest(spark, df, factor=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, -r.score, r.vec_id))
    want = brute(rows, 20)
    assert got.keys() == want.keys()
    for q, found in got.items():
        assert [(s, i) for _, s, i in found] == [(pytest.approx(s), i) for s, i in want[q]] and [r for r, *_ in found] == list(range(1, len(found) + 1))
    assert nearest(spark, df.limit(0)).count() == 0


def test_recall_falls_and_work_shrinks_with_the_factor():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((3000, 4)) @ np.diag([5, 3, 1, 1])
    tree, ids, q = Tree(np.arange(3000), x, float(np.linalg.norm(x, axis=1).max())), np.arange(0, 3000, 20), x[::20]
    exact, found, work = tree.search(ids, q, 20, 1.0)
    truth = np.sort(np.where(np.arange(3000)[None] == ids[:, None], -np.inf, q @ x.T), axis=1)[:, ::-1][:, :20]
    assert np.allclose(exact, truth) and work < 0.9 * q.shape[0] * 3000
    _, loose, less = tree.search(ids, q, 20, 4.0)
    recall = np.mean([len(set(a) & set(b)) / 20 for a, b in zip(found, loose, strict=True)])
    assert less < work and 0.5 < recall <= 1


def test_recall_at_the_production_factor(spark):
    """Every query of the registered table against brute force in double precision."""
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    ids, x = np.array([i for i, _ in rows]), np.stack([v for _, v in rows])
    got = {}
    for r in nearest(spark, spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    assert sorted(got) == sorted(ids[ids % 20 == 0].tolist())
    hits = 0
    for q, found in got.items():
        scores = x @ x[ids == q][0]
        best = sorted((-s, i) for s, i in zip(scores.tolist(), ids.tolist(), strict=True) if i != q)[:20]
        hits += len({i for _, i in best} & found.keys())
        assert len(found) == 20 and all(s == pytest.approx(float(scores[ids == i][0])) for i, s in found.items())
    assert hits / (20 * len(got)) >= 0.9
