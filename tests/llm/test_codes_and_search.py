import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

from evidentia.llm import golay_simhash as G, part_codes as P, wand as W
from evidentia.llm.golay_simhash import near_fingerprints
from evidentia.llm.part_codes import vector_codes
from evidentia.llm.scratch import Scratch
from evidentia.llm.wand import ranked_search

from ..conftest import DATA
from .fixtures import SCHEMA, documents, frame, key, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def plain_ranking(docs, items, k=10):
    """(item row, rank, doc_id, score) by scoring every document."""
    held = [(i, Counter(TERM.findall((t or "").translate(SMALL)))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for row, text in enumerate(items):
        scores = []
        for i, c in held:
            if c:
                m = 100 - 75 + (75 * c.total() * n_docs) // n_terms
                s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in TERM.findall((text or "").translate(SMALL)) if t in c)
                if s > 0:
                    scores.append((-s, i is None, i or 0))
        out += [(row, r + 1, None if unknown else i, -s) for r, (s, unknown, i) in enumerate(sorted(scores)[:k])]
    return out


ITEMS = [(1, prose(1, 12)), (2, "Lorem IPSUM ipsum dolor12"), (3, None), (4, ""), (None, "again short text É 漢字"), (2, prose(3, 40)), (7, "zzz"), (8, "secret password token api short WORD")]


@pytest.mark.parametrize("shard", [1, 3, 8_192])
def test_search_equals_scoring_all(spark, monkeypatch, shard):
    monkeypatch.setattr(W, "SHARD_DOCS", shard)
    monkeypatch.setattr(W, "BLOCK_ITEMS", 3)
    rows = documents() + [(i, prose(i % 40, 30), "en", "s", 1, 1, "", 0.1, "", 1, 1, 0.1, 1) for i in range(100, 260)]
    items = spark.createDataFrame([(i, t, i) for i, t in ITEMS], "item_id long, text string, doc_id long").coalesce(1)
    got = ranked_search(spark, frame(spark, rows), items).collect()
    want = plain_ranking([(r[0], r[1]) for r in rows], [t for _, t in ITEMS])
    assert key((r.item_id, r.rank, r.doc_id, r.score) for r in got) == key((ITEMS[i][0], *rest) for i, *rest in want)


def test_shards_are_read_one_by_one(spark, monkeypatch):
    """A row group for each shard, so that neither writer nor scan holds more than one; many repeats of a term are kept."""
    monkeypatch.setattr(W, "SHARD_DOCS", 7)
    rows = spark.createDataFrame([(i, "many " * (70_000 if i == 3 else 2) + f"w{i}") for i in range(60)], "doc_id long, text string").coalesce(1)
    scratch = Scratch(spark, "shards")
    index = W.build_index(spark, rows, scratch)
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in index.inputFiles()]
    assert [m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)] == [1] * 9 == [1] * index.count()
    widths = [len(r.times) // (len(r.places) // 2) for r in index.collect()]
    assert sorted(widths) == [2] * 8 + [8]
    held = {d: n for r in index.collect() for d, n in zip(r.doc_ids, W._postings(r.places, r.times)[1][: len(r.doc_ids)].tolist(), strict=True)}
    assert held == {i: 70_000 if i == 3 else 2 for i in range(60)}


def test_search_skips_documents():
    """The same ten best, with fewer documents scored than hold a term."""
    r = random.Random(4)
    lists = []
    for n in (50, 400, 3_000, 6_000):
        places = sorted(r.sample(range(8_000), n))
        impacts = [r.randrange(1, 400_000 // n) for _ in places]
        lists.append((W.array("H", places), W.array("q", impacts), max(impacts), 1))
    heap, names = [], [(1, -i) for i in range(8_000)]
    scored = W.wand(lists, heap, 10, 1, names)
    total = Counter()
    for places, impacts, _, _ in lists:
        for p, x in zip(places, impacts, strict=True):
            total[p] += x
    assert sorted(heap, reverse=True) == sorted(((s, names[p]) for p, s in total.items()), reverse=True)[:10]
    assert scored < len(total) / 4


def test_search_of_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ranked_search(spark, spark.createDataFrame([], SCHEMA), items).count() == 0
    assert ranked_search(spark, frame(spark), items.limit(0)).count() == 0
    assert ranked_search(spark, frame(spark).withColumn("text", F.lit("  ")), items).count() == 0


def test_terms_of_long_texts(monkeypatch):
    monkeypatch.setattr(W, "PIECE", 7)
    text = "Éa aB--c1 ſtraße ünï " * 9 + "x" * 40
    assert W.terms_of(text.encode()) == Counter(t.encode() for t in TERM.findall(text.translate(SMALL)))


def plain_codes(rows, parts=16, entries=64, rounds=2):
    """(vec_id, code, error, label_error, digest) by plain loops over whole vectors."""
    kept = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in rows if v is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    sizes = Counter(len(v) for *_, v in kept)
    size = min(sizes, key=lambda n: (-sizes[n], n))
    kept = [k for k in kept if len(k[2]) == size]
    cuts = np.array_split(np.arange(size), parts)
    first = sorted(kept, key=lambda k: (k[0] is None, k[0] or 0, k[2]))[:entries]
    books = [[[v[j] for j in cut] for *_, v in first] for cut in cuts]

    def near(at, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), i) for i, e in enumerate(books[at]))

    for _ in range(rounds):
        new = []
        for at, cut in enumerate(cuts):
            met = {}
            for *_, v in kept:
                part = [v[j] for j in cut]
                met.setdefault(near(at, part)[1], []).append(part)
            new.append([[sum(c) // len(met[i]) for c in zip(*met[i], strict=True)] if i in met else e for i, e in enumerate(books[at])])
        books = new
    out = []
    for i, lab, v in kept:
        best = [near(at, [v[j] for j in cut]) for at, cut in enumerate(cuts)]
        out.append((i, lab, "".join(f"{e:02x}" for _, e in best), sum(f for f, _ in best)))
    by_label = Counter()
    for _, lab, _, e in out:
        by_label[lab] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, code, e, by_label[lab], digest) for i, lab, code, e in out]


def vectors(spark, rows):
    return spark.createDataFrame([(i, lab, v, "x", 1) for i, lab, v in rows], "vec_id long, label int, embedding array<float>, code string, error int").repartition(3)


@pytest.mark.parametrize(("size", "n"), [(32, 150), (19, 90), (16, 20), (5, 40)])
def test_codes_equal_plain_loops(spark, size, n):
    r = np.random.default_rng(size)
    rows = [(i, None if i % 7 == 0 else i % 3, r.normal(0, 0.2, size).astype(np.float32).tolist()) for i in range(n)]
    rows += [(i + 500, 1, rows[3][2]) for i in range(40)]  # a vector of which there are many
    rows += [(3, 1, rows[5][2]), (None, 2, rows[6][2]), (3, 1, rows[5][2]), (900, 1, [0.0] * size), (901, 1, None), (902, 1, []), (903, 1, [None] * size), (904, 1, [float("nan")] * size), (905, 1, [float("inf")] * size), (906, 1, [0.5] * (size + 1))]
    got = vector_codes(spark, vectors(spark, rows)).collect()
    assert key(got) == key(plain_codes(rows))


def test_codes_of_no_rows_and_huge_components(spark):
    assert vector_codes(spark, vectors(spark, [])).count() == 0
    assert vector_codes(spark, vectors(spark, [(1, 1, None)])).count() == 0
    got = vector_codes(spark, vectors(spark, [(1, 1, [3e38] * 16), (2, 1, [-3e38] * 16)]), entries=1, rounds=0).orderBy("vec_id").collect()
    assert [r.error for r in got] == [0, 16 * 4 * P.MOST**2]


def test_rounds_run_over_distinct_parts(spark):
    same = [(i, 1, [0.25] * 16) for i in range(300)]
    run = P.PartCodes(spark, vectors(spark, same))
    assert run.distinct.count() == 16 and {r.n for r in run.distinct.collect()} == {300}


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(SMALL))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps):
    """The smallest place reachable over links, for each place."""
    label = list(range(len(fps)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(len(fps))]


def test_fingerprints_equal_a_plain_loop(monkeypatch):
    texts = [r[1] for r in documents()] + ["A b", "One", " x\x0by\x0cz\tÀ ", "\x1c\x1d", "a b c"]
    want = [plain_fingerprint(t) for t in texts]
    assert [G.fingerprint((t or "").encode()) for t in texts] == want
    monkeypatch.setattr(G, "PIECE", 50)
    assert [G.fingerprint((t or "").encode()) for t in texts] == want


def test_hash_is_that_of_the_sql_function(spark):
    assert spark.sql("SELECT xxhash64('one two three') AS h").first().h & (2**64 - 1) == xxhash.xxh64_intdigest(b"one two three", 42)


def test_golay_code_is_perfect():
    words = np.random.default_rng(1).integers(0, 1 << 23, 2_000)
    index = G.codeword_index(words)
    code = index << G.CHECKS
    code |= np.array([G._remainder(int(c)) for c in code])
    assert max(int(x).bit_count() for x in code ^ words) == 3
    for bit in range(23):  # neighbours at one bit share a key
        other = words ^ (1 << bit)
        near = G.codeword_index(words[:, None] ^ (1 << np.arange(23)))
        assert ((near == G.codeword_index(other)[:, None]).any(axis=1)).all()


@pytest.mark.parametrize("crowd", [0, 2, 8])
def test_links_equal_all_pairs(spark, crowd):
    r = random.Random(7)
    fps = {r.getrandbits(64) for _ in range(40)}
    for f in list(fps):
        for _ in range(r.randrange(12)):
            f ^= 1 << r.randrange(64)
            if r.random() < 0.6:
                f ^= 1 << r.randrange(64)
            fps.add(f)
    fps |= {0, 1 << 63 | 1, 1 << 22 | 1 << 43}
    fps = sorted(fps)
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    got = [(a & (2**64 - 1), b & (2**64 - 1)) for a, b in G.links(Scratch(spark, "t"), df, crowd).collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in got)
    place = {f: i for i, f in enumerate(fps)}
    label = list(range(len(fps)))
    for _ in fps:  # labels walk along the links
        for a, b in got:
            i, j = place[a], place[b]
            label[i] = label[j] = min(label[i], label[j])
    assert label == plain_components(fps)


def test_near_fingerprints_of_odd_rows(spark):
    rows = sorted(documents(), key=lambda r: (r[0] is None, r[0] or 0))
    fps = [plain_fingerprint(r[1]) for r in rows]
    want = [(r[0], f"{f:016x}", rows[c][0]) for r, f, c in zip(rows, fps, plain_components(fps), strict=True)]
    for crowd in (0, 8):
        got = near_fingerprints(spark, frame(spark), crowd).collect()
        assert key(got) == key(want)
    assert near_fingerprints(spark, spark.createDataFrame([], SCHEMA)).count() == 0


def test_near_fingerprints_of_the_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    fps = [plain_fingerprint(t) for _, t in rows]
    want = [(i, f"{f:016x}", rows[c][0]) for (i, _), f, c in zip(rows, fps, plain_components(fps), strict=True)]
    assert key(near_fingerprints(spark, docs).collect()) == key(want)
