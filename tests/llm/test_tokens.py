import io
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from evidentia.llm import tokens, wavelet
from evidentia.llm.packing import optimal_bounds, pack, packed
from evidentia.llm.scratch import Scratch
from evidentia.llm.tokens import PieceEncoder, default_path
from evidentia.llm.wavelet import ShardReader, ShardWriter, WaveletMatrix, wavelet_shards

from .fixtures import SCHEMA, documents, frame, prose

ENCODER = PieceEncoder(default_path())


def whole(text):
    return ENCODER.library.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab Z9.,'\n\t\r\x1c\xa0é漢🙂!<|>endoftx")), max_size=60))
def test_pieces_give_the_librarys_ids(text):
    assert ENCODER.cuts
    assert ENCODER.encode([text])[0].tolist() == whole(text) and ENCODER.count([text]) == [len(whole(text))]


@pytest.mark.parametrize("width", [4, 16, 17])
def test_wavelet_matrix_answers(width):
    ids = np.random.default_rng(width).zipf(1.3, 3000) % (1 << width)
    m = WaveletMatrix.build(ids, width)
    assert (m.decode() == ids).all() and all(m.access(i) == ids[i] for i in range(0, 3000, 41))
    for token in {1, 2, 3, int(ids[5]), (1 << width) - 1, 1 << width}:
        where = np.flatnonzero(ids == token)
        assert m.count(token) == len(where) and m.count(token, 100, 2000) == ((where >= 100) & (where < 2000)).sum()
        assert [m.occurrence(token, k) for k in range(min(len(where), 30))] == where[:30].tolist() and m.occurrence(token, len(where)) == -1


def test_shard_file_round_trip():
    out, docs = io.BytesIO(), [(None, np.array([0], np.uint32)), (5, np.arange(70_000, dtype=np.uint32) % 50_000), (5, np.array([1, 0], np.uint32))]
    close, out.close = out.close, lambda: None
    writer = ShardWriter(out, 16)
    for d, ids in docs:
        writer.add(d, ids)
    writer.close()
    found = [(d, ids) for ds, sizes, m in ShardReader(pa.BufferReader(out.getvalue())) for d, ids in zip(ds, np.split(m.decode(), np.cumsum(sizes)[:-1]), strict=True)]
    assert [d for d, _ in found] == [d for d, _ in docs] and all((a == b).all() for (_, a), (_, b) in zip(found, docs, strict=True))
    close()


def test_lookups_over_a_whole_file(monkeypatch):
    """access, count and occurrence across block borders, and which parts of the file they read."""
    monkeypatch.setattr(wavelet, "BLOCK_TOKENS", 500)
    out, rng = io.BytesIO(), np.random.default_rng(8)
    out.close = lambda: None
    writer, rows = ShardWriter(out, 16), [rng.zipf(1.5, n).astype(np.uint32) % 60_000 for n in rng.integers(1, 300, 40)]
    for d, ids in enumerate(rows):
        writer.add(d, ids)
    writer.close()

    source = pa.BufferReader(out.getvalue())
    reader, ids = ShardReader(source), np.concatenate(rows)
    assert len(reader.blocks) > 5 and reader.n == len(ids)
    assert [reader.access(i) for i in range(0, len(ids), 97)] == ids[::97].tolist()
    for bad in (-1, len(ids)):
        with pytest.raises(IndexError):
            reader.access(bad)
    for token in (1, 2, 7, int(ids[1234]), 59_999, 1 << 16):
        where = np.flatnonzero(ids == token)
        assert reader.count(token) == len(where)
        assert all(reader.count(token, lo, hi) == ((where >= lo) & (where < hi)).sum() for lo, hi in ((0, 10), (450, 1700), (900, 900), (1000, 10**9)))
        for k in sorted({0, len(where) // 2, len(where) - 1} - {-1}):
            assert reader.occurrence(token, k) == (where[k] if k < len(where) else -1)
        assert reader.occurrence(token, len(where)) == -1
    # one token is read from one block's planes alone
    sizes = [sum(s for s, _ in b["parts"]) for b in reader.blocks]
    reads, plain = [], ShardReader.part
    monkeypatch.setattr(ShardReader, "part", lambda self, block, i: reads.append(block["parts"][i][0]) or plain(self, block, i))
    reader.access(1234)
    assert 0 < sum(reads) <= max(sizes)
    reads.clear()
    reader.count(1 << 16)
    assert not reads


def test_eviction_keeps_ids_right(monkeypatch):
    monkeypatch.setattr(tokens, "MOST", 60)
    monkeypatch.setattr(tokens, "KEPT", 20)
    small = PieceEncoder(default_path())
    texts = [prose(i, 30) + f"\nline {i} , end." for i in range(60)] + ["", " lead  two"]
    for i in range(0, len(texts), 7):
        some = texts[i : i + 7]
        assert [x.tolist() for x in small.encode(some)] == [whole(x) for x in some] and small.count(some) == [len(whole(x)) for x in some]
    assert len(small.known) < 2_000


def test_what_is_remembered_is_bounded_by_bytes():
    """Few but long pieces, each once, then some again."""
    rng = np.random.default_rng(3)
    pieces = ["".join(rng.choice(list("abcdefgh"), 2_000)) for _ in range(60)]
    small, most = PieceEncoder(default_path(), held=100_000), 0
    for i in range(0, 60, 4):
        some = [" ".join(pieces[i : i + 4]), "short words " + pieces[0], ""]
        assert [x.tolist() for x in small.encode(some)] == [whole(x) for x in some]
        most = max(most, small.known.nbytes + small.ids.nbytes)
    assert most <= 100_000 + 5 * 2_000 * 5 and len(small.known) < 60  # one look-up's pieces above the bound, at most


def test_batches_are_looked_up_together():
    batches = [pa.RecordBatch.from_arrays([pa.array(range(at, at + n)), pa.array(["x" * size] * n, pa.string())], ["doc_id", "text"]) for at, n, size in ((0, 3, 9), (3, 0, 1), (3, 4, 9), (7, 2, 5_000), (9, 1, 9), (10, 30, 1), (40, 1, 1))]
    got = list(tokens.together(iter(batches), 20, 2_000))
    assert [d.to_pylist() for d, _ in got] == [list(range(a, b)) for a, b in ((0, 7), (7, 9), (9, 10), (10, 40), (40, 41))]
    assert [x for _, texts in got for x in texts.to_pylist()] == [x for b in batches for x in b.column(1).to_pylist()]
    assert list(tokens.together(iter([]), 20, 2_000)) == []


def test_ids_are_put_in_place_part_by_part(monkeypatch):
    text = "\n".join(prose(i, 60) for i in range(4)) + " end  of it\n"
    monkeypatch.setattr(tokens, "PLACED", 7)
    assert [x.tolist() for x in PieceEncoder(default_path()).encode([text, "", "a b", text])] == [whole(x) for x in (text, "", "a b", text)]


def test_shards_are_written_from_many_batches_at_a_time(spark, monkeypatch):
    """Rows that came in three batches of 1,000, encoded in two calls, keep their order and ids."""
    monkeypatch.setattr(wavelet, "ROWS", 2_500)
    docs = spark.range(3_000).selectExpr("id AS doc_id", "concat('word ', id, '. More') AS text").coalesce(1)
    rows = sorted(wavelet_shards(spark, docs).collect())
    at = 0
    for r in rows:
        ids = np.array([*whole(f"word {r.doc_id}. More"), 0], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert len(rows) == 3_000


def test_shards_of_odd_rows(spark):
    got = sorted(wavelet_shards(spark, frame(spark)).collect(), key=lambda r: r.start)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    want = sorted(((d, len(e), zlib.crc32(e.tobytes())) for d, t, *_ in documents() for e in [np.array([*whole(t or ""), 0], "<u4")]), key=repr)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=repr) == want


def test_bounds_are_optimal():
    import itertools

    rng = np.random.default_rng(0)
    for _ in range(200):
        n, k = int(rng.integers(1, 9)), int(rng.integers(1, 6))
        lengths, counts = np.sort(rng.choice(60, n, replace=False) + 1), rng.integers(1, 20, n)
        cost = lambda bounds: sum(c * (min(b for b in bounds if b >= x) - x) for x, c in zip(lengths, counts, strict=True))  # noqa: B023, E731
        bounds, padding = optimal_bounds(lengths, counts, k)
        best = min(cost({*s, lengths[-1]}) for m in range(min(k, n)) for s in itertools.combinations(lengths[:-1], m))
        assert padding == best == cost(bounds) and len(bounds) <= k


def test_batches_of_odd_rows(spark):
    got = pack(spark, frame(spark), buckets=4, budget=600).collect()
    assert sorted(((r.doc_id, r.n_tokens) for r in got), key=repr) == sorted(((d, len(whole(t or "")) + 1) for d, t, *_ in documents()), key=repr)
    places = [(r.bucket, r.batch, r.place) for r in got]
    assert len(set(places)) == len(places)
    for b in {p[:2] for p in places}:
        rows = [r for r in got if (r.bucket, r.batch) == b]
        assert len(rows) == 1 or sum(r.padded_to for r in rows) <= 600
        assert sorted(r.place for r in rows) == list(range(len(rows))) and all(r.n_tokens <= r.padded_to for r in rows)
    lengths = sorted(r.n_tokens for r in got)
    assert sum(r.padding for r in got) == optimal_bounds(np.unique(lengths), np.unique(lengths, return_counts=True)[1], 4)[1]


def test_long_lengths_are_exact_unless_bins_are_asked_for(spark):
    rng = np.random.default_rng(6)
    lengths = [*rng.integers(1, 200, 300).tolist(), *rng.integers(4_000, 400_000, 300).tolist()]
    sizes = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id long, n_tokens long")
    distinct, counts = np.unique(lengths, return_counts=True)
    bounds, least = optimal_bounds(distinct, counts, 8)
    got = packed(Scratch(spark, "exact"), sizes, buckets=8).collect()
    assert sum(r.padding for r in got) == least and {r.padded_to for r in got} == set(bounds)
    binned = packed(Scratch(spark, "bins"), sizes, buckets=8, precision=64).collect()
    padded = sum(r.padded_to for r in binned if r.padded_to >= 128)
    assert least <= sum(r.padding for r in binned) <= least + padded / 64


@pytest.mark.parametrize("f", [wavelet_shards, pack])
def test_empty_table(spark, f):
    assert f(spark, spark.createDataFrame([], SCHEMA)).count() == 0
