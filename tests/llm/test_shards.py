import hashlib
import itertools
import random
import re
import zlib

from evidentia.llm.blob_ledger import RULES, scan_versions
from evidentia.llm.hilbert import hilbert_index, hilbert_shards

from .fixtures import SCHEMA, documents, frame


def test_hilbert_curve_moves_one_step_at_a_time(spark):
    from pyspark.sql import functions as F

    cells = list(itertools.product(range(8), repeat=3))
    df = spark.createDataFrame(cells, "x int, y int, z int")
    at = {r.h: (r.x, r.y, r.z) for r in df.withColumn("h", hilbert_index([F.col("x"), F.col("y"), F.col("z")], 3)).collect()}
    assert sorted(at) == list(range(512))
    assert all(sum(abs(a - b) for a, b in zip(at[i], at[i + 1], strict=True)) == 1 for i in range(511))


def test_shards_of_odd_rows(spark):
    got = hilbert_shards(spark, frame(spark)).collect()
    want = sorted(((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in documents()), key=repr)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=repr) == want
    sizes = [sum(r.shard == s for r in got) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1 and {r.law for r in got} == {"rows"}
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s])) for s in range(16))
    order = [r.cell for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order)
    assert hilbert_shards(spark, spark.createDataFrame([], SCHEMA)).count() == 0


def base_spans(text):
    out = []
    for i, (kind, pattern, flags, group, least) in enumerate(RULES):
        out += [(m.start(), i, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text, flags) if len(m[group]) >= least]
    return ",".join(s for *_, s in sorted(out))


def test_secrets_of_odd_rows(spark):
    got = scan_versions(spark, frame(spark))[0].collect()
    want = sorted(((d, base_spans(t or "")) for d, t, *_ in documents()), key=repr)
    assert sorted(((r.doc_id, r.spans) for r in got), key=repr) == want
    for r in got:
        kinds = [s.split(":")[0] for s in r.spans.split(",") if s]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(kinds.count(k) for k in ("assign", "access", "hex"))
        assert r.base_sha256 == hashlib.sha256(r.spans.encode()).hexdigest()
    assert any(r.n_assign and r.n_access and r.n_hex for r in got)
    assert scan_versions(spark, spark.createDataFrame([], SCHEMA))[0].count() == 0


def test_only_unseen_blobs_are_scanned(spark):
    first, ledger = scan_versions(spark, frame(spark))
    ledger = ledger.withColumn("spans", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("from the ledger"))
    new = (99, "secret = brandnewvalue", "en", "s", 1, 7, "x", 0.5, "same", 1, 2, 0.1, None)
    again, grown = scan_versions(spark, frame(spark, [*documents(), new]), ledger)
    by = {r.doc_id: r.spans for r in again.collect()}
    assert by.pop(99) == "assign:0:22" and set(by.values()) == {"from the ledger"}
    assert grown.count() == ledger.count() + 1
    other = (("assign", RULES[0][1], RULES[0][2], 2, 7), *RULES[1:])
    changed = scan_versions(spark, frame(spark), ledger, other)[0].collect()
    assert "from the ledger" not in {r.spans for r in changed}


def test_shards_prune_on_each_dimension(spark):
    """Bytes that a footer's least and greatest value let a filter skip, against files in doc_id order."""
    rng, rows = random.Random(4), []
    for i in range(4_000):
        rows.append((i, "x" * int(10 ** rng.uniform(0, 3.5)), rng.choice(["de", "en", "en", "es", "fr"]), f"src{rng.randrange(20)}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)
    got = {r.doc_id: (r.shard, r.size) for r in hilbert_shards(spark, docs).collect()}

    def skipped(shard_of, value, wanted):
        """The share of bytes in shards whose range of a value doesn't meet the wanted one."""
        held = {}
        for i, text, *rest in rows:
            held.setdefault(shard_of(i), []).append((value(i, text, *rest), len(text) + 1))
        away = sum(n for x in held.values() if min(v for v, _ in x) > wanted[1] or max(v for v, _ in x) < wanted[0] for _, n in x)
        return away / sum(len(t) + 1 for _, t, *_ in rows)

    ours, plain = lambda i: got[i][0], lambda i: i * 16 // len(rows)
    for value, wanted in ((lambda i, t, l, s: len(t) + 1, (1, 20)), (lambda i, t, l, s: l, ("de", "de")), (lambda i, t, l, s: s, ("src3", "src3"))):
        assert skipped(plain, value, wanted) == 0 and skipped(ours, value, wanted) > 0.25


def test_long_values_are_told_apart(spark):
    """Values that agree in their first bytes are places of their own, in the order of the whole values."""
    from evidentia.llm.hilbert import with_places
    from evidentia.llm.scratch import Scratch

    values = [f"https://one.site/{'x' * 30}/{i:03}" for i in range(50)] + ["", None, "z", "é", "漢"]
    rows = spark.createDataFrame([(v,) for v in values * 3], "source string").repartition(4)
    got = {r.source: r.source_place for r in with_places(Scratch(spark, "t"), rows, "source").distinct().collect()}
    assert len(got) == len(values) and got.pop(None) == -1
    order = sorted(got, key=lambda v: v.encode())
    assert [got[v] for v in order] == sorted(got.values()) and len(set(got.values())) == len(got)
