"""Inventories, verified copies, the commit log, the stage cache and keyed state, on folders that the tests write."""

import hashlib
import os
import threading
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from evidentia.sources import commits as K, inventory as I
from evidentia.streaming import state as S


def put(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_inventory_and_manifests_both_ways(spark, tmp_path):
    for name, data in (("a/x.pdf", b"one"), ("a/y.pdf", b"two"), ("b/orphan.pdf", b"three"), ("b/note.txt", b"no")):
        put(f"{tmp_path}/c/{name}", data)
    old = datetime.now().timestamp() - 5_000
    os.utime(f"{tmp_path}/c/a/x.pdf", (old, old))
    files = I.inventory(spark, f"{tmp_path}/c", "*.pdf")
    got = {r.path.rpartition("/c/")[2]: (r.length, r.sha256) for r in files.collect()}
    assert got == {"a/x.pdf": (3, sha(b"one")), "a/y.pdf": (3, sha(b"two")), "b/orphan.pdf": (5, sha(b"three"))}
    root = files.first().path.rpartition("/c/")[0] + "/c/"
    rows = [("d1", root + "a/x.pdf", sha(b"one").upper()), ("d2", root + "a/y.pdf", "0" * 64), ("d3", root + "gone.pdf", sha(b"x")), ("d4", None, None), ("d5", root + "a/x.pdf", " ")]
    base = I.document_base(spark.createDataFrame(rows, "document_id string, path string, sha256 string"), files)
    assert {(r.document_id, r.file_status) for r in base.collect()} == {("d1", "ok"), ("d2", "checksum_mismatch"), ("d3", "missing_file"), ("d4", "missing_file"), ("d5", "no_checksum"), (None, "orphan_file")}
    assert {r.file_status: r.rows for r in I.base_summary(base).collect()}["missing_file"] == 2


def test_only_changed_files_are_read(spark, tmp_path):
    for i in range(5):
        put(f"{tmp_path}/c/{i}.bin", b"%d" % i)
        at = datetime.now().timestamp() - 10_000 + i
        os.utime(f"{tmp_path}/c/{i}.bin", (at, at))
    known = spark.createDataFrame(I.inventory(spark, f"{tmp_path}/c").withColumn("sha256", F.lit("as known")).collect(), I.INVENTORY)
    put(f"{tmp_path}/c/3.bin", b"changed")
    put(f"{tmp_path}/c/new.bin", b"new")
    os.remove(f"{tmp_path}/c/0.bin")
    got = {r.path.rpartition("/")[2]: r.sha256 for r in I.inventory(spark, f"{tmp_path}/c", known=known).collect()}
    assert got == {"1.bin": "as known", "2.bin": "as known", "4.bin": "as known", "3.bin": sha(b"changed"), "new.bin": sha(b"new")}
    again = I.inventory(spark, f"{tmp_path}/c", known=I.inventory(spark, f"{tmp_path}/c"))
    assert again.count() == 5


def test_copies_are_whole_and_done_once(spark, tmp_path):
    put(f"{tmp_path}/s/a", b"a" * 1000)
    put(f"{tmp_path}/s/b", b"b")
    put(f"{tmp_path}/t/x/_attempt-of-a-lost-task", b"a" * 10)  # what a killed attempt leaves
    put(f"{tmp_path}/t/x/a", b"half")  # and a target that isn't what it should be
    u = lambda p: f"file://{tmp_path}/{p}"
    rows = [(u("s/a"), u("t/x/a"), sha(b"a" * 1000)), (u("s/a"), u("t/y/a"), sha(b"a" * 1000).upper()), (u("s/b"), u("t/y/b"), sha(b"other")), (u("s/none"), u("t/y/c"), "x"), (None, u("t/y/d"), "x")]
    plan = spark.createDataFrame(rows, "source string, target string, sha256 string")
    said = lambda: {r.target.rpartition("/t/")[2]: r.copy_status for r in I.copy_verified(plan).collect()}
    assert said() == {"x/a": "copied", "y/a": "copied", "y/b": "checksum_mismatch", "y/c": "missing_source"}
    assert open(f"{tmp_path}/t/x/a", "rb").read() == b"a" * 1000 and not os.path.exists(f"{tmp_path}/t/y/b")
    stamp = os.stat(f"{tmp_path}/t/x/a").st_mtime_ns
    assert said()["x/a"] == said()["y/a"] == "present" and os.stat(f"{tmp_path}/t/x/a").st_mtime_ns == stamp
    assert sorted(os.listdir(f"{tmp_path}/t/y")) == ["a"]


def test_two_writers_lose_nothing(spark, tmp_path):
    log = K.CommitLog(spark, f"file://{tmp_path}/log")
    assert log.read() is None
    numbers, wrong = [], []

    def write(who):
        try:
            mine = K.CommitLog(spark, f"file://{tmp_path}/log")
            for i in range(4):
                numbers.append(mine.append(spark.createDataFrame([(who, i)], "who string, i int"), who=who))
        except Exception as e:  # noqa: BLE001
            wrong.append(e)

    threads = [threading.Thread(target=write, args=(w,)) for w in ("a", "b")]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not wrong and sorted(numbers) == list(range(1, 9))
    assert sorted((r.who, r.i) for r in log.read().collect()) == [(w, i) for w in "ab" for i in range(4)]
    assert log.read(who="a").count() == 4 and log.read(until=3).count() == 3
    # rows without a commit, and half a commit, aren't there
    spark.range(3).write.parquet(f"{tmp_path}/log/rows/lost")
    put(f"{tmp_path}/log/commits/_attempt-x", b"{")
    assert log.read().count() == 8


def test_stages_run_again_only_where_an_input_changed(spark, tmp_path):
    def build(version, least, code="1", force=False):
        cache = K.StageCache(spark, f"file://{tmp_path}/cache")
        cache.source("raw", version)
        cache.source("names", "n1")
        one = cache.run("one", lambda raw, least: raw.filter(F.col("id") >= least), {"raw": spark.range(10)}, {"least": least})
        two = cache.run("two", lambda names: names.withColumn("x", F.lit(1)), {"names": spark.range(2).withColumnRenamed("id", "n")}, code=code)
        three = cache.run("three", lambda one, two: one.join(two, one.id == two.n), {"one": one, "two": two}, force=force)
        return cache.ran, three.count()

    assert build("v1", 1) == (["one", "two", "three"], 1)
    assert build("v1", 1) == ([], 1)
    assert build("v1", 0) == (["one", "three"], 2)
    assert build("v2", 0) == (["one", "three"], 2)
    assert build("v2", 0, code="2") == (["two", "three"], 2)
    assert build("v2", 0, code="2", force=True) == (["three"], 2)
    assert build("v1", 1) == ([], 1)  # an earlier version is still there


def test_versions_of_files(spark):
    rows = [("a", 1, None, "x"), ("b", 2, None, "y")]
    df = spark.createDataFrame(rows, I.INVENTORY)
    assert K.version_of(df) == K.version_of(df.orderBy(F.desc("path"))) != K.version_of(df.limit(1))
    assert K.version_of(df) != K.version_of(spark.createDataFrame([("a", 1, None, "y"), ("b", 2, None, "x")], I.INVENTORY))


def test_statuses_survive_a_restart(spark, tmp_path):
    """The same table from one run over all files, and from runs that stop and start between them."""
    start = datetime(2024, 1, 1)
    files = [
        [("t1", "running", start), ("t2", "running", start), ("t3", "running", start)],
        [("t1", "failed", start + timedelta(minutes=2)), ("t1", "running", start + timedelta(minutes=1)), ("t2", "done", start + timedelta(minutes=5)), ("t4", None, start)],
        [("t1", "done", start + timedelta(minutes=9)), (None, "running", start + timedelta(minutes=9)), ("t5", "running", None)],
    ]

    def drop(folder, i):
        spark.createDataFrame(files[i], "task string, status string, at timestamp").coalesce(1).write.mode("append").parquet(folder)

    def go(folder, to):
        stream = spark.readStream.schema("task string, status string, at timestamp").parquet(folder)
        S.to_table(S.last_statuses(stream, "task", "status", "at"), f"{to}/table", f"{to}/checkpoint").awaitTermination()

    for i in range(3):
        drop(f"{tmp_path}/all", i)
    go(f"{tmp_path}/all", f"{tmp_path}/once")
    for i in range(3):
        drop(f"{tmp_path}/bit", i)
        go(f"{tmp_path}/bit", f"{tmp_path}/often")
    tables = [sorted((r.task or "", r.status or "", r.at, r.events) for r in S.latest(spark.read.parquet(f"{tmp_path}/{x}/table")).collect()) for x in ("once", "often")]
    assert tables[0] == tables[1]
    assert [(t, s, n) for t, s, _, n in tables[0]] == [("", "running", 1), ("t1", "done", 4), ("t2", "done", 2), ("t3", "running", 1), ("t4", "", 1)]


def test_idle_running_tasks_time_out(spark, tmp_path):
    start = datetime(2024, 1, 1)
    stream = lambda: spark.readStream.schema("task string, status string, at timestamp").parquet(f"{tmp_path}/in")
    for i, rows in enumerate(([("a", "running", start), ("b", "done", start)], [("c", "running", start + timedelta(hours=5))], [("d", "running", start + timedelta(hours=6))])):
        spark.createDataFrame(rows, "task string, status string, at timestamp").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        S.to_table(S.last_statuses(stream(), "task", "status", "at"), f"{tmp_path}/out", f"{tmp_path}/mark").awaitTermination()
    got = {r.task: r.status for r in S.latest(spark.read.parquet(f"{tmp_path}/out")).collect()}
    assert got["a"] == "timed_out" and got["b"] == "done" and got["d"] == "running"
