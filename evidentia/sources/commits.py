"""An append log of tables with numbered commits, and a cache of stages on top of it.

Rows are written to a folder of their own first. A commit is a small numbered file that names the folder; it appears
whole or not at all, and only one writer can create a number, so of two writers the later one takes the next number.
Readers see the folders of the commits that are there and nothing else: a writer that is lost leaves rows that no commit
names.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class CommitLog:
    """A log below ``root``, on any file system that Spark knows."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.root}/commits"))

    def _publish(self, number: int, text: str) -> bool:
        """Creates a commit file if its number is free."""
        name, attempt = f"{self.root}/commits/{number:020d}.json", f"{self.root}/commits/_attempt-{uuid.uuid4().hex}"
        to = self._fs.create(self._path(attempt), False)
        to.write(bytearray(text.encode()))
        to.close()
        try:
            if self._fs.getUri().getScheme() == "file":
                # a hard link is created only if its name is free
                local = lambda p: self._fs.makeQualified(self._path(p)).toUri().getPath()
                os.link(local(attempt), local(name))
                return True
            context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark._jsc.hadoopConfiguration())
            none = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
            context.rename(self._path(attempt), self._path(name), none)
            return True
        except FileExistsError:
            return False
        except Exception as e:
            if "FileAlreadyExistsException" in str(e):
                return False
            raise
        finally:
            self._fs.delete(self._path(attempt), False)

    def commits(self) -> list[dict]:
        """All commits in order of their numbers. Their files are a few hundred bytes each."""
        rows = self.spark.read.option("wholetext", True).option("pathGlobFilter", "*.json").text(f"{self.root}/commits").select("value").collect()
        return sorted((json.loads(r["value"]) for r in rows), key=lambda c: c["number"])

    def append(self, rows: DataFrame, **about: str) -> int:
        """Writes rows as one commit and returns its number."""
        folder = f"rows/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.root}/{folder}")
        number = max((c["number"] for c in self.commits()), default=0) + 1
        while not self._publish(number, json.dumps({"number": number, "folder": folder, "schema": rows.schema.json(), "about": about}, sort_keys=True)):
            number += 1
        return number

    def read(self, until: int | None = None, **about: str) -> DataFrame | None:
        """The rows of all commits (up to a number; with these properties), with ``commit``; None without any."""
        some = [c for c in self.commits() if (until is None or c["number"] <= until) and all(c["about"].get(k) == v for k, v in about.items())]
        parts = [self._rows(c).withColumn("commit", F.lit(c["number"])) for c in some]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None

    def _rows(self, commit: dict) -> DataFrame:
        from pyspark.sql.types import StructType

        return self.spark.read.schema(StructType.fromJson(json.loads(commit["schema"]))).parquet(f"{self.root}/{commit['folder']}")


class StageCache:
    """Runs a stage once for each version of its inputs and parameters.

    A stage's version is a digest of its name, the code given for it, its parameters and its inputs' versions, so what
    depends on a changed input runs again and nothing else. Outputs are commits of a log; one that isn't whole is no commit.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.log, self.ran = CommitLog(spark, root), []
        self._versions: dict[str, str] = {}

    def source(self, name: str, version: str) -> str:
        """Tells the version of an input from outside, such as :func:`version_of` its files."""
        self._versions[name] = version
        return name

    def run(self, name: str, stage: Callable[..., DataFrame], inputs: Mapping[str, DataFrame], parameters: Mapping[str, object] | None = None, code: str = "", force: bool = False) -> DataFrame:
        """The stage's output over its named inputs: of earlier stages, or told by :meth:`source`. ``code`` is a text that
        changes with what the stage does; ``force`` runs it anew."""
        versions = {k: self._versions[k] for k in sorted(inputs)}
        version = hashlib.sha256(json.dumps([name, code, versions, dict(parameters or {})], sort_keys=True, default=str).encode()).hexdigest()
        self._versions[name] = version
        done = [c for c in self.log.commits() if c["about"].get("version") == version]
        if force or not done:
            self.ran.append(name)
            self.log.append(stage(**inputs, **(parameters or {})), stage=name, version=version)
            done = [c for c in self.log.commits() if c["about"].get("version") == version]
        return self.log._rows(done[-1])


def version_of(files: DataFrame) -> str:
    """A digest of an inventory, the same in any order: of paths, lengths and checksums, or times where there are none."""
    mark = F.coalesce(F.col("sha256"), F.col("modified").cast("string")) if "sha256" in files.columns else F.col("modified").cast("string")
    one = F.sha2(F.concat_ws("|", "path", F.col("length").cast("string"), mark), 256)
    # the sum of the digests' halves, which are numbers below 2^60, doesn't mind the order
    half = lambda i: F.sum(F.conv(F.substring(one, i, 15), 16, 10).cast("decimal(38,0)")).cast("string")
    row = files.agg(F.count(F.lit(1)).cast("string"), half(1), half(16), half(31)).first()
    return hashlib.sha256("|".join(str(x) for x in row).encode()).hexdigest()
