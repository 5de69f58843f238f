"""Secret scans over an incremental ledger of blobs.

Every version of every path is addressed by the SHA-256 of its content. The ledger is a table of (blob, rule_version,
findings); a scan addresses all versions, takes the blobs that the ledger has no row for under the current rules, fetches
one text of each, scans it once, and adds the rows to the ledger. Findings are then joined back to all paths that hold
the blob. Addresses and findings are narrow; texts move only for blobs not yet scanned.

Defined cases: a null text counts as empty; an empty text is a blob without findings; paths and versions that repeat each
get a row; null paths are kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch, sized, text_of

#: The rules, fixed values, in the order in which kinds are listed: kind, pattern, the group that counts, its least length.
RULES = (
    ("assign", r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII, 2, 6),
    ("access", r"AKIA[A-Z0-9]+", re.ASCII, 0, 20),
    ("hex", r"[0-9a-f]+", re.ASCII, 0, 24),
)

LEDGER = "blob binary, rule_version string, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def rule_version(rules: Sequence[tuple] = RULES) -> str:
    """Changes whenever a rule does, so blobs are scanned again."""
    return hashlib.sha256(repr([(k, p, int(f), g, n) for k, p, f, g, n in rules]).encode()).hexdigest()[:16]


def compiled(rules: Sequence[tuple] = RULES) -> list[tuple]:
    """Patterns that end in a run of one class can ask for the least length at once: a shorter run has no longer part."""
    out = []
    for kind, pattern, flags, group, least in rules:
        if kind == "hex":
            pattern = pattern.removesuffix("+") + f"{{{least},}}"
        out.append((kind, re.compile(pattern, flags), group, least))
    return out


def find(text: str, rules: Sequence[tuple]) -> list[tuple[int, int, str, int]]:
    """(start, order of the kind, kind, end) of every match that is long enough; leftmost and not overlapping for each kind."""
    found = []
    for order, (kind, pattern, group, least) in enumerate(rules):
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(), order, kind, m.end()))
    return sorted(found)


def scan(blobs: DataFrame, rules: Sequence[tuple] = RULES) -> DataFrame:
    """A ledger row for each (blob, text)."""
    version = rule_version(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = compiled(rules)
        for batch in batches:
            counts, digests, spans = [[] for _ in rules], [], []
            for text in batch.column(1):
                found = find(text.as_py(), ready)
                for order, column in enumerate(counts):
                    column.append(sum(f[1] == order for f in found))
                spans.append(",".join(f"{kind}:{start}:{end}" for start, _, kind, end in found))
                digests.append(hashlib.sha256(spans[-1].encode()).hexdigest())
            versions = pa.array([version] * batch.num_rows, pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), versions, *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string())], ["blob", "rule_version", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return blobs.mapInArrow(run, LEDGER)


def update_ledger(scratch: Scratch, addressed: DataFrame, texts: DataFrame, ledger: DataFrame | None = None, rules: Sequence[tuple] = RULES) -> DataFrame:
    """The ledger's rows under these rules, with the blobs of ``addressed`` (path, blob) that it had none for.

    ``texts`` has path, blob and text. The first path that holds an unseen blob stands for it.
    """
    blobs = addressed.groupBy("blob").agg(F.min("path").alias("path"))
    known = None
    if ledger is not None:
        known = ledger.filter(F.col("rule_version") == rule_version(rules))
        blobs = blobs.join(known.select("blob"), "blob", "left_anti")
    blobs = scratch.keep(blobs, "unseen")
    fetched = texts.join(sized(blobs, blobs.count()), (texts["blob"] == blobs["blob"]) & texts["path"].eqNullSafe(blobs["path"])).select(blobs["blob"], "text")
    fresh = scratch.keep(scan(fetched, rules).dropDuplicates(["blob"]), "fresh")
    return known.unionByName(fresh) if known is not None else fresh


def scan_versions(spark: SparkSession, versions: DataFrame, ledger: DataFrame | None = None, rules: Sequence[tuple] = RULES) -> tuple[DataFrame, DataFrame]:
    """(findings for every row of ``versions`` (doc_id, text), the new ledger)."""
    scratch = Scratch(spark, "ledger")
    texts = versions.select(F.col("doc_id").cast("long").alias("path"), text_of().alias("text"))
    texts = texts.withColumn("blob", F.unhex(F.sha2("text", 256)))
    addressed = scratch.keep(texts.select("path", "blob"), "addressed")
    now = update_ledger(scratch, addressed, texts, ledger, rules)
    now = scratch.keep(now, "now") if ledger is not None else now
    # spans have no bound in bytes, so Spark chooses the join by their size, and splits hot blobs
    told = addressed.join(now.select("blob", "n_assign", "n_access", "n_hex", "base_sha256", "spans"), "blob")
    return told.select(F.col("path").alias("doc_id"), "n_assign", "n_access", "n_hex", "base_sha256", "spans"), now
