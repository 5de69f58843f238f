"""The registered queries of this subpackage: each operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bagminhash import near_dedup
from .blob_ledger import scan_versions
from .golay_simhash import near_fingerprints
from .hilbert import hilbert_shards
from .mixing import mix
from .packing import pack
from .part_codes import vector_codes
from .quality_knn import quality_scores
from .radix_dedup import exact_dedup
from .vptree import nearest
from .wand import ranked_search
from .warc_zstd import warc_round_trip
from .wavelet import wavelet_shards


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(spark, _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op2_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(spark, _read(spark, sf_dir, "pages"))


def op3_vantage_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark, _read(spark, sf_dir, "embeddings"))


def op4_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet_shards(spark, _read(spark, sf_dir, "documents"))


def op5_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards(spark, _read(spark, sf_dir, "documents"))


def op6_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_versions(spark, _read(spark, sf_dir, "documents"))[0]


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark, _read(spark, sf_dir, "documents"))


def op8_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, _read(spark, sf_dir, "documents"))


def op9_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark, _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op10_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(spark, _read(spark, sf_dir, "documents"))


def op11_wand_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(spark, _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op12_part_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(spark, _read(spark, sf_dir, "embeddings"))


def op13_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_fingerprints(spark, _read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_knn": op1_quality_knn,
    "op2_warc_zstd": op2_warc_zstd,
    "op3_vantage_point": op3_vantage_point,
    "op4_wavelet_shards": op4_wavelet_shards,
    "op5_hilbert_shards": op5_hilbert_shards,
    "op6_blob_ledger": op6_blob_ledger,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_length_buckets": op8_length_buckets,
    "op9_soft_mixing": op9_soft_mixing,
    "op10_bagminhash": op10_bagminhash,
    "op11_wand_search": op11_wand_search,
    "op12_part_codes": op12_part_codes,
    "op13_golay_simhash": op13_golay_simhash,
}

#: One round of Lloyd over weighted distinct parts, from the table {before} of entries to {after}.
_ROUND = """
        near_{before} AS (
            SELECT d.pos, d.part, any_value(d.n) AS n, min({{'far': CAST(list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(d.part, b.part)]) AS BIGINT), 'entry': b.entry}}) AS best
            FROM weighted d JOIN {before} b ON d.pos = b.pos GROUP BY d.pos, d.part
        ),
        mean_{before} AS (
            SELECT pos, entry, list(mean ORDER BY place) AS part
            FROM (SELECT pos, best.entry AS entry, place, CAST(floor(sum(n * x) / sum(n)) AS BIGINT) AS mean FROM (SELECT pos, best, n, unnest(part) AS x, generate_subscripts(part, 1) AS place FROM near_{before}) GROUP BY ALL)
            GROUP BY pos, entry
        ),
        {after} AS (SELECT b.pos, b.entry, coalesce(m.part, b.part) AS part FROM {before} b LEFT JOIN mean_{before} m ON b.pos = m.pos AND b.entry = m.entry),
"""

ORACLE_SQL: dict[str, str] = {
    "op11_wand_search": r"""
        WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
        q AS (SELECT item_id, row_number() OVER () AS i, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        whole AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d WHERE len(terms) > 0),
        posting AS (SELECT r, doc_id, len(terms) AS n, t.term, count(*) AS tf FROM d, unnest(d.terms) AS t(term) GROUP BY ALL),
        weight AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM posting, whole GROUP BY term),
        asked AS (SELECT i, item_id, term, count(*) AS times FROM q GROUP BY ALL),
        scored AS (
            SELECT i, item_id, r, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
            FROM asked JOIN posting USING (term) JOIN weight USING (term), whole GROUP BY ALL
        )
        SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
        QUALIFY row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) <= 10
    """,
    "op12_part_codes": """
        WITH kept AS (
            SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS r, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
            FROM embeddings WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
        ),
        cells AS (SELECT r, vec_id, label, pos, v[pos * (len(v) // 16) + 1 : (pos + 1) * (len(v) // 16)] AS part FROM kept, range(16) AS t(pos)),
        weighted AS (SELECT pos, part, count(*) AS n FROM cells GROUP BY pos, part),
        book AS (SELECT pos, r - 1 AS entry, part FROM cells WHERE r <= 64),
    """
    + _ROUND.format(before="book", after="book1")
    + _ROUND.format(before="book1", after="book2")
    + """
        near AS (
            SELECT d.pos, d.part, min({'far': CAST(list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(d.part, b.part)]) AS BIGINT), 'entry': b.entry}) AS best
            FROM weighted d JOIN book2 b ON d.pos = b.pos GROUP BY d.pos, d.part
        ),
        coded AS (
            SELECT r, vec_id, any_value(label) AS label, string_agg(printf('%02x', best.entry), '' ORDER BY pos) AS code, CAST(sum(best.far) AS BIGINT) AS error
            FROM cells JOIN near USING (pos, part) GROUP BY r, vec_id
        ),
        digest AS (SELECT sha256(string_agg(x, ',' ORDER BY pos, entry, place)) AS d FROM (SELECT pos, entry, unnest(part) AS x, generate_subscripts(part, 1) AS place FROM book2))
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, d AS codebooks_sha256 FROM coded, digest
    """,
    "op2_warc_zstd": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        q AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest, min(page_id) OVER (PARTITION BY html) AS first_id FROM p)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
        FROM q
    """,
    "op7_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
            FROM documents
        )
        SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
               first_value(doc_id) OVER best = doc_id AS kept, sha256(norm) AS text_sha256
        FROM n WINDOW best AS (PARTITION BY norm ORDER BY points DESC, doc_id)
    """,
}
