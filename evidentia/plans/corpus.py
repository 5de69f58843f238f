"""Queries of the corpus path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import display, domain, first_best, hash_id, marker_vote, normalize, slug
from ..operators.corpus import (
    canonical_documents as canonical,
    dedup_summary as summary_of,
    distribution,
    duplicate_ids,
    duplicate_members as members_of,
    exact_duplicate_groups as duplicate_groups,
    group_summary,
    left_join_guarded,
    quality_bucket,
    ranked_selection,
    repeated_keys,
    selection_score,
    with_reasons,
    worst_per_key,
)
from ..operators.documents import block_statistics as statistics_of, page_diagnostics as diagnostics_of, repeated_lines as lines_on_pages
from ..operators.families import FAMILIES
from ..operators.scoring import POINTS, Family, score, scored_by_all
from ..sources.links import page_links
from .registry import query, table


def _hashed(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").withColumn("sha256", F.sha2("text", 256))


def _judged(spark: SparkSession, d: str) -> DataFrame:
    """documents with the label's status."""
    labels = table(spark, d, "labels").select("doc_id", "quality", "toxic")
    status = F.when(F.col("quality") == 1, F.lit("likely_valid")).when(F.col("quality") == 0, F.lit("likely_wrong_company")).otherwise(F.lit("needs_review"))
    return _hashed(spark, d).join(labels, "doc_id", "left").withColumn("status", status)


JUDGED = """
    judged AS (
        SELECT d.doc_id, d.source, d.lang, d.n_chars, sha256(d.text) AS sha256, l.quality, l.toxic,
               CASE l.quality WHEN 1 THEN 'likely_valid' WHEN 0 THEN 'likely_wrong_company' ELSE 'needs_review' END AS status
        FROM documents d LEFT JOIN labels l USING (doc_id)
    )
"""


@query("""
    WITH d AS (SELECT doc_id, source, sha256(text) AS sha256 FROM documents)
    SELECT sha256, count(*) AS duplicate_count, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS members,
           string_agg(DISTINCT source, ',' ORDER BY source) AS sources, printf('exact_dup_%04d', row_number() OVER (ORDER BY sha256)) AS duplicate_group_id
    FROM d GROUP BY sha256 HAVING count(*) > 1
""")
def exact_duplicate_groups(spark: SparkSession, d: str) -> DataFrame:
    out = duplicate_groups(_hashed(spark, d), ident="doc_id", sets={"source": "sources"})
    return out.withColumns({"members": F.array_join(F.transform("members", lambda x: x.cast("string")), ","), "sources": F.array_join("sources", ",")})


@query("""
    WITH d AS (SELECT doc_id, sha256(text) AS sha256 FROM documents), g AS (SELECT sha256, printf('exact_dup_%04d', row_number() OVER (ORDER BY sha256)) AS duplicate_group_id FROM d GROUP BY sha256 HAVING count(*) > 1)
    SELECT duplicate_group_id, doc_id AS member FROM d JOIN g USING (sha256)
""")
def duplicate_group_members(spark: SparkSession, d: str) -> DataFrame:
    """A row for each member, so that a text with very many copies is no list in one row."""
    docs = _hashed(spark, d).select("doc_id", "sha256")
    return members_of(docs, duplicate_ids(docs), ident="doc_id")


@query("""
    WITH k AS (SELECT sha256(text) AS k, count(*) AS n FROM documents GROUP BY 1)
    SELECT CAST(sum(n) AS BIGINT) AS documents, CAST(sum(n) FILTER (k IS NOT NULL) AS BIGINT) AS with_key, count(k) AS unique_keys,
           count(*) FILTER (k IS NOT NULL AND n > 1) AS groups, CAST(coalesce(sum(n) FILTER (k IS NOT NULL AND n > 1), 0) AS BIGINT) AS in_groups
    FROM k
""")
def dedup_summary(spark: SparkSession, d: str) -> DataFrame:
    return summary_of(_hashed(spark, d))


@query(f"""
    WITH {JUDGED},
    r AS (SELECT *, row_number() OVER (PARTITION BY sha256 ORDER BY quality DESC NULLS LAST, n_chars DESC, doc_id) AS rn, count(*) OVER (PARTITION BY sha256) AS duplicate_count FROM judged),
    s AS (SELECT sha256, string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM judged GROUP BY 1)
    SELECT sha256, doc_id, duplicate_count, sources, 'canonical_' || substr(sha256('canonical|' || sha256), 1, 24) AS canonical_document_id
    FROM r JOIN s USING (sha256) WHERE rn = 1
""")
def canonical_documents(spark: SparkSession, d: str) -> DataFrame:
    slim = _judged(spark, d).select("doc_id", "sha256", "quality", "n_chars", "source")
    out = canonical(slim, "sha256", [F.desc_nulls_last("quality"), F.desc("n_chars"), "doc_id"], {"source": "sources"})
    return out.select("sha256", "doc_id", "duplicate_count", F.array_join("sources", ",").alias("sources"), "canonical_document_id")


@query("SELECT lang, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM documents GROUP BY lang")
def taxonomy_distribution(spark: SparkSession, d: str) -> DataFrame:
    return distribution(table(spark, d, "documents"), "lang")


@query(f"""
    WITH {JUDGED},
    c AS (SELECT *, count(*) OVER (PARTITION BY sha256) AS copies FROM judged),
    s AS (
        SELECT doc_id, source, lang, sha256,
               1000 + CASE status WHEN 'likely_valid' THEN 500 WHEN 'needs_review' THEN 150 ELSE -700 END + CASE WHEN toxic = 0 THEN 40 ELSE 0 END + CASE WHEN n_chars > 500 THEN 30 ELSE 0 END
               + CASE WHEN n_chars > 1000 THEN 25 ELSE 0 END + CASE WHEN lang = 'en' THEN least(n_chars // 100, 500) * 0.2 ELSE 0 END + least(copies, 20) * 0.5 AS selection_score,
               CASE WHEN status = 'likely_wrong_company' THEN 'likely_wrong_company' WHEN n_chars < 50 THEN 'unreadable_pdf' END AS r1
        FROM c
    ),
    t AS (SELECT *, CASE WHEN r1 IS NULL AND row_number() OVER (PARTITION BY source, lang, r1 IS NULL, sha256 ORDER BY selection_score DESC, doc_id) > 1 THEN 'same_hash' ELSE r1 END AS r2 FROM s),
    u AS (SELECT *, coalesce(r2, CASE WHEN row_number() OVER (PARTITION BY source, lang, r2 IS NULL ORDER BY selection_score DESC, doc_id) > 1 THEN 'lower_ranked' END) AS selection_reason FROM t)
    SELECT doc_id, CAST(selection_score AS DOUBLE) AS selection_score, selection_reason, CASE WHEN selection_reason IS NULL THEN 'selected' ELSE 'rejected' END AS selection_status FROM u
""")
def document_selection(spark: SparkSession, d: str) -> DataFrame:
    docs = _judged(spark, d).select("doc_id", "source", "lang", "sha256", "n_chars", "status", "toxic")
    copies = docs.groupBy("sha256").agg(F.count(F.lit(1)).alias("copies"))
    docs = docs.join(copies, "sha256")
    n = F.col("n_chars")
    points = selection_score(F.lit("valid_pdf"), F.col("status"), F.col("toxic") == 0, n > 500, n > 1000, F.floor(n / 100), F.col("copies"), F.col("lang") == "en")
    docs = docs.withColumn("selection_score", F.round(points, 4))
    cases = [(F.col("status") == "likely_wrong_company", "likely_wrong_company"), (n < 50, "unreadable_pdf")]
    out = ranked_selection(docs, ["source", "lang"], [F.desc("selection_score"), "doc_id"], cases, same="sha256")
    return out.select("doc_id", "selection_score", "selection_reason", "selection_status")


@query(f"""
    WITH {JUDGED},
    r AS (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY CASE status WHEN 'likely_wrong_company' THEN 1 WHEN 'needs_review' THEN 2 WHEN 'likely_valid' THEN 3 ELSE 99 END, doc_id) AS rn FROM judged)
    SELECT source, lang, doc_id, status FROM r WHERE rn = 1
""")
def worst_status_per_key(spark: SparkSession, d: str) -> DataFrame:
    return worst_per_key(_judged(spark, d).select("source", "lang", "doc_id", "status"), ["source", "lang"], "status", "doc_id")


@query(f"""
    WITH {JUDGED},
    b AS (
        SELECT source, CASE WHEN status = 'likely_wrong_company' THEN 'quarantine' WHEN n_chars // 300 < 3 THEN 'high_priority_review' WHEN status = 'needs_review' OR toxic = 1 THEN 'review' ELSE 'keep' END AS bucket
        FROM judged
    )
    SELECT source, count(*) AS rows, count(*) FILTER (bucket = 'keep') AS keep, count(*) FILTER (bucket = 'review') AS review,
           count(*) FILTER (bucket = 'high_priority_review') AS high_priority_review, count(*) FILTER (bucket = 'quarantine') AS quarantine
    FROM b GROUP BY source
""")
def quality_bucket_summary(spark: SparkSession, d: str) -> DataFrame:
    docs = _judged(spark, d)
    bucket = quality_bucket(F.col("status"), F.floor(F.col("n_chars") / 300), F.when(F.col("toxic") == 1, 0.2).otherwise(0.9))
    return group_summary(docs.withColumn("bucket", bucket), ["source"], "bucket", ["keep", "review", "high_priority_review", "quarantine"])


@query("SELECT conv_id, count(*) AS rows FROM conversations GROUP BY 1 HAVING count(*) > 1")
def join_guard(spark: SparkSession, d: str) -> DataFrame:
    return repeated_keys(table(spark, d, "conversations"), ["conv_id"])


@query("""
    WITH f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1),
    s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1)
    SELECT o.o_orderkey AS l_orderkey, CAST(2 AS INT) AS l_linenumber, coalesce(f.l_partkey, s.l_partkey) AS l_partkey
    FROM orders o LEFT JOIN f ON f.l_orderkey = o.o_orderkey AND f.l_linenumber = 2 LEFT JOIN s ON s.l_orderkey = o.o_orderkey
""")
def join_with_fallback_key(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(2).alias("l_linenumber"))
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return left_join_guarded(orders, lines, ["l_orderkey", "l_linenumber"], ["l_orderkey"], ["l_partkey", "l_extendedprice"], "l_partkey")


@query("""
    WITH s AS (
        SELECT doc_id, nullif(concat_ws('; ', CASE WHEN lang <> 'en' THEN 'language' END, CASE WHEN n_chars < 200 THEN 'too_short' END, CASE WHEN source = 'src0' THEN 'source' END), '') AS r FROM documents
    )
    SELECT doc_id, coalesce(r, CASE WHEN row_number() OVER (PARTITION BY r IS NULL ORDER BY doc_id) > 100 THEN 'max_documents' END) AS skip_reason FROM s
""")
def index_filter_reasons(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    cases = [(F.col("lang") != "en", "language"), (F.col("n_chars") < 200, "too_short"), (F.col("source") == "src0", "source")]
    return with_reasons(docs.select("doc_id", "lang", "n_chars", "source"), cases, ["doc_id"], at_most=100).select("doc_id", "skip_reason")


MARKERS = {"english": ["the", "and", "of", "to", "with", "from", "that"], "french": ["le", "la", "et", "de", "des", "un", "en"]}


@query("""
    WITH p AS (SELECT doc_id, ' ' || lower(text) || ' ' AS t FROM documents),
    c AS (
        SELECT doc_id, len(list_filter(['the','and','of','to','with','from','that'], lambda m: contains(t, ' ' || m || ' '))) AS e,
               len(list_filter(['le','la','et','de','des','un','en'], lambda m: contains(t, ' ' || m || ' '))) AS f FROM p
    )
    SELECT doc_id, CASE WHEN e > f THEN 'english' WHEN f > e THEN 'french' ELSE 'unknown' END AS language FROM c
""")
def language_vote(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", marker_vote(F.col("text"), MARKERS).alias("language"))


CATALOG = {"licence": ["rights reserved", "license", "licence"], "secret": ["password", "token", "secret"], "contact": ["@", "call", "phone"], "insult": ["idiot", "stupid", "scum"]}


@query("""
    WITH c AS (
        SELECT doc_id, [len(list_filter(['rights reserved','license','licence'], lambda k: contains(lower(text), k))), len(list_filter(['password','token','secret'], lambda k: contains(lower(text), k))),
                        len(list_filter(['@','call','phone'], lambda k: contains(lower(text), k))), len(list_filter(['idiot','stupid','scum'], lambda k: contains(lower(text), k)))] AS n
        FROM documents
    )
    SELECT doc_id, CASE WHEN list_max(n) = 0 THEN 'general' ELSE ['licence','secret','contact','insult'][list_position(n, list_max(n))] END AS category FROM c
""")
def keyword_category(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", first_best(F.lower("text"), CATALOG).alias("category"))


@query("""
    SELECT doc_id, md5(trim(regexp_replace(strip_accents(lower(text)), '[^a-z0-9]+', ' ', 'g'))) AS normalized_md5, 'doc_' || substr(md5(doc_id || '|' || source), 1, 20) AS ident,
           CASE WHEN length(replace(text, chr(10), ' ')) <= 60 THEN replace(text, chr(10), ' ') ELSE substr(replace(text, chr(10), ' '), 1, 57) || '...' END AS shown
    FROM documents
""")
def text_normalization(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.md5(normalize(F.col("text"))).alias("normalized_md5"), hash_id("doc_", F.col("doc_id"), F.col("source")).alias("ident"), display(F.col("text"), 60).alias("shown"))


@query("SELECT p_partkey, replace(trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')), ' ', '-') AS slug FROM part")
def part_slugs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", slug(F.col("p_name")).alias("slug"))


@query("""
    WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents), n AS (SELECT doc_id, lower(trim(regexp_replace(line, '[0-9]', '#', 'g'))) AS norm_line FROM l)
    SELECT norm_line, count(DISTINCT doc_id) AS pages FROM n WHERE norm_line <> '' GROUP BY 1 HAVING count(DISTINCT doc_id) >= 2
""")
def repeated_lines(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines_on_pages(lines, "doc_id", "line")


@query("""
    SELECT role, count(*) AS blocks, round(avg(length(text)), 6) AS mean_length, CAST(median(length(text)) AS DOUBLE) AS median_length, count(*) / sum(count(*)) OVER () AS share
    FROM conversations GROUP BY role
""")
def block_statistics(spark: SparkSession, d: str) -> DataFrame:
    return statistics_of(table(spark, d, "conversations"), "role", "text").withColumn("mean_length", F.round("mean_length", 6))


@query("""
    WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
    SELECT doc_id, CAST(sum(length(line)) AS BIGINT) AS characters, count(*) AS blocks, count(*) FILTER (length(line) <= 90) AS titles, count(*) FILTER (regexp_matches(line, '[0-9]\\s*$')) AS ending_in_number,
           sum(length(line)) < 100 AS low_text, count(*) FILTER (length(line) <= 90) >= 8 AND count(*) FILTER (regexp_matches(line, '[0-9]\\s*$')) >= 5 AS contents_like,
           count(*) FILTER (length(line) <= 90) > 0.6 * count(*) AS title_dense
    FROM l GROUP BY doc_id
""".replace("\\\\", "\\"))
def page_diagnostics(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return diagnostics_of(lines, ["doc_id"], "line", F.length("line") <= 90)


#: Links and their titles, by one pattern in both engines; each link is made whole by its page's address.
@query(r"""
    WITH l AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>', 1)) AS href FROM pages),
    h AS (
        SELECT DISTINCT page_id, CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href WHEN starts_with(href, '//') THEN split_part(url, ':', 1) || ':' || href
               WHEN starts_with(href, '/') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || href ELSE 'elsewhere:' || href END AS link FROM l
    )
    SELECT regexp_replace(lower(regexp_extract(link, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\.', '') AS domain, count(*) AS links, count(DISTINCT page_id) AS pages FROM h WHERE link <> '' GROUP BY 1
""")
def url_domain_counts(spark: SparkSession, d: str) -> DataFrame:
    links = page_links(table(spark, d, "pages"), "page_id", "url", "html")
    return links.groupBy("domain").agg(F.count(F.lit(1)).alias("links"), F.count_distinct("page_id").alias("pages"))


HITS = [
    "Annual Report 2024", "Universal registration document of {c} 2023", "{c} climate report 2024", "Notice of meeting 2024 report", "Half year report", "{c} carbon news 2019 and 2024", "sbti targets of {c}", "presentation", "{c} integrated report 2024", "weather",
]
FOLDERS = ["http://example.com/annual-report.pdf", "https://www.{c}.com/docs/report_2024.pdf?x=1", "https://{c}.com/investors", "http://scribd.com/doc/annual report.pdf", "https://cdn.other.org/climate-report-2024.pdf"]

#: Rules of one family of each kind, small enough to be written out in SQL.
SCORED = Family("annual", strong=["annual report", "universal registration document"], secondary=["integrated report"], weak=["report"], points=POINTS["annual"], penalties={"notice": (["notice of meeting"], -50, 55)}, low_trust=["scribd.com"])


def _search_hits(spark: SparkSession, d: str) -> DataFrame:
    """Search hits for each customer's company: a title and an address by the order's number."""
    pick = lambda items, by: F.element_at(F.array(*map(F.lit, items)), (by % len(items) + 1).cast("int"))
    company = F.concat(F.lit("firm"), (F.col("o_custkey") % 50).cast("string"))
    named = lambda c: F.replace(c, F.lit("{c}"), company)
    rows = table(spark, d, "orders").select("o_orderkey", company.alias("company"), named(pick(HITS, F.col("o_orderkey"))).alias("title"), named(pick(FOLDERS, F.col("o_custkey") + F.col("o_orderkey"))).alias("url"))
    return rows.withColumns({"snippet": F.lit(""), "domain": domain(F.col("url")), "official_domain": F.concat("company", F.lit(".com")), "fiscal_year": F.lit(2024)})


@query(rf"""
    WITH h AS (
        SELECT o_orderkey, 'firm' || (o_custkey % 50) AS c, replace([{', '.join("'" + x + "'" for x in HITS)}][o_orderkey % {len(HITS)} + 1], '{{c}}', 'firm' || (o_custkey % 50)) AS title,
               replace([{', '.join("'" + x + "'" for x in FOLDERS)}][(o_custkey + o_orderkey) % {len(FOLDERS)} + 1], '{{c}}', 'firm' || (o_custkey % 50)) AS url FROM orders
    ),
    f AS (
        SELECT *, ' ' || trim(regexp_replace(lower(title || ' ' || regexp_extract(url, '^[a-z]+://[^/?#]*([^#]*)', 1)), '[^a-z0-9]+', ' ', 'g')) || ' ' AS t, regexp_replace(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), '^www\.', '') AS dom,
               contains(title || ' ' || url, c) AS company, contains(title || url, '2024') AS y24, regexp_matches(title || ' ' || url, '\b(19|20)[0-9][0-9]\b') AS dated, contains(lower(url), '.pdf') AS pdf FROM h
    ),
    k AS (
        SELECT *, contains(t, 'annual report') OR contains(t, 'universal registration document') AS strong, contains(t, 'integrated report') AS second, contains(t, 'report') AS weak0, contains(t, 'notice of meeting') AS notice,
               dom = c || '.com' AS official, regexp_matches(title || ' ' || url, '\b2024\b') AS wanted, pdf AND (contains(url, 'annual-report.pdf') OR contains(url, 'annual report.pdf')) AS named FROM f
    ),
    s AS (
        SELECT *, weak0 AND NOT strong AS weak, wanted::INT * 30 + (NOT wanted AND dated)::INT * -35 + (NOT dated)::INT * -5 + strong::INT * 30 + (weak0 AND NOT strong)::INT * 15 + (NOT strong AND NOT second AND NOT weak0)::INT * -20
               + company::INT * 20 + (NOT company)::INT * -30 + official::INT * 20 + pdf::INT * 12 + (NOT pdf)::INT * -8 + named::INT * 15 + (dom = 'scribd.com')::INT * -45 + notice::INT * -50 AS total FROM k
    ),
    z AS (SELECT *, greatest(0, least(total, CASE WHEN notice THEN 55 ELSE 100 END, CASE WHEN NOT strong AND NOT second AND NOT weak THEN 59 ELSE 100 END)) AS score FROM s)
    SELECT o_orderkey, CAST(score AS DOUBLE) AS score, CASE WHEN NOT (strong OR second) OR score < 60 THEN 'reject' WHEN NOT pdf THEN 'pdf_resolution_required' WHEN score >= 80 THEN 'auto_download' ELSE 'human_review_required' END AS decision FROM z
""")
def candidate_score(spark: SparkSession, d: str) -> DataFrame:
    return score(_search_hits(spark, d), SCORED).select("o_orderkey", "score", "decision")


@query()
def candidate_score_families(spark: SparkSession, d: str) -> DataFrame:
    """Every family with its own lists over the same hits: tested against a plain loop."""
    return scored_by_all(_search_hits(spark, d), FAMILIES).select("family", "o_orderkey", "score", "decision")
