"""Queries that run the rules for headings, targets and visuals over every line of the text tables; the SQL states each
rule itself, over the same lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import MARKED, PLAIN, first_case
from ..operators import artifacts as A, audits as Q, blocks as B, document_checks as K, metrics as M
from .registry import query, table

#: What counts as white space, and the sides of a word, in the oracle's regular expressions.
WHITE = r"[\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
LEFT, RIGHT = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"
KEY = ["src", "ident", "part", "line"]


def text_lines(spark: SparkSession, d: str) -> DataFrame:
    """src, ident, part, line, text: lines of documents and of turns, and the headings of pages."""
    rows = lambda name, src, ident, part, split: table(spark, d, name).select(F.lit(src).alias("src"), F.col(ident).alias("ident"), part.cast("int").alias("part"), F.posexplode(split).alias("line", "text"))
    split = F.split("text", r"\r?\n")
    return (
        rows("documents", "document", "doc_id", F.lit(0), split)
        .unionByName(rows("conversations", "turn", "conv_id", F.col("turn"), split))
        .unionByName(rows("pages", "page", "page_id", F.lit(0), F.regexp_extract_all("html", F.lit("<h1[^>]*>([^<]*)</h1>"), 1)))
    )


def _kind(text: Column) -> Column:
    """Headings of pages are titles; a line is a list item or a caption by its form, else what its letters say."""
    return first_case((F.col("src") == "page", "title"), (B.is_list_item(text), "list_item"), (B.is_caption(text), "caption"), otherwise=B.block_class(text))


def quoted(items: list[str]) -> str:
    return ", ".join("'" + x.replace("'", "''") + "'" for x in items)


def contains_of(column: str, items: list[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, {quoted([x])})" for x in items) + ")"


def _whole(pattern: str) -> str:
    return LEFT + pattern.removeprefix(r"\b").removesuffix(r"\b") + RIGHT


_LIST = r"'^[-*•–] +|^[0-9]+[.)] +|^\([a-zA-Z]\) +|^[a-zA-Z]\) +'"
_CAPTION = r"'^(figure|fig\.|table|exhibit|chart|graph|tableau|graphique) +[0-9]+'"
_SPLIT = "string_split(replace(text, chr(13) || chr(10), chr(10)), chr(10))"

LINE_ROWS = f"""
    p AS (
        SELECT 'document' AS src, doc_id AS ident, 0 AS part, {_SPLIT} AS ls FROM documents UNION ALL SELECT 'turn', conv_id, turn, {_SPLIT} FROM conversations
        UNION ALL SELECT 'page', page_id, 0, regexp_extract_all(html, '<h1[^>]*>([^<]*)</h1>', 1) FROM pages
    ), h AS (SELECT src, ident, part, CAST(unnest(range(len(ls))) AS INT) AS line, unnest(ls) AS text FROM p)
"""


def _measured(rows: str = "h") -> str:
    """The measures that the rules for headings ask for, of the lines in a table."""
    return rf"""
    c AS (SELECT *, trim(regexp_replace(text, '{WHITE}', ' ', 'g')) AS t FROM {rows}),
    n AS (
        SELECT *, translate(lower(t), '{MARKED}', '{PLAIN}') AS m, length(t) AS size, length(regexp_replace(t, '[^\p{{L}}]', '', 'g')) AS letters, length(regexp_replace(t, '[^\p{{Lu}}]', '', 'g')) AS capitals,
               length(regexp_replace(t, '[^\p{{Nd}}]', '', 'g')) AS digits, length(regexp_replace(t, '[^%]', '', 'g')) AS percents, regexp_extract_all(t, '\b(1[0-9][0-9]{{2}}|20[0-9]{{2}})\b', 1) AS years FROM c
    ), b AS (
        SELECT *, CASE WHEN letters > 0 THEN capitals / letters ELSE 0 END AS upper, CASE WHEN letters + digits > 0 THEN digits / (letters + digits) END AS share,
               CASE WHEN src = 'page' THEN 'title' WHEN regexp_matches(t, {_LIST}) THEN 'list_item' WHEN regexp_matches(lower(t), {_CAPTION}) THEN 'caption' WHEN t = '' THEN 'unknown'
               WHEN size <= 90 AND (CASE WHEN letters > 0 THEN capitals / letters ELSE 0 END > 0.75 OR regexp_matches(t, '^\p{{Nd}}{{2}}')) THEN 'title' ELSE 'paragraph' END AS kind FROM n
    )"""


_SECTION = "CASE " + " ".join(f"WHEN {' OR '.join(f'regexp_matches(m, {quoted([_whole(p)])})' for p in patterns)} THEN '{name}'" for name, patterns in B.SECTION_TYPES.items()) + " ELSE 'unknown' END"

_STATUS = rf"""
    f AS (
        SELECT *, {_SECTION} AS section_type,
               t = '' OR regexp_matches(t, '^[0-9 ,.\-%€$£()A-Za-z]{{1,40}}$') AND digits > 0 AND len(list_filter(regexp_extract_all(lower(t), '[a-z]+'), lambda w: w NOT IN ({quoted(B.NUMBER_WORDS)}))) = 0
                   OR regexp_matches(regexp_replace(t, '[ ,.\-%€$£()]', '', 'g'), '^\p{{Nd}}+$') OR coalesce(share > 0.65, false) AS number_like,
               regexp_matches(t, '^(1[0-9][0-9]{{2}}|20[0-9]{{2}}) +[A-Z][A-Za-zÀ-ÖØ-öø-ÿ''’.-]+') AND NOT regexp_matches(lower(t), '{_whole("(highlights?|results?|performance)")}') OR len(years) >= 2 OR {contains_of("lower(t)", ["century", "siècle", "siecle"])}
                   OR size > 45 AND digits / greatest(size, 1) > 0.18 AND len(years) > 0 AS timeline,
               regexp_matches(m, '^\((from|as of|at|for|since)([^\p{{L}}\p{{N}}_].*)?\)$|^(of|as of|from|for|and|or|the){RIGHT}|^(companies|company|group)$') AS fragment,
               t <> '' AND (m IN ('lvmh', 'other holding', 'companies') OR percents >= 2 OR size <= 70 AND list_has_any(regexp_extract_all(m, '[a-z0-9]+'), [{quoted(B.CHART_WORDS)}])
                   OR size <= 24 AND upper > 0.85 AND NOT regexp_matches(m, '{_whole("(risk|climate|social|governance|environment|financial|highlights|overview|business)")}')) AS org_chart,
               percents >= 2 OR len(years) >= 2 AND len(string_split(t, ' ')) <= 10 AS diagram,
               t <> '' AND NOT {contains_of("m", B.SURE_TITLES)} AND (size > 35 AND (regexp_matches(t, '^[0-9][0-9,. ]* +[a-zA-Z]') OR contains(t, '.')) OR size > 45 AND list_has_any(regexp_extract_all(m, '[a-z]+'), [{quoted(B.VERBS)}])) AS sentence
        FROM b
    ), g AS (
        SELECT *, greatest(0.0, least(1.0, round(0.5 + CASE WHEN upper >= 0.65 AND size BETWEEN 4 AND 120 THEN 0.12 ELSE 0 END + CASE WHEN section_type <> 'unknown' THEN 0.18 ELSE 0 END
               - CASE WHEN length(text) < 8 THEN 0.15 ELSE 0 END - CASE WHEN fragment THEN 0.25 ELSE 0 END - CASE WHEN sentence THEN 0.25 ELSE 0 END, 6))) AS score FROM f
    ), s AS (
        SELECT *, CASE WHEN kind = 'caption' THEN 'rejected_structural_block' WHEN kind = 'list_item' THEN 'rejected_list_item' WHEN kind <> 'title' THEN 'rejected_low_confidence' WHEN trim(text) = '' THEN 'rejected_too_short'
               WHEN m IN ({quoted(B.CONTENTS_TITLES)}) THEN 'rejected_toc_heading' WHEN m IN ({quoted(B.DOCUMENT_TITLES)}) THEN 'rejected_document_title' WHEN contains(m, 'fiscal year ended') THEN 'rejected_front_matter'
               WHEN length(trim(text)) < 4 THEN 'rejected_too_short' WHEN number_like THEN 'rejected_numeric_value' WHEN coalesce(share > 0.45, true) THEN 'rejected_too_numeric' WHEN timeline THEN 'rejected_timeline_like'
               WHEN fragment THEN 'rejected_heading_fragment' WHEN org_chart THEN 'rejected_org_chart_like' WHEN diagram THEN 'rejected_diagram_like' WHEN sentence THEN 'rejected_sentence_like_heading'
               WHEN score < 0.45 THEN 'rejected_low_confidence' ELSE 'accepted' END AS status FROM g
    )"""


@query(rf"""
    WITH {LINE_ROWS}, {_measured()}
    SELECT src, ident, part, line, kind, regexp_matches(t, {_LIST}) AS is_list, regexp_matches(lower(t), {_CAPTION}) AS is_caption, regexp_matches(t, '(^| )\.*[0-9]+\.*$') AS ends_with_number,
           regexp_matches(t, '(^| )\.*[0-9]+\.*$') OR regexp_matches(t, '^[A-Z][A-Z0-9 ,&''/-]{{4,}} +[0-9]+$') AS is_contents_entry, size >= 25 AND regexp_matches(t, '^\(([0-9]+|[a-zA-Z])\) +[^ ]|^\* +[^ ]') AS is_footnote, {contains_of("lower(t)", B.FOOTER_LABELS)} AS is_label
    FROM b
""")
def block_predicates(spark: SparkSession, d: str) -> DataFrame:
    """Every line of documents and turns, and every heading of pages."""
    x = F.col("text")
    return text_lines(spark, d).select(
        *KEY, _kind(x).alias("kind"), B.is_list_item(x).alias("is_list"), B.is_caption(x).alias("is_caption"), B.ends_with_number(x).alias("ends_with_number"), B.is_contents_entry(x).alias("is_contents_entry"),
        B.is_footnote(x).alias("is_footnote"), B.is_footer_label(x).alias("is_label"),
    )


@query(f"WITH {LINE_ROWS}, {_measured()} SELECT src, ident, part, line, {_SECTION} AS section_type FROM b")
def section_classes(spark: SparkSession, d: str) -> DataFrame:
    """All 24 types are tried on every line."""
    return text_lines(spark, d).select(*KEY, B.section_class(F.col("text")).alias("section_type"))


def _statuses(rows: DataFrame) -> DataFrame:
    return rows.withColumn("status", B.heading_status(F.col("text"), F.col("kind"), F.lit(0.5)))


@query(f"WITH {LINE_ROWS}, {_measured()}, {_STATUS} SELECT src, ident, part, line, status, CASE WHEN kind = 'title' THEN CAST(score AS DOUBLE) END AS score FROM s")
def heading_statuses(spark: SparkSession, d: str) -> DataFrame:
    """The status of every line; scores of titles."""
    rows = text_lines(spark, d).withColumn("kind", _kind(F.col("text")))
    return _statuses(rows).select(*KEY, "status", F.when(F.col("kind") == "title", B.heading_score(F.col("text"), F.lit(0.5))).alias("score"))


@query(f"""
    WITH {LINE_ROWS}, {_measured()}, {_STATUS}, k AS (SELECT status FROM s WHERE kind = 'title')
    SELECT check_name, n, 'info' AS severity, 'needs_review' AS status FROM (
        SELECT unnest(['section_candidates_detected', 'section_candidates_rejected', 'section_front_matter_rejected', 'section_numeric_values_rejected', 'section_timeline_like_rejected', 'heading_fragments_rejected', 'org_chart_like_headings_rejected',
                       'sentence_like_headings_rejected', 'section_candidate_score_threshold_applied', 'merged_headings_created']) AS check_name,
               unnest([count(*), count(*) FILTER (status <> 'accepted'), count(*) FILTER (status IN ('rejected_front_matter', 'rejected_toc_heading', 'rejected_document_title')), count(*) FILTER (status IN ('rejected_numeric_value', 'rejected_too_numeric')),
                       count(*) FILTER (status = 'rejected_timeline_like'), count(*) FILTER (status = 'rejected_heading_fragment'), count(*) FILTER (status IN ('rejected_org_chart_like', 'rejected_diagram_like')),
                       count(*) FILTER (status = 'rejected_sentence_like_heading'), count(*) FILTER (status = 'rejected_low_confidence'), 0]) AS n FROM k)
""")
def heading_checks(spark: SparkSession, d: str) -> DataFrame:
    rows = text_lines(spark, d).withColumn("kind", _kind(F.col("text"))).filter("kind = 'title'")
    return Q.audit(_statuses(rows).select("status", F.lit(False).alias("was_merged")), K.candidate_rules())


@query(f"""
    WITH h AS (SELECT doc_id, CAST(unnest(range(len(ls))) AS INT) AS line, unnest(ls) AS text, 'page' AS src FROM (SELECT doc_id, string_split(replace(text, ', ', ',' || chr(10)), chr(10)) AS ls FROM documents)),
    short AS (SELECT * FROM h WHERE length(text) <= 90), {_measured("short")}, {_STATUS},
    x AS (SELECT *, lead(text) OVER w AS after, lead(status) OVER w AS next_status, lead(line) OVER w AS next_line, lead(org_chart OR number_like) OVER w AS next_odd, lead(fragment) OVER w AS next_fragment FROM s WINDOW w AS (PARTITION BY doc_id ORDER BY line)),
    y AS (
        SELECT *, coalesce(status = 'accepted' AND next_status = 'accepted' AND next_line = line + 1 AND NOT org_chart AND NOT number_like AND NOT next_odd AND (regexp_matches(trim(text), '[,;:]$') OR next_fragment), false) AS pair,
               row_number() OVER (PARTITION BY doc_id ORDER BY line) AS pos FROM x
    ), r AS (SELECT *, pos - coalesce(max(CASE WHEN NOT pair THEN pos END) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING), 0) AS run FROM y),
    k AS (SELECT *, pair AND run % 2 = 1 AS takes FROM r), z AS (SELECT *, coalesce(lag(takes) OVER (PARTITION BY doc_id ORDER BY pos), false) AS taken FROM k)
    SELECT doc_id, line, CASE WHEN takes THEN replace(trim(regexp_replace(trim(text) || ' ' || trim(after), '{WHITE}', ' ', 'g')), ' ,', ',') ELSE trim(text) END AS heading_text, takes AS was_merged,
           CASE WHEN taken THEN 'rejected_heading_fragment' ELSE status END AS status FROM z
""")
def merged_headings(spark: SparkSession, d: str) -> DataFrame:
    """Clauses of up to 90 characters, that is lines cut behind commas too, stand for titles, so that headings which go on exist."""
    parts = F.split(F.replace(F.col("text"), F.lit(", "), F.lit(",\n")), "\n")
    rows = table(spark, d, "documents").select("doc_id", F.posexplode(parts).alias("line", "text")).filter(F.length("text") <= 90)
    rows = _statuses(rows.withColumns({"page": F.lit(1), "kind": F.lit("title")}))
    return B.merged_headings(rows, "doc_id", "page", "line", "text", "status").select("doc_id", "line", "heading_text", "was_merged", "status")


_NAMED = "CASE " + " ".join(f"WHEN contains(l, {quoted([word])}) THEN {quoted([name])}" for word, name in M.STANDARDS) + " END"
_PLACE = "CASE " + " ".join(f"WHEN contains(l, {quoted([word])}) THEN {quoted([name])}" for word, name in M.GEOGRAPHIES) + " END"
_WITHIN = "CASE " + " ".join(f"WHEN contains(l, {quoted([word])}) THEN {quoted([name])}" for word, name in M.BOUNDARIES) + " END"


@query(rf"""
    WITH {LINE_ROWS}, y AS (SELECT o_custkey, min(year(o_orderdate)) AS first_year FROM orders GROUP BY 1),
    a AS (
        SELECT src, ident, part, line, text FROM h UNION ALL
        SELECT 'order', o_orderkey, 0, 0, concat_ws(' ', r_name, lower(c_mktsegment), 'revenue', CASE WHEN o_orderstatus = 'F' THEN 'of the group by' ELSE 'in' END, year(o_orderdate) + 30, 'reference year', first_year)
        FROM orders JOIN y USING (o_custkey) LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
    ), q AS (SELECT *, lower(text) AS l, regexp_extract(text, '(?i)\bby\s+(20[0-4][0-9])\b', 1) AS goal, regexp_extract_all(text, '\b((?:19|20)[0-9]{{2}})\b', 1) AS ys FROM a)
    SELECT src, ident, part, line, coalesce(nullif(goal, ''), ys[-1]) AS target_year, nullif(regexp_extract(l, '(?:baseline|base year|reference year)[^0-9]{{0,40}}((?:19|20)[0-9]{{2}})', 1), '') AS baseline_year,
           contains(l, 'target') OR goal <> '' AS is_target, {_NAMED} AS standard, {_PLACE} AS geography, {_WITHIN} AS boundary,
           CASE WHEN contains(l, 'scope 1') THEN 'scope_1_emissions' WHEN contains(l, 'scope 2') THEN 'scope_2_emissions' WHEN contains(l, 'scope 3') THEN 'scope_3_emissions' WHEN contains(l, 'revenue') THEN 'revenue' ELSE 'unknown_metric' END AS metric_key FROM q
""")
def target_facts(spark: SparkSession, d: str) -> DataFrame:
    """Every line, and what each order says of itself: its region, segment, year and the year of its customer's first order."""
    orders = table(spark, d, "orders")
    first = orders.groupBy("o_custkey").agg(F.min(F.year("o_orderdate")).alias("first_year"))
    place = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    goal = F.when(F.col("o_orderstatus") == "F", F.lit("of the group by")).otherwise(F.lit("in"))
    said = F.concat_ws(" ", "r_name", F.lower("c_mktsegment"), F.lit("revenue"), goal, (F.year("o_orderdate") + 30).cast("string"), F.lit("reference year"), F.col("first_year").cast("string"))
    told = orders.join(first, "o_custkey").join(place, F.col("o_custkey") == F.col("c_custkey"), "left").select(F.lit("order").alias("src"), F.col("o_orderkey").alias("ident"), F.lit(0).alias("part"), F.lit(0).alias("line"), said.alias("text"))
    x = F.col("text")
    return text_lines(spark, d).unionByName(told).select(
        *KEY, M.target_year(x).alias("target_year"), M.baseline_year(x).alias("baseline_year"), M.is_target(x, F.lower(x).contains("target")).alias("is_target"), M.first_token(x, M.STANDARDS).alias("standard"),
        M.first_token(x, M.GEOGRAPHIES).alias("geography"), M.first_token(x, M.BOUNDARIES).alias("boundary"), M.metric_key(x, F.lit("general")).alias("metric_key"),
    )


_VISUAL = "CASE WHEN contains(l, 'cover') OR line = 1 THEN 'logo_or_cover' " + " ".join(f"WHEN {contains_of('l', words)} THEN '{name}'" for name, words in A.VISUAL_WORDS.items()) + " ELSE 'unknown_visual' END"


@query(rf"""
    WITH {LINE_ROWS}, q AS (SELECT *, lower(text) AS l FROM h), v AS (SELECT *, {_VISUAL} AS visual_type FROM q)
    SELECT src, ident, part, line, visual_type, CAST(CASE visual_type WHEN 'logo_or_cover' THEN 0.85 WHEN 'unknown_visual' THEN 0.25 ELSE 0.55 END AS DOUBLE) AS confidence,
           CASE WHEN regexp_matches(l, '{_whole("(target|objective|net.zero)")}|{LEFT}by\s+20[0-4][0-9]{RIGHT}') THEN 'visual_target_candidate' WHEN regexp_matches(l, '[0-9]') THEN 'visual_metric_candidate' WHEN regexp_matches(l, '{_whole("risk")}') THEN 'visual_risk_evidence'
           WHEN regexp_matches(l, '{_whole("(policy|commitment|engagement)")}') THEN 'visual_policy_evidence' ELSE 'visual_context_evidence' END AS information_type FROM v
""")
def visual_types(spark: SparkSession, d: str) -> DataFrame:
    """Every line as the text of a visual; the second line of a text stands on a cover, and its first number is a value."""
    x = F.col("text")
    v = A.visual_type(x, F.col("line"))
    return text_lines(spark, d).select(*KEY, v.alias("v"), A.visual_information(x, F.regexp_extract(x, "[0-9]+", 0)).alias("information_type")).select(*KEY, F.col("v.type").alias("visual_type"), "v.confidence", "information_type")
