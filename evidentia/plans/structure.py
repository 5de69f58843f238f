"""Queries over ordered rows, tables and retrieval. Conversations stand for documents of blocks, line items for cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import documents as D, retrieval as R, tables as M
from ..operators.candidates import similar_components
from ..operators.grams import contained_labels
from ..operators.postings import postings_topk
from ..streaming.ingest import windowed_counts
from .paths import retrieval_path
from .registry import query, table


@query("""
    WITH b AS (SELECT conv_id, turn, CASE WHEN length(text) < 120 AND lag(length(text)) OVER (PARTITION BY conv_id ORDER BY turn) < 120 THEN 0 ELSE 1 END AS br FROM conversations),
    i AS (SELECT conv_id, turn, CAST(sum(br) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM b)
    SELECT conv_id, island, count(*) AS turns, min(turn) AS first_turn FROM i GROUP BY 1, 2
""")
def paragraph_islands(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql.window import Window

    before = F.lag(F.length("text")).over(Window.partitionBy("conv_id").orderBy("turn"))
    out = D.islands(table(spark, d, "conversations"), ["conv_id"], "turn", ~F.coalesce((F.length("text") < 120) & (before < 120), F.lit(False)))
    return out.groupBy("conv_id", "island").agg(F.count(F.lit(1)).alias("turns"), F.min("turn").alias("first_turn"))


@query()
def merged_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """Stateful: tested against a plain loop."""
    return D.merge_paragraphs(table(spark, d, "conversations").select("conv_id", "turn", "text"), "conv_id", "turn", "text")


@query()
def text_segments(spark: SparkSession, d: str) -> DataFrame:
    """Stateful: tested against a plain loop."""
    return D.segments(table(spark, d, "conversations").select("conv_id", "turn", "text"), "conv_id", "turn", "text", 1500).select("conv_id", "turn", "segment")


def _sections(spark: SparkSession, d: str) -> DataFrame:
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role")
    last = turns.groupBy("conv_id").agg(F.max("turn").alias("last_turn"))
    heads = turns.filter("role = 'user'").join(last, "conv_id").withColumn("start_order", F.col("turn"))
    return D.section_ranges(heads, "conv_id", "turn", "start_order", "last_turn").select("conv_id", F.col("turn").alias("page_start"), "page_end", "start_order", "end_order")


SECTIONS = """
    turns AS (SELECT conv_id, turn, role, max(turn) OVER (PARTITION BY conv_id) AS last_turn FROM conversations),
    sections AS (
        SELECT conv_id, turn AS page_start, CASE WHEN n IS NULL THEN last_turn ELSE greatest(turn, n - 1) END AS page_end, turn AS start_order, n AS end_order
        FROM (SELECT *, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM turns WHERE role = 'user')
        WHERE CASE WHEN n IS NULL THEN last_turn ELSE greatest(turn, n - 1) END >= turn
    )
"""


@query(f"WITH {SECTIONS} SELECT * FROM sections")
def section_ranges(spark: SparkSession, d: str) -> DataFrame:
    return _sections(spark, d)


@query(f"""
    WITH {SECTIONS}
    SELECT t.conv_id, t.turn, max(s.page_start) AS section FROM turns t LEFT JOIN sections s ON s.conv_id = t.conv_id AND t.turn BETWEEN s.page_start AND s.page_end GROUP BY 1, 2
""")
def page_in_section(spark: SparkSession, d: str) -> DataFrame:
    turns = table(spark, d, "conversations").select("conv_id", "turn").distinct()
    return D.page_to_section(turns, _sections(spark, d).withColumn("section", F.col("page_start")), "conv_id", "turn", "page_start", "page_end", "section")


@query(f"""
    WITH {SECTIONS},
    m AS (
        SELECT t.conv_id, t.turn, s.page_start AS section,
               CASE WHEN t.turn >= s.start_order AND s.end_order IS NOT NULL AND t.turn < s.end_order THEN 0.92 WHEN t.turn >= s.start_order AND s.end_order IS NULL THEN 0.88 WHEN s.page_start IS NOT NULL THEN 0.65 END AS c
        FROM turns t LEFT JOIN sections s ON s.conv_id = t.conv_id AND t.turn BETWEEN s.page_start AND s.page_end
    ),
    r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY c DESC NULLS LAST, section NULLS LAST) AS rn FROM m)
    SELECT conv_id, turn, section, CAST(c AS DOUBLE) AS section_confidence FROM r WHERE rn = 1
""")
def block_in_section(spark: SparkSession, d: str) -> DataFrame:
    turns = table(spark, d, "conversations").select("conv_id", "turn").withColumn("ident", F.struct("conv_id", "turn"))
    return D.block_to_section(turns, _sections(spark, d).withColumn("section", F.col("page_start")), "conv_id", "ident", "turn", "turn", "section").drop("ident")


@query("""
    WITH e AS (SELECT event_id, user_id, event_type, epoch_us(ts) AS at FROM events),
    m AS (
        SELECT l.event_id, r.event_id AS other, abs(l.at - r.at) AS distance, row_number() OVER (PARTITION BY l.event_id ORDER BY abs(l.at - r.at), r.event_id) AS rn
        FROM e l JOIN e r ON l.user_id = r.user_id AND l.event_type = 'purchase' AND r.event_type <> 'purchase' AND abs(l.at - r.at) <= 3600000000
    )
    SELECT e.event_id, other, distance FROM e LEFT JOIN (SELECT * FROM m WHERE rn = 1) n ON n.event_id = e.event_id WHERE event_type = 'purchase'
""")
def nearest_entity(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    left = e.filter("event_type = 'purchase'").select("event_id", "user_id", "at")
    right = e.filter("event_type <> 'purchase'").select(F.col("event_id").alias("other"), "user_id", F.col("at").alias("other_at"))
    return D.nearest(left, right, ["user_id"], "event_id", "at", "other", "other_at", 3_600_000_000).select("event_id", "other", "distance")


@query("""
    SELECT o_orderkey, max(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 3 PRECEDING AND 5 FOLLOWING) AS context_max FROM orders
""")
def context_window_max(spark: SparkSession, d: str) -> DataFrame:
    return D.window_max(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice").select("o_orderkey", "context_max")


@query("""
    SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END, lead(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)) AS value_or_next FROM orders
""")
def adjacent_fallback(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").withColumn("v", F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")))
    return D.or_next(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], "v").select("o_orderkey", "value_or_next")


@query("SELECT role, conv_id, turn, sample FROM (SELECT *, row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) AS sample FROM conversations) WHERE sample <= 5")
def role_samples(spark: SparkSession, d: str) -> DataFrame:
    return D.samples(table(spark, d, "conversations"), ["role"], ["conv_id", "turn"], 5).select("role", "conv_id", "turn", "sample")


@query("""
    WITH t AS (SELECT conv_id, turn, lower(text) AS title FROM conversations)
    SELECT conv_id, turn, CASE WHEN regexp_matches(title, 'the|and') THEN 'english' WHEN regexp_matches(title, 'der|und') THEN 'german' ELSE 'unknown' END AS section_type,
           CAST(CASE WHEN regexp_matches(title, 'the|and|der|und') THEN 0.75 ELSE 0.25 END AS DOUBLE) AS confidence FROM t
""")
def section_types_of_whole_texts(spark: SparkSession, d: str) -> DataFrame:
    kind = D.section_type(F.lower("text"), {"english": "the|and", "german": "der|und"})
    return table(spark, d, "conversations").select("conv_id", "turn", kind.alias("k")).select("conv_id", "turn", F.col("k.type").alias("section_type"), F.col("k.confidence").alias("confidence"))


#: Lines of tables that one task sorts, about; some tens of MB.
TASK_LINES = 250_000


def _cells(spark: SparkSession, d: str) -> DataFrame:
    """A table for each order: a row for each line, in order, and four columns; row 0 and column 0 hold words.

    Dealt out by order once, into as many parts as keep a part's sort in memory. The first line of an order also gives its
    heads, so that no union hides how the cells are dealt out, and what groups them by order needs no other shuffle.
    """
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-lines.count() // TASK_LINES))
    lines = M.positions(lines.repartition(parts, "l_orderkey"), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"], "row")
    texts = F.array(F.concat(F.lit("Part "), F.col("l_partkey").cast("string")), F.col("l_quantity").cast("int").cast("string"), F.col("l_returnflag"), F.col("l_linestatus"))
    heads = F.array(*map(F.lit, ("Item", "Quantity in 2024", "Flag", "Status")))
    of = lambda row, t: F.struct(row.cast("int").alias("row"), t.alias("texts"))
    rows = F.when(F.col("row") == 1, F.array(of(F.lit(0), heads), of(F.col("row"), texts))).otherwise(F.array(of(F.col("row"), texts)))
    body = lines.select("l_orderkey", F.explode(rows).alias("r")).select("l_orderkey", F.col("r.row").alias("row"), F.posexplode("r.texts").alias("column", "text"))
    return body.withColumn("pos", F.col("row") * 4 + F.col("column"))


CELLS = """
    lines AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS row, ['Part ' || l_partkey, CAST(CAST(l_quantity AS INT) AS VARCHAR), l_returnflag, l_linestatus] AS t FROM lineitem),
    every AS (SELECT l_orderkey, row, t FROM lines UNION ALL SELECT DISTINCT l_orderkey, 0, ['Item', 'Quantity in 2024', 'Flag', 'Status'] FROM lineitem)
"""


@query(f"""
    WITH {CELLS}
    SELECT l_orderkey, CAST(max(row) + 1 AS BIGINT) AS row_count, CAST(4 AS BIGINT) AS column_count, count(*) * 4 AS cell_count, 'reconstructed' AS status, string_agg(array_to_string(t, '|'), ';' ORDER BY row) AS grid FROM every GROUP BY 1
""")
def table_matrix_rebuild(spark: SparkSession, d: str) -> DataFrame:
    out = M.matrix(_cells(spark, d), "l_orderkey", "row", "column", "text", "pos")
    out = out.withColumn("grid", F.array_join(F.transform("grid", lambda r: F.array_join(r, "|")), ";"))
    return out.withColumns({"row_count": F.col("row_count").cast("long"), "column_count": F.col("column_count").cast("long")})


@query(f"""
    WITH {CELLS}, u AS (SELECT l_orderkey, row, unnest(t) AS text, unnest(range(4)) AS c FROM every),
    y AS (SELECT *, regexp_matches(text, '\\b(19|20)[0-9][0-9]\\b') AS year FROM u),
    k AS (SELECT l_orderkey, c, bool_or(year) AS year, count(*) FILTER (length(trim(text)) > 3 AND NOT regexp_matches(text, '[0-9]')) AS labels, count(*) AS rows FROM y GROUP BY 1, 2),
    r AS (SELECT l_orderkey, row, bool_or(year) AS year FROM y GROUP BY 1, 2),
    h AS (SELECT l_orderkey, coalesce(string_agg(CAST(row AS VARCHAR), ',' ORDER BY row) FILTER (year AND row < 5), '0') AS header_rows FROM r GROUP BY 1)
    SELECT l_orderkey, any_value(header_rows) AS header_rows, coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (year), '') AS year_columns, coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (labels * 4 >= rows), '') AS label_columns
    FROM k JOIN h USING (l_orderkey) GROUP BY 1
""")
def table_structure(spark: SparkSession, d: str) -> DataFrame:
    out = M.structure(_cells(spark, d), "l_orderkey", "row", "column", "text")
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return out.select("l_orderkey", *(text(c).alias(c) for c in ("header_rows", "year_columns", "label_columns")))


@query(f"""
    WITH {CELLS}
    SELECT l_orderkey, CAST(row AS INT) AS row, CAST(c AS INT) AS "column", t[c + 1] AS text, t[1] AS row_header, ['Item', 'Quantity in 2024', 'Flag', 'Status'][c + 1] AS column_header, CAST(0.45 AS DOUBLE) AS confidence, '2024' AS year
    FROM every CROSS JOIN (SELECT 1 AS c) WHERE row > 0
""")
def numeric_table_candidates(spark: SparkSession, d: str) -> DataFrame:
    cells = M.with_headers(_cells(spark, d), "l_orderkey", "row", "column", "text")
    none = F.lit(None).cast("string")
    out = M.numeric_cells(cells, "text", F.col("row") == 0, none, none, none, F.regexp_extract("column_header", r"\b(20\d\d)\b", 1))
    return out.select("l_orderkey", F.col("row").cast("int").alias("row"), F.col("column").cast("int").alias("column"), "text", "row_header", "column_header", "confidence", "year")


@query("""
    WITH c AS (SELECT l_suppkey, l_returnflag, count(*) AS n, min(l_orderkey) AS p FROM lineitem GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, p) AS rn FROM c)
    SELECT l_suppkey, l_returnflag, n FROM r WHERE rn = 1
""")
def column_unit_mode(spark: SparkSession, d: str) -> DataFrame:
    return M.dominant(table(spark, d, "lineitem").select("l_suppkey", "l_returnflag", "l_orderkey"), ["l_suppkey"], "l_returnflag", "l_orderkey")


@query(f"""
    WITH {CELLS}, u AS (SELECT l_orderkey, trim(unnest(t)) AS t FROM every)
    SELECT l_orderkey, count(*) AS cells, round(avg(CASE WHEN t = '' THEN 1.0 ELSE 0.0 END), 6) AS empty_ratio, round(avg(CASE WHEN length(t) BETWEEN 1 AND 2 THEN 1.0 ELSE 0.0 END), 6) AS fragmented_ratio,
           round(avg(CASE WHEN regexp_full_match(t, '-?[0-9., ]+%?') THEN 1.0 ELSE 0.0 END), 6) AS numeric_ratio FROM u GROUP BY 1
""")
def table_cell_quality(spark: SparkSession, d: str) -> DataFrame:
    out = M.cell_quality(_cells(spark, d), "l_orderkey", "text")
    return out.withColumns({c: F.round(c, 6) for c in ("empty_ratio", "fragmented_ratio", "numeric_ratio")})


TERMS = """
    w AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) AS token FROM documents),
    terms AS (SELECT doc_id, token, count(*) AS tf FROM w WHERE length(token) >= 2 GROUP BY 1, 2),
    n AS (SELECT count(*) AS n FROM documents),
    df AS (SELECT token, count(*) AS df FROM terms GROUP BY 1),
    vocab AS (
        SELECT token, df, ln((n + 1.0) / (df + 1.0)) + 1.0 AS idf FROM df, n WHERE df >= greatest(1, n // 1000)
        ORDER BY (df BETWEEN greatest(1, n // 1000) AND greatest(2, n // 2)) DESC, CASE WHEN df BETWEEN greatest(1, n // 1000) AND greatest(2, n // 2) THEN df END, df DESC, token LIMIT 512
    )
"""


@query(f"WITH {TERMS} SELECT token, df, round(idf, 6) AS idf FROM vocab")
def idf_table(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return R.vocabulary(R.distinct_tokens(docs, "doc_id", "text"), "doc_id", docs.count()).withColumn("idf", F.round("idf", 6))


@query(f"""
    WITH {TERMS}, len AS (SELECT doc_id, sum(tf) AS l FROM terms GROUP BY 1),
    x AS (SELECT doc_id, token, tf / l * idf AS w FROM terms JOIN vocab USING (token) JOIN len USING (doc_id)),
    y AS (SELECT doc_id, token, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM x),
    q AS (SELECT CAST(doc_id AS VARCHAR) AS query, token, weight AS qw FROM y WHERE doc_id % 20 = 0),
    s AS (SELECT query, doc_id, round(sum(weight * qw), 6) AS score FROM y JOIN q USING (token) GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id) AS rank FROM s)
    SELECT query, doc_id, score, CAST(rank AS INT) AS rank FROM r WHERE rank <= 20
""")
def lexical_topk(spark: SparkSession, d: str) -> DataFrame:
    """The whole vocabulary over whole texts. A stated query set, the documents whose id is divisible by 20, against all."""
    docs = table(spark, d, "documents")
    terms = R.tokens(docs, "doc_id", "text")
    weights = R.tfidf(terms, R.vocabulary(terms, "doc_id", docs.count()), "doc_id")
    queries = weights.filter("doc_id % 20 = 0").select(F.col("doc_id").cast("string").alias("query"), "token", "weight")
    return postings_topk(weights, queries, "doc_id", "query", 20)[0]


@query("""
    WITH q AS (SELECT label AS q, arg_min(embedding, vec_id) AS e, min(vec_id) AS query_id FROM embeddings GROUP BY 1),
    s AS (SELECT query_id, vec_id, round(list_cosine_similarity(CAST(e AS DOUBLE[]), CAST(embedding AS DOUBLE[])), 6) AS score FROM q CROSS JOIN embeddings),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    SELECT query_id, vec_id, score, CAST(rank AS INT) AS rank FROM r WHERE rank <= 10
""")
def dense_cosine_topk(spark: SparkSession, d: str) -> DataFrame:
    """One query for each label, of which there are few; all vectors are scored."""
    rows = table(spark, d, "embeddings")
    q = rows.groupBy("label").agg(F.min("vec_id").alias("query_id"), F.min_by("embedding", "vec_id").alias("e")).drop("label")
    scores = rows.crossJoin(F.broadcast(q)).select("query_id", "vec_id", F.round(R.cosine(F.col("e"), F.col("embedding")), 6).alias("score"))
    return R.top(scores, ["query_id"], [F.desc("score"), "vec_id"], 10)


HYBRID_TERMS = {"v1": ["the", "and", "of"], "v2": ["der", "und", "die"], "v3": ["que", "los", "las"]}


def document_catalog(spark: SparkSession, d: str) -> DataFrame:
    """The fixed variables, and two of the vocabulary's first tokens: fixed words may be outside the vocabulary."""
    docs = table(spark, d, "documents")
    found = [r.token for r in R.vocabulary(R.tokens(docs, "doc_id", "text"), "doc_id", docs.count()).orderBy(F.desc("idf"), "token").limit(16).collect()]
    fixed = [(v, terms, ["token", "%"], "governance", ["en"]) for v, terms in HYBRID_TERMS.items()]
    rare = [("rare1", found[:8], ["eur", "%"], "climate", ["en", "fr"]), ("rare2", found[8:], ["kwh"], "social", ["de"])]
    return spark.createDataFrame(fixed + rare, "variable_name string, terms array<string>, units array<string>, domain string, preferred array<string>")


@query()
def document_retrieval(spark: SparkSession, d: str) -> DataFrame:
    """The retrieval path over whole documents and the whole vocabulary; a document's source stands for its section, its
    language for its type. Tested against a plain loop."""
    docs = table(spark, d, "documents")
    places = docs.select(F.col("doc_id").cast("string").alias("document_id"), F.col("source").alias("section_id"), F.col("lang").alias("doc_type"))
    places = places.groupBy("document_id").agg(F.min("section_id").alias("section_id"), F.min("doc_type").alias("doc_type"))
    out = retrieval_path([("text", docs)], document_catalog(spark, d), "doc_id", "text", "doc_id", places=places, noise=R.NOISE)
    return out["retrieved"].select("variable_name", "document_id", "score", "rank")


@query("SELECT item_id FROM benchmark b WHERE EXISTS (SELECT 1 FROM documents d WHERE contains(d.text, b.text))")
def benchmark_containment(spark: SparkSession, d: str) -> DataFrame:
    return contained_labels(table(spark, d, "documents"), table(spark, d, "benchmark").select("item_id", F.col("text").alias("passage")), "text", "passage").select("item_id")


@query()
def semantic_components(spark: SparkSession, d: str) -> DataFrame:
    """Iterative: tested against a plain union-find."""
    return similar_components(table(spark, d, "embeddings"), "vec_id", "embedding", ["label"], 0.5)


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def event_windows(spark: SparkSession, d: str) -> DataFrame:
    """The batch form of the streaming counts."""
    return windowed_counts(table(spark, d, "events"), "ts", ["event_type"])
