"""Metrics, units and scores over lines: nulls, empty texts, and what the real lines reach."""

import pytest

from evidentia.plans.queries import ORACLE_SQL, QUERIES

from .conftest import DATA
from .parity import differences, oracle

NAMES = ["metric_lines", "metric_figures", "unit_normalization", "extraction_scores", "table_like_texts", "prepared_lines"]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("odd")
    texts = [(1, None), (2, ""), (None, "Token 12 kWh,\r\nthe license, version 3\n\n1,5 %"), (4, "Licensé, 12 é the and 120 % 1995\nversion 2001\nversion 120\nin the 1996: 20 ha"), (5, "que une token 99 tCO2E und die 7 7\nde la\n12 tonnes de la, une"), (7, "12345678901234567890 in the")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, 0, None), (1, 1, "water:\t3 m3 and 3 m3"), (1, 2, "the version, 4,000,000 %")], "conv_id long, turn int, text string").write.parquet(f"{d}/conversations.parquet")
    spark.createDataFrame([(5, "<h1 class='x'>Water 12 ha</h1><h1></h1>"), (6, None)], "page_id long, html string").write.parquet(f"{d}/pages.parquet")
    spark.createDataFrame([], "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_shipdate date").write.parquet(f"{d}/lineitem.parquet")
    return str(d)


@pytest.mark.parametrize("name", NAMES)
def test_odd_texts_as_sql(spark, odd, name):
    assert differences(QUERIES[name](spark, odd), oracle(odd), ORACLE_SQL[name]) == []


def test_odd_metrics(spark, odd):
    got = {(r.src, r.ident, r.part, r.line): (r.metric_id, r.raw_value, r.raw_unit, r.value_rejected_reason, r.year_in_context, r.confidence) for r in QUERIES["metric_lines"](spark, odd).collect() if r.ident not in (5, 7)}
    assert got == {
        ("document", None, 0, 0): ("token", "12", "kWh", None, None, 0.30), ("document", None, 0, 1): ("license_version", None, None, None, None, 0.10), ("document", 4, 0, 0): ("the_and", None, None, "implausible_value", 2001, 0.10),
        ("document", 4, 0, 1): ("version", None, None, "year_like_value", 2001, 0.10), ("document", 4, 0, 2): ("version", None, None, "implausible_value", 2001, 0.10), ("document", 4, 0, 3): ("in_the", "20", "ha", None, 2001, 0.30),
        ("turn", 1, 1, 0): ("water_use", "3", "m3", None, None, 0.35), ("turn", 1, 2, 0): ("version", None, None, "implausible_value", None, 0.10),
    }


def test_real_texts_have_metrics(spark):
    rows = QUERIES["metric_lines"](spark, DATA).filter("src <> 'order'").collect()
    assert {r.src for r in rows} >= {"document", "turn"} and len({r.metric_id for r in rows}) >= 6
    assert any(r.raw_value for r in rows) and any(r.raw_value is None for r in rows)


def test_prepared_values_and_tables(spark, odd, tmp_path):
    spark.createDataFrame([(1, "52!! of 20 ha in 2020"), (2, "1 %, 2 % and 3%"), (3, "1 x 2 y 3\n4 x 5 y 6\n7 x 8,1 y 9\nend"), (4, "1 x 2 y 3\n4 x 5 y 6"), (5, "Total of the licenses"), (6, "2024"), (7, "")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("conversations", "pages", "lineitem"):
        spark.read.parquet(f"{odd}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    d = str(tmp_path)
    assert {r.ident: r.table_like for r in QUERIES["table_like_texts"](spark, d).collect()} == {1: False, 2: True, 3: True, 4: False, 5: True, 6: False, 7: False}
    got = {r.ident: (r.value, r.value_source, r.quality, r.risk_reasons, r.risk) for r in QUERIES["prepared_lines"](spark, d).filter("line = 0 AND ident IN (1, 2, 6, 7)").collect()}
    assert got == {
        1: ("52", "corrected_value", "missing_evidence", None, "low"), 2: ("1 %", "normalized_value", "missing_year|missing_evidence", None, "low"),
        6: ("2024", "raw_value", "missing_unit|missing_evidence", "no_unit|is_year|short_text", "high"), 7: (None, "missing", "missing_value|missing_unit|missing_year|missing_evidence", "no_unit|short_text", "high"),
    }
