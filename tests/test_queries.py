"""Queries against DuckDB on the smallest given tables; set REVIEWGRAIN_ALL=1 for all of them."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
import registry
from tools.check import TABLES, compare

SF = "/root/testdata/sf0.001"
SOME = [
    "cl1_clean_text", "cl5_median_fill", "cl14_validate_dates", "jn1_merge_by_url", "wn1_drop_duplicates",
    "sc4_column_info", "sx4_helpfulness_score", "tx5_sentiment_score", "tx8_aspect_sentiment", "tx14_cluster_top_words",
    "jn4_fill_from_scraped", "jn8_apply_inferred", "ag3_sentiment_by_category", "ag8_category_insights", "wn3_peak_months",
    "ml4_assign_step", "ml8_squared_silhouette", "ml11_coherence", "ml15_topic_terms", "bm2_parse_categories",
    "bm5_parse_inferred", "wb1_extract_pages", "pl1_preprocess", "pl6_report", "io8_texts_to_encode",
]
ALL = list(registry.ORACLES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are not here")
@pytest.mark.parametrize("name", ALL if os.environ.get("REVIEWGRAIN_ALL") else SOME)
def test_query_agrees_with_sql(spark, duck, name):
    verdict, _ = compare(spark, duck, entry, name, SF)
    assert verdict.startswith("ok"), verdict


@pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are not here")
def test_entry(spark):
    out = entry.entry(spark)
    assert out.count() > 0 and "avg_sentiment" in out.columns


def test_registry_is_consistent():
    names = set(entry.queries())
    assert set(entry.oracle_sql()) <= names
    assert set(registry.QUERIES) <= names
