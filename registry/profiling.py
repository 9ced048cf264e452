"""Profiling queries; the generic ones also run over other given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import CTE_REVIEWS, RAW_COLUMNS, query, raw_reviews, reviews, rounded, table
from registry.cleaning import CTE_DEDUPED
from reviewgrain.operators import cleaning, enrichment, profiling

_STAMPS = {"review_date", "crawl_timestamp", "ts", "o_orderdate"}


def _unpivot(source: str, columns: list[str]) -> str:
    """column_name, rows, non_null and distinct values, one row per column."""
    parts = [
        f"SELECT '{c}' AS \"column\", count(*) AS n, count({c}) AS known, count(DISTINCT {c}) AS uniq FROM {source}"
        for c in columns
    ]
    return " UNION ALL ".join(parts)


def _info(source: str, columns: list[str]) -> str:
    return (
        f'SELECT "column", known AS non_null_count, n - known AS null_count, '
        f"{rounded('(n - known)::DOUBLE / n * 100', 2)} AS null_percent, uniq AS unique_count "
        f"FROM ({_unpivot(source, columns)})"
    )


def _missing(source: str, columns: list[str]) -> str:
    return (
        f'SELECT "column", n - known AS missing_count, {rounded("(n - known)::DOUBLE / n * 100", 2)} AS missing_percent, '
        f"{rounded('(1 - (n - known)::DOUBLE / n) * 100', 2)} AS completeness FROM ({_unpivot(source, columns)})"
    )


@query(
    "sc3_missing_required",
    """SELECT c AS "column", (SELECT count(*) FROM documents) AS rows FROM (VALUES ('pageurl'), ('rating'), ('uniq_id')) t(c)
WHERE c NOT IN (SELECT column_name FROM (DESCRIBE documents))""",
)
def missing_required(spark, sf):
    return profiling.missing_required(table(spark, sf, "documents"))


@query("sc4_column_info", f"{CTE_REVIEWS} {_info('reviews', RAW_COLUMNS)}")
def column_info(spark, sf):
    return profiling.column_info(raw_reviews(spark, sf).drop("row_id")).drop("dtype")


_LINE = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


@query("sc4_column_info_lineitem", _info("lineitem", _LINE))
def column_info_lineitem(spark, sf):
    return profiling.column_info(table(spark, sf, "lineitem").select(*_LINE)).drop("dtype")


@query("sc4_column_info_sketch")
def column_info_sketch(spark, sf):
    return profiling.column_info(table(spark, sf, "lineitem"), exact=False)


@query("sc5_missing_info", f"{CTE_REVIEWS} {_missing('reviews', RAW_COLUMNS)}")
def missing_info(spark, sf):
    return profiling.missing_info(raw_reviews(spark, sf).drop("row_id")).drop("dtype")


_REPORT = ["uniq_id", "title", "rating", "review", "review_date", "pageurl"]


@query(
    "sc6_quality_report",
    f"""{CTE_DEDUPED}, cleaned AS (SELECT row_id, {', '.join(_REPORT)}, regexp_extract(pageurl, '(\\d{{6,9}})', 1) AS unused FROM pass3),
sizes AS (SELECT (SELECT count(*) FROM reviews) AS before, (SELECT count(*) FROM cleaned) AS after)
SELECT 'initial_rows' AS metric, before::VARCHAR AS value FROM sizes
UNION ALL SELECT 'final_rows', after::VARCHAR FROM sizes
UNION ALL SELECT 'rows_removed', (before - after)::VARCHAR FROM sizes
UNION ALL SELECT 'initial_columns', '18' UNION ALL SELECT 'final_columns', '7'
UNION ALL SELECT 'first_review_date', strftime(min(review_date), '%Y-%m-%d %H:%M:%S') FROM cleaned
UNION ALL SELECT 'last_review_date', strftime(max(review_date), '%Y-%m-%d %H:%M:%S') FROM cleaned
UNION ALL SELECT 'completeness.' || "column", CAST({rounded('known::DOUBLE / n * 100', 2)} AS DECIMAL(5,2))::VARCHAR
 FROM ({_unpivot('cleaned', ['row_id', *_REPORT])})""",
)
def quality_report(spark, sf):
    raw = raw_reviews(spark, sf)
    kept = cleaning.drop_duplicates(raw).select("row_id", *_REPORT)
    return profiling.quality_report(raw.drop("crawl_timestamp"), kept)


@query(
    "sc7_urls_with_missing",
    f"""{CTE_REVIEWS} SELECT DISTINCT pageurl FROM reviews
WHERE pageurl IS NOT NULL AND (title IS NULL OR rating IS NULL OR review IS NULL)""",
)
def urls_with_missing(spark, sf):
    return profiling.urls_with_missing(reviews(spark, sf))


def url_status(spark, sf):
    """One status per URL, from the toxicity labels of its reviews."""
    rows = reviews(spark, sf).where(F.col("pageurl").isNotNull())
    bad = F.max(F.coalesce("toxic", F.lit(0)))
    return rows.groupBy(F.col("pageurl").alias("url")).agg((200 + 204 * bad).cast("int").alias("status"))


def scraped(spark, sf):
    """One scraped record per URL, from the part with the same key modulus."""
    rows = url_status(spark, sf)
    ok = F.col("status") < 400
    return rows.select(
        "url",
        ok.alias("success"),
        F.when(ok, F.concat(F.lit("Scraped "), F.substring("url", -6, 6))).alias("title"),
        F.when(ok, (F.length("url") % 5 + 1).cast("double")).alias("rating"),
        F.when(~ok, "not found").alias("error"),
    )


CTE_SIDE = """url_status AS (SELECT pageurl AS url, 200 + 204 * max(coalesce(toxic, 0)) AS status FROM reviews
 WHERE pageurl IS NOT NULL GROUP BY pageurl),
scraped AS (SELECT url, status < 400 AS success, CASE WHEN status < 400 THEN 'Scraped ' || right(url, 6) END AS title,
 CASE WHEN status < 400 THEN (length(url) % 5 + 1)::DOUBLE END AS rating FROM url_status),
invalid AS (SELECT url AS pageurl FROM url_status WHERE status >= 400)"""


@query(
    "sc8_imputation_report",
    f"""{CTE_REVIEWS}, {CTE_SIDE}
SELECT 'total_rows' AS metric, count(*) AS value, NULL::DOUBLE AS percent FROM reviews
UNION ALL SELECT 'scraped_urls', count(*), NULL FROM scraped
UNION ALL SELECT 'scraped_success', count(*) FILTER (success), NULL FROM scraped
UNION ALL SELECT 'invalid_urls', count(*), NULL FROM invalid
UNION ALL SELECT 'nulls.' || "column", n - known, {rounded('(n - known)::DOUBLE / n * 100', 2)}
 FROM ({_unpivot('reviews', ['uniq_id', 'title', 'rating', 'review', 'pageurl'])})""",
)
def imputation_report(spark, sf):
    status = url_status(spark, sf)
    rows = reviews(spark, sf).select("uniq_id", "title", "rating", "review", "pageurl")
    return profiling.imputation_report(rows, scraped(spark, sf), status.where("status >= 400"))


@query("sc8_invalid_urls", f"{CTE_REVIEWS}, {CTE_SIDE} SELECT pageurl FROM invalid")
def invalid_urls(spark, sf):
    validity = enrichment.url_validity(reviews(spark, sf), url_status(spark, sf))
    return validity.where(~F.col("valid")).select("pageurl")


@query(
    "sc9_completeness_status",
    f"""{CTE_REVIEWS} SELECT "column", completeness, CASE WHEN completeness >= 95 THEN 'complete' WHEN completeness >= 80 THEN 'partial'
 ELSE 'sparse' END AS status FROM ({_missing('reviews', RAW_COLUMNS)})""",
)
def completeness_status(spark, sf):
    return profiling.completeness_status(raw_reviews(spark, sf).drop("row_id"))


@query(
    "sc10_missing_cells",
    f"{CTE_REVIEWS} SELECT sum(n - known)::BIGINT AS missing_cells FROM ({_unpivot('reviews', RAW_COLUMNS)})",
)
def missing_cells(spark, sf):
    return profiling.missing_cells(raw_reviews(spark, sf).drop("row_id"))
