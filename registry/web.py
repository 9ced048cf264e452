"""Page queries over the given HTML."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import CTE_REVIEWS, query, reviews, table
from registry.profiling import CTE_SIDE, url_status
from reviewgrain.operators import enrichment, pages

TITLE = r"(?s)<title>(.*?)</title>"
RATING = r"track\((\d+)\)"
AD = r'(?s)<div class="ad">(.*?)</div>'


def _sql_text(pattern: str) -> str:
    inner = f"regexp_replace(regexp_extract(html, '{pattern}', 1), '<[^>]*>', '', 'g')"
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        inner = f"replace({inner}, '{entity}', '{char}')"
    return f"CASE WHEN regexp_matches(html, '{pattern}') THEN {inner} END"


def _sql_clean(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace({x}, '[\t-\r\x1c-\x20\x85\p{{Z}}]+', ' ', 'g'), '<[^>]+>', '', 'g'))"


def _sql_pages(title: str, rating: str) -> str:
    return rf"""extracted AS (SELECT url, {_sql_clean(_sql_text(title))} AS title,
 try_cast(nullif(regexp_extract({_sql_text(rating)}, '(\d+\.?\d*)', 1), '') AS DOUBLE) AS rating FROM pages),
results AS (SELECT url, (title IS NOT NULL OR rating IS NOT NULL) AS success, title, rating,
 CASE WHEN title IS NULL AND rating IS NULL THEN 'no product data' END AS error FROM extracted)"""


@query("wb1_extract_pages", f"WITH {_sql_pages(TITLE, RATING)} SELECT * FROM results")
def extract_pages(spark, sf):
    return pages.extract_pages(table(spark, sf, "pages"), TITLE, RATING)


@query("wb1_extract_by_class", f"WITH {_sql_pages(AD, AD)} SELECT * FROM results")
def extract_by_class(spark, sf):
    return pages.extract_pages(table(spark, sf, "pages"), ["ad"], ["ad"])


@query(
    "wb2_batch_results",
    f"WITH {_sql_pages(AD, AD)} SELECT count(*) AS pages, count(*) FILTER (success) AS succeeded, count(*) FILTER (NOT success) AS failed FROM results",
)
def batch_results(spark, sf):
    return pages.batch_counts(pages.extract_pages(table(spark, sf, "pages"), ["ad"], ["ad"]))


def _sql_classes(classes) -> str:
    listed = ", ".join(f"'{c}'" for c in classes)
    found = r"""regexp_extract_all(html, 'class\s*=\s*["'']([^"'']*)["'']', 1)"""
    return f"len(list_filter({found}, lambda x: list_has_all(string_split_regex(x, '[ \t\n]+'), [{listed}]))) > 0"


_DEFAULT = f"({_sql_classes(pages.TITLE_CLASSES)} OR {_sql_classes(pages.RATING_CLASSES)})"

ARTICLE = r"(?s)<article>(.*?)</article>"


@query("wb1_whole_element", f"WITH {_sql_pages(ARTICLE, RATING)} SELECT * FROM results")
def whole_element(spark, sf):
    """An element with headings, paragraphs and emphasis inside it, found by its class."""
    marked = table(spark, sf, "pages").withColumn("html", F.replace("html", F.lit("<article>"), F.lit('<article class="wide story">')))
    return pages.extract_pages(marked, ["story"], RATING)


DEPTH = 50


@query("wb1_deep_element", f"WITH {_sql_pages(ARTICLE, RATING)} SELECT * FROM results")
def deep_element(spark, sf):
    """The article in an element below which elements of the same name are nested many levels deep, with one more of the name after it."""
    deep = '<div class="wide story">' + "<div>" * DEPTH
    marked = F.replace(F.replace("html", F.lit("<article>"), F.lit(deep)), F.lit("</article>"), F.lit("</div>" * (DEPTH + 1) + "<div>after</div>"))
    return pages.extract_pages(table(spark, sf, "pages").withColumn("html", marked), ["story"], RATING)


@query(
    "wb2_default_classes",
    f"""SELECT count(*) AS pages, count(*) FILTER ({_DEFAULT}) AS succeeded, count(*) FILTER (NOT {_DEFAULT}) AS failed FROM pages""",
)
def default_classes(spark, sf):
    return pages.batch_counts(pages.extract_pages(table(spark, sf, "pages")))


@query(
    "wb3_url_summary",
    f"""{CTE_REVIEWS}, {CTE_SIDE} SELECT count(*) AS checked, count(*) FILTER (status < 400) AS valid, count(*) FILTER (status >= 400) AS invalid
FROM url_status""",
)
def url_summary(spark, sf):
    return enrichment.url_summary(enrichment.url_validity(reviews(spark, sf), url_status(spark, sf)))


@query(
    "wb3_product_urls",
    r"""SELECT url, (regexp_matches(url, '^https?://[^/]+/') AND (regexp_matches(url, '/ip/[^/]+/\d+') OR regexp_matches(url, '/ip/\d+')
 OR regexp_matches(url, '/\d{9,12}(\?|$)'))) AS is_product FROM (SELECT url FROM pages UNION ALL SELECT replace(url, '/en/', '/ip/') FROM pages)""",
)
def product_urls(spark, sf):
    rows = table(spark, sf, "pages").select("url")
    both = rows.unionByName(rows.select(F.replace("url", F.lit("/en/"), F.lit("/ip/")).alias("url")))
    return both.select("url", enrichment.is_product_url(F.col("url")).alias("is_product"))
