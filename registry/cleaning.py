"""Cleaning queries over the review view."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import (
    CTE_REVIEWS,
    CTE_SCORED,
    query,
    raw_reviews,
    reviews,
    rounded,
    scored,
    sql_stamp,
    stamp,
    table,
)
from reviewgrain import lexicons as lx
from reviewgrain.functions import dates, numeric, text
from reviewgrain.operators import cleaning, enrichment, topics
from reviewgrain.plans.discovery import select_reviews

SPACES = r"[\t-\r\x1c-\x20\x85\p{Z}]"


def sql_clean(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace({c}, '{SPACES}+', ' ', 'g'), '<[^>]+>', '', 'g'))"


def sql_tokenless(c: str) -> str:
    return f"CASE WHEN {c} IN ('', 'nan', 'None') THEN NULL ELSE {c} END"


def sql_mapped(c: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {c} {whens} ELSE coalesce({c}, 'Unknown') END"


@query(
    "cl1_clean_text",
    f"{CTE_REVIEWS} SELECT row_id, {sql_clean('title')} AS title, {sql_clean('review')} AS review, {sql_clean('reviewer_name')} AS reviewer_name FROM reviews",
)
def clean_text(spark, sf):
    rows = reviews(spark, sf).select("row_id", *lx.TEXT_COLUMNS)
    return cleaning.apply_to(rows, lx.TEXT_COLUMNS, text.clean_text)


@query(
    "cl1_clean_pages",
    f"SELECT page_id, {sql_clean('html')} AS html FROM pages",
)
def clean_pages(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.clean_text(F.col("html")).alias("html"))


@query(
    "cl2_null_tokens",
    f"""{CTE_REVIEWS}, parts AS (SELECT row_id, coalesce(reviewer_name, 'None') AS a,
 CASE WHEN quality = 0 THEN 'nan' WHEN quality IS NULL THEN '' ELSE lang END AS b FROM reviews)
SELECT row_id, {sql_tokenless('a')} AS a, {sql_tokenless('b')} AS b FROM parts""",
)
def null_tokens(spark, sf):
    quality = F.col("quality")
    rows = reviews(spark, sf).select(
        "row_id",
        F.coalesce("reviewer_name", F.lit("None")).alias("a"),
        F.when(quality == 0, "nan").when(quality.isNull(), "").otherwise(F.col("lang")).alias("b"),
    )
    return cleaning.apply_to(rows, ["a", "b"], text.null_tokens)


@query(
    "cl3_numeric_coercion",
    f"""{CTE_REVIEWS} SELECT row_id, try_cast(rating_text AS DOUBLE) AS rating_text, try_cast(date_text AS DOUBLE) AS date_text,
 try_cast(review_upvotes::VARCHAR AS DOUBLE) AS review_upvotes FROM reviews""",
)
def numeric_coercion(spark, sf):
    rows = reviews(spark, sf).select(
        "row_id", "rating_text", "date_text", F.col("review_upvotes").cast("string").alias("review_upvotes")
    )
    return cleaning.coerce_types(rows, ["rating_text", "date_text", "review_upvotes"], [])


@query(
    "cl4_date_coercion",
    f"""{CTE_REVIEWS} SELECT row_id, {sql_stamp('try_cast(date_text AS TIMESTAMP)')} AS date_text,
 {sql_stamp('review_date')} AS review_date FROM reviews""",
)
def date_coercion(spark, sf):
    rows = reviews(spark, sf).select(
        "row_id", "date_text", F.date_format("review_date", "yyyy-MM-dd HH:mm:ss").alias("review_date")
    )
    typed = cleaning.coerce_types(rows, [], ["date_text", "review_date"])
    return typed.select("row_id", stamp("date_text"), stamp("review_date"))


@query(
    "cl5_median_fill",
    f"{CTE_REVIEWS} SELECT row_id, coalesce(rating, (SELECT median(rating) FROM reviews)) AS rating FROM reviews",
)
def median_fill(spark, sf):
    return cleaning.fill_rating_median(reviews(spark, sf).select("row_id", "rating"))


@query(
    "cl5_median_orders",
    """SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END,
 (SELECT median(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END) FROM orders)) AS o_totalprice FROM orders""",
)
def median_orders(spark, sf):
    price = F.when(F.col("o_orderstatus") == "P", None).otherwise(F.col("o_totalprice"))
    rows = table(spark, sf, "orders").select("o_orderkey", price.alias("o_totalprice"))
    return cleaning.fill_rating_median(rows, "o_totalprice", many_values=True)


_ZERO = ", ".join(f"coalesce({c}, 0) AS {c}" for c in [*lx.VOTE_COLUMNS, *lx.STAR_COLUMNS])


@query(
    "cl6_constant_fill",
    f"""{CTE_REVIEWS} SELECT row_id, {_ZERO}, coalesce(title, 'Unknown Product') AS title,
 coalesce(reviewer_name, 'Anonymous') AS reviewer_name, coalesce(verified_purchaser, 'Unknown') AS verified_purchaser,
 coalesce(recommended_purchase, 'Unknown') AS recommended_purchase FROM reviews""",
)
def constant_fill(spark, sf):
    wanted = [*lx.VOTE_COLUMNS, *lx.STAR_COLUMNS, "title", "reviewer_name", "verified_purchaser", "recommended_purchase"]
    return cleaning.fill_constants(reviews(spark, sf).select("row_id", *wanted))


_VOTES = ", ".join(f"CASE WHEN {c} < 0 THEN 0.0::DOUBLE ELSE {c} END AS {c}" for c in lx.VOTE_COLUMNS)
_STARS = ", ".join(
    f"CAST(round_even(CASE WHEN {c} < 0 THEN 0.0::DOUBLE ELSE coalesce({c}, 0.0::DOUBLE) END, 0) AS BIGINT) AS {c}"
    for c in lx.STAR_COLUMNS
)


@query("cl7_negative_votes", f"{CTE_REVIEWS} SELECT row_id, {_VOTES} FROM reviews")
def negative_votes(spark, sf):
    return cleaning.apply_to(reviews(spark, sf).select("row_id", *lx.VOTE_COLUMNS), lx.VOTE_COLUMNS, numeric.no_negative)


@query("cl8_star_counts", f"{CTE_REVIEWS} SELECT row_id, {_STARS} FROM reviews")
def star_counts(spark, sf):
    rows = reviews(spark, sf).select("row_id", *lx.STAR_COLUMNS).fillna(0.0)
    return cleaning.apply_to(rows, lx.STAR_COLUMNS, numeric.star_count)


@query(
    "cl9_verified_purchaser",
    f"{CTE_REVIEWS} SELECT row_id, {sql_mapped('verified_purchaser', lx.VERIFIED_MAP)} AS verified_purchaser FROM reviews",
)
def verified_purchaser(spark, sf):
    return cleaning.standardise_columns(reviews(spark, sf).select("row_id", "verified_purchaser"))


@query(
    "cl10_recommended_purchase",
    f"{CTE_REVIEWS} SELECT row_id, {sql_mapped('recommended_purchase', lx.RECOMMENDED_MAP)} AS recommended_purchase FROM reviews",
)
def recommended_purchase(spark, sf):
    return cleaning.standardise_columns(reviews(spark, sf).select("row_id", "recommended_purchase"))


@query(
    "cl11_website",
    f"{CTE_REVIEWS} SELECT row_id, regexp_replace(lower(website), '^{SPACES}+|{SPACES}+$', '', 'g') AS website FROM reviews",
)
def website(spark, sf):
    return cleaning.standardise_columns(reviews(spark, sf).select("row_id", "website"))


@query(
    "cl12_clip_rating",
    f"{CTE_REVIEWS} SELECT row_id, CASE WHEN rating < 1 THEN 1.0::DOUBLE WHEN rating > 5 THEN 5.0::DOUBLE ELSE rating END AS rating FROM reviews",
)
def clip_rating(spark, sf):
    return cleaning.clip_ratings(reviews(spark, sf).select("row_id", "rating"))


@query(
    "cl13_shift_dates",
    f"""{CTE_REVIEWS} SELECT row_id, {sql_stamp("review_date - INTERVAL 10 YEAR")} AS review_date,
 {sql_stamp("crawl_timestamp - INTERVAL 10 YEAR")} AS crawl_timestamp FROM reviews""",
)
def shift_dates(spark, sf):
    shifted = cleaning.shift_dates(reviews(spark, sf).select("row_id", *lx.DATE_COLUMNS))
    return shifted.select("row_id", stamp("review_date"), stamp("crawl_timestamp"))


@query(
    "cl13_shift_orders",
    f"SELECT o_orderkey, {sql_stamp('o_orderdate - INTERVAL 3 YEAR')} AS o_orderdate FROM orders",
)
def shift_orders(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey", dates.shift_years(F.col("o_orderdate"), 3).alias("o_orderdate")
    )
    return rows.select("o_orderkey", stamp("o_orderdate"))


def _sql_valid(c: str) -> str:
    return f"CASE WHEN {c} BETWEEN TIMESTAMP '{lx.EARLIEST_DATE}' AND TIMESTAMP '{lx.LATEST_DATE}' THEN {c} END"


@query(
    "cl14_validate_dates",
    f"""{CTE_REVIEWS}, shifted AS (SELECT row_id, review_date - INTERVAL 10 YEAR AS r, crawl_timestamp - INTERVAL 10 YEAR AS c FROM reviews)
SELECT row_id, {sql_stamp(_sql_valid('r'))} AS review_date, {sql_stamp(_sql_valid('c'))} AS crawl_timestamp FROM shifted""",
)
def validate_dates(spark, sf):
    shifted = cleaning.shift_dates(reviews(spark, sf).select("row_id", *lx.DATE_COLUMNS))
    return cleaning.validate_dates(shifted).select("row_id", stamp("review_date"), stamp("crawl_timestamp"))


@query("cl15_non_empty", f"{CTE_REVIEWS} SELECT row_id, length(review) AS n FROM reviews WHERE review IS NOT NULL AND review <> ''")
def non_empty(spark, sf):
    rows = reviews(spark, sf).where(text.non_empty(F.col("review")))
    return rows.select("row_id", F.length("review").cast("long").alias("n"))


@query(
    "cl16_reviews_for_product",
    f"""{CTE_SCORED} SELECT row_id, title, product_category FROM scored
WHERE review IS NOT NULL AND review <> '' AND contains(lower(product_category), 'electro') AND contains(lower(title), 'headphone')""",
)
def reviews_for_product(spark, sf):
    rows = select_reviews(scored(spark, sf), product="Headphone", category="ELECTRO", regex=False)
    return rows.select("row_id", "title", "product_category")


@query(
    "cl16_reviews_by_pattern",
    f"""{CTE_SCORED} SELECT row_id, title FROM scored WHERE review IS NOT NULL AND review <> ''
AND regexp_matches(title, '(?i)head.*speaker|puzz(le|ler)')""",
)
def reviews_by_pattern(spark, sf):
    return select_reviews(scored(spark, sf), product="head.*speaker|puzz(le|ler)").select("row_id", "title")


_NEEDS = "((title IS NULL OR title = 'Unknown Product') OR (rating IS NULL OR rating = 0))"


@query("cl17_needs_inference", f"{CTE_REVIEWS} SELECT row_id, uniq_id FROM reviews WHERE {_NEEDS} AND review IS NOT NULL AND length(review) > 10")
def needs_inference(spark, sf):
    return enrichment.needs_inference(reviews(spark, sf)).select("row_id", "uniq_id")


_BAD = "SELECT DISTINCT pageurl FROM reviews WHERE toxic = 1 AND pageurl IS NOT NULL"


def known_bad(spark, sf):
    """URLs of toxic reviews stand in for pages already known to fail."""
    return reviews(spark, sf).where((F.col("toxic") == 1) & F.col("pageurl").isNotNull()).select("pageurl")


@query(
    "cl18_review_worklist",
    f"{CTE_REVIEWS} SELECT DISTINCT pageurl FROM reviews WHERE review IS NULL AND pageurl IS NOT NULL AND pageurl NOT IN ({_BAD})",
)
def review_worklist(spark, sf):
    return enrichment.review_worklist(reviews(spark, sf), known_bad(spark, sf))


@query(
    "cl19_title_worklist",
    f"{CTE_REVIEWS} SELECT DISTINCT pageurl FROM reviews WHERE title IS NULL AND pageurl IS NOT NULL AND pageurl NOT IN ({_BAD})",
)
def title_worklist(spark, sf):
    return enrichment.title_worklist(reviews(spark, sf), known_bad(spark, sf))


@query(
    "cl19_star_worklist",
    f"{CTE_REVIEWS} SELECT DISTINCT pageurl FROM reviews WHERE five_star IS NULL AND pageurl IS NOT NULL AND pageurl NOT IN ({_BAD})",
)
def star_worklist(spark, sf):
    return enrichment.title_worklist(reviews(spark, sf), known_bad(spark, sf), lx.STAR_COLUMNS)


@query(
    "cl20_keyword_documents",
    f"{CTE_REVIEWS} SELECT row_id FROM reviews WHERE regexp_matches(review, '(?i)warranty|refund')",
)
def keyword_documents(spark, sf):
    return topics.keyword_documents(reviews(spark, sf), "warranty|refund", first=None).select("row_id")


@query(
    "cl20_keyword_first_hits",
    f"{CTE_REVIEWS} SELECT row_id FROM reviews WHERE contains(lower(review), 'warranty') ORDER BY row_id LIMIT 50",
)
def keyword_first_hits(spark, sf):
    return topics.keyword_documents(reviews(spark, sf), "Warranty", first=50, regex=False).select("row_id")


@query(
    "cl21_category_filter",
    f"{CTE_SCORED} SELECT row_id, product_category FROM scored WHERE lower(product_category) = lower('TOYS & games')",
)
def category_filter(spark, sf):
    from reviewgrain.operators.retrieval import in_category

    return in_category(scored(spark, sf), "TOYS & games", "product_category").select("row_id", "product_category")


# --- merge and de-duplicate ---------------------------------------------------
_FILLABLE = ["title", *lx.STAR_COLUMNS]
_FIRSTS = ", ".join(f"arg_min({c}, row_id) FILTER ({c} IS NOT NULL) AS f_{c}" for c in _FILLABLE)
_FILLED = ", ".join(f"coalesce(r.{c}, f_{c}) AS {c}" for c in _FILLABLE)


@query(
    "jn1_merge_by_url",
    f"""{CTE_REVIEWS}, firsts AS (SELECT pageurl, {_FIRSTS} FROM reviews WHERE pageurl IS NOT NULL GROUP BY pageurl)
SELECT r.row_id, {_FILLED} FROM reviews r LEFT JOIN firsts f ON r.pageurl = f.pageurl""",
)
def merge_by_url(spark, sf):
    return cleaning.merge_by_url(reviews(spark, sf)).select("row_id", *_FILLABLE)


_RAW = ", ".join(
    ["uniq_id", "pageurl", "title", "rating", "review", "reviewer_name", "review_upvotes", "review_downvotes",
     "verified_purchaser", "review_date", "crawl_timestamp", "website", "recommended_purchase", *lx.STAR_COLUMNS]
)
CTE_DEDUPED = f"""{CTE_REVIEWS},
pass1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_RAW} ORDER BY row_id) AS rn1 FROM reviews) WHERE rn1 = 1),
pass2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pageurl, reviewer_name, review ORDER BY row_id) AS rn2 FROM pass1) WHERE rn2 = 1),
pass3 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uniq_id ORDER BY row_id) AS rn3 FROM pass2) WHERE rn3 = 1)"""


@query("wn1_drop_duplicates", f"{CTE_DEDUPED} SELECT row_id, uniq_id, pageurl, reviewer_name, review FROM pass3")
def drop_duplicates(spark, sf):
    rows = cleaning.drop_duplicates(raw_reviews(spark, sf))
    return rows.select("row_id", "uniq_id", "pageurl", "reviewer_name", "review")


@query(
    "wn1_duplicate_counts",
    f"""{CTE_DEDUPED}, sizes AS (SELECT (SELECT count(*) FROM reviews) AS n0, (SELECT count(*) FROM pass1) AS n1,
 (SELECT count(*) FROM pass2) AS n2, (SELECT count(*) FROM pass3) AS n3),
long AS (SELECT 'exact' AS strategy, n0 - n1 AS removed, n0 FROM sizes UNION ALL SELECT 'same_review', n1 - n2, n0 FROM sizes
 UNION ALL SELECT 'uniq_id', n2 - n3, n0 FROM sizes UNION ALL SELECT 'total', n0 - n3, n0 FROM sizes)
SELECT strategy, removed, {rounded('removed::DOUBLE / n0 * 100', 2)} AS removed_pct FROM long""",
)
def duplicate_counts(spark, sf):
    return cleaning.duplicate_counts(raw_reviews(spark, sf))


@query(
    "wn1_drop_document_copies",
    """SELECT min(doc_id) AS row_id, md5(text) AS digest FROM documents GROUP BY text""",
)
def drop_document_copies(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("row_id"), F.col("text").alias("review"))
    return cleaning.drop_duplicates(docs).select("row_id", F.md5("review").alias("digest"))


@query(
    "wn1_rows_a_microsecond_apart",
    """SELECT event_type, count(*) AS events, count(DISTINCT ts) AS stamps FROM (SELECT DISTINCT user_id, event_type, value, props, ts FROM
 (SELECT * FROM events UNION ALL SELECT * FROM events UNION ALL SELECT event_id, ts + INTERVAL 1 MICROSECOND, user_id, event_type, value, props FROM events))
GROUP BY 1""",
)
def rows_a_microsecond_apart(spark, sf):
    events = table(spark, sf, "events")
    later = F.col("ts") + F.expr("INTERVAL 1 MICROSECOND")
    copies = [events, events, events.withColumn("ts", later)]
    rows = [df.withColumn("row_id", F.col("event_id") * 3 + i).drop("event_id") for i, df in enumerate(copies)]
    kept = cleaning.drop_duplicates(rows[0].unionByName(rows[1]).unionByName(rows[2]))
    return kept.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"), F.count_distinct("ts").alias("stamps"))
