"""Derived-column queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import CTE_REVIEWS, CTE_SCORED, query, reviews, rounded, scored, sql_product_id, sql_tokens, sql_wilson, table
from reviewgrain.functions import dates, numeric, text
from reviewgrain.operators import cleaning


@query("sx1_product_id", f"{CTE_REVIEWS} SELECT row_id, {sql_product_id('pageurl')} AS product_id FROM reviews")
def product_id(spark, sf):
    return cleaning.add_derived(reviews(spark, sf).select("row_id", "pageurl")).select("row_id", "product_id")


_VOTES = ("review_upvotes", "review_downvotes")


def _votes(spark, sf):
    return cleaning.add_derived(reviews(spark, sf).select("row_id", *_VOTES))


@query("sx2_total_votes", f"{CTE_REVIEWS} SELECT row_id, review_upvotes + review_downvotes AS total_votes FROM reviews")
def total_votes(spark, sf):
    return _votes(spark, sf).select("row_id", "total_votes")


@query(
    "sx3_vote_ratio",
    f"""{CTE_REVIEWS} SELECT row_id, CASE WHEN review_upvotes + review_downvotes > 0
 THEN review_upvotes / (review_upvotes + review_downvotes) ELSE 0.5::DOUBLE END AS vote_ratio FROM reviews""",
)
def vote_ratio(spark, sf):
    return _votes(spark, sf).select("row_id", "vote_ratio")


_CLEAN_VOTES = (
    "clean AS (SELECT row_id, CASE WHEN review_upvotes < 0 THEN 0.0::DOUBLE ELSE review_upvotes END AS up, "
    "CASE WHEN review_downvotes < 0 THEN 0.0::DOUBLE ELSE review_downvotes END AS down FROM reviews)"
)


@query(
    "sx4_helpfulness_score",
    f"{CTE_REVIEWS}, {_CLEAN_VOTES} SELECT row_id, {sql_wilson('up', '(up + down)')} AS helpfulness_score FROM clean",
)
def helpfulness_score(spark, sf):
    rows = cleaning.fix_values(reviews(spark, sf).select("row_id", *_VOTES))
    return cleaning.add_derived(rows).select("row_id", "helpfulness_score")


@query("sx5_review_length", f"{CTE_REVIEWS} SELECT row_id, coalesce(length(review), 0)::INTEGER AS review_length FROM reviews")
def review_length(spark, sf):
    return cleaning.add_derived(reviews(spark, sf).select("row_id", "review")).select("row_id", "review_length")


@query(
    "sx6_word_count",
    f"{CTE_REVIEWS} SELECT row_id, coalesce(len({sql_tokens('review')}), 0)::INTEGER AS word_count FROM reviews",
)
def word_count(spark, sf):
    return cleaning.add_derived(reviews(spark, sf).select("row_id", "review")).select("row_id", "word_count")


@query(
    "sx6_word_count_turns",
    f"SELECT conv_id, turn, coalesce(len({sql_tokens('text')}), 0)::INTEGER AS word_count FROM conversations",
)
def word_count_turns(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", text.word_count(F.col("text")).alias("word_count"))


_RATING = "CASE WHEN rating IS NULL THEN five_star ELSE rating END"


@query(
    "sx7_rating_category",
    f"""{CTE_REVIEWS}, r AS (SELECT row_id, {_RATING} AS rating FROM reviews)
SELECT row_id, CASE WHEN rating < 0 THEN NULL WHEN rating <= 2 THEN 'Low' WHEN rating <= 3.5 THEN 'Medium'
 WHEN rating <= 5 THEN 'High' END AS rating_category FROM r""",
)
def rating_category(spark, sf):
    rows = reviews(spark, sf).select("row_id", F.coalesce("rating", "five_star").alias("rating"))
    return rows.select("row_id", numeric.rating_category(F.col("rating")).alias("rating_category"))


@query(
    "sx8_rating_sentiment",
    f"""{CTE_REVIEWS}, r AS (SELECT row_id, {_RATING} AS rating FROM reviews)
SELECT row_id, CASE WHEN rating < 0 THEN NULL WHEN rating <= 2.5 THEN 'Negative' WHEN rating <= 3.5 THEN 'Neutral'
 WHEN rating <= 5 THEN 'Positive' END AS rating_sentiment FROM r""",
)
def rating_sentiment(spark, sf):
    rows = reviews(spark, sf).select("row_id", F.coalesce("rating", "five_star").alias("rating"))
    return rows.select("row_id", numeric.rating_sentiment(F.col("rating")).alias("rating_sentiment"))


@query(
    "sx9_review_month",
    f"""{CTE_REVIEWS} SELECT row_id, year(review_date)::VARCHAR AS review_year, month(review_date)::VARCHAR AS review_month,
 strftime(review_date, '%Y-%m') AS review_year_month FROM reviews""",
)
def review_month(spark, sf):
    rows = cleaning.add_derived(reviews(spark, sf).select("row_id", "review_date"))
    return rows.select(
        "row_id",
        F.col("review_year").cast("string").alias("review_year"),
        F.col("review_month").cast("string").alias("review_month"),
        "review_year_month",
    )


@query(
    "sx9_event_month",
    """SELECT event_id, year(ts)::INTEGER AS review_year, month(ts)::INTEGER AS review_month,
 strftime(ts, '%Y-%m') AS review_year_month FROM events""",
)
def event_month(spark, sf):
    ts = F.col("ts")
    return table(spark, sf, "events").select(
        "event_id",
        F.year(ts).alias("review_year"),
        F.month(ts).alias("review_month"),
        dates.year_month(ts).alias("review_year_month"),
    )


@query(
    "sx10_format_number",
    """SELECT o_orderkey, CASE WHEN x >= 1e6 THEN format('{:.2f}M', x / 1e6) WHEN x >= 1e3 THEN format('{:.2f}K', x / 1e3)
 WHEN x IS NOT NULL THEN format('{:.2f}', x) END AS shown FROM (SELECT o_orderkey, o_orderkey * 137.0::DOUBLE AS x FROM orders)""",
)
def format_number(spark, sf):
    rows = table(spark, sf, "orders")
    return rows.select("o_orderkey", numeric.format_number(F.col("o_orderkey") * 137.0).alias("shown"))


@query(
    "sx11_truncate",
    """SELECT doc_id, substring(text, 1, 200) AS t200, substring(text, 1, 150) AS t150, substring(text, 1, 500) AS t500,
 substring(text, 1, 2000) AS t2000 FROM documents""",
)
def truncate(spark, sf):
    cuts = [text.truncate(F.col("text"), n).alias(f"t{n}") for n in (200, 150, 500, 2000)]
    return table(spark, sf, "documents").select("doc_id", *cuts)


def _case(x: str, cuts: list[tuple[float, str]], lowest: str) -> str:
    whens = " ".join(f"WHEN {x} >= {c} THEN '{label}'" for c, label in cuts)
    return f"CASE WHEN {x} IS NULL THEN NULL {whens} ELSE '{lowest}' END"


@query(
    "sx12_bands",
    f"""SELECT l_orderkey, l_linenumber,
 {_case('l_discount * 8', [(0.5, 'good'), (0.25, 'fair')], 'weak')} AS silhouette_band,
 {_case('l_discount * 8', [(0.6, 'very_good'), (0.4, 'good'), (0.25, 'fair')], 'weak')} AS coherence_band,
 {_case('l_quantity * 2', [(70, 'good'), (40, 'fair')], 'weak')} AS coverage_band,
 {_case('l_discount * 8', [(0.7, 'very_good'), (0.5, 'good'), (0.3, 'fair')], 'weak')} AS relevance_band,
 {_case('l_discount * 8', [(0.4, 'good'), (0.2, 'fair')], 'weak')} AS focus_band,
 CASE WHEN l_discount * 12 < 0.5 THEN 'good' WHEN l_discount * 12 < 1.0 THEN 'fair' ELSE 'weak' END AS balance_band,
 CASE WHEN l_discount * 30 < 1.0 THEN 'good' WHEN l_discount * 30 < 2.0 THEN 'fair' ELSE 'weak' END AS davies_bouldin_band,
 {_case('l_discount * 8', [(0.7, 'A'), (0.55, 'B'), (0.4, 'C'), (0.25, 'D')], 'F')} AS grade FROM lineitem""",
)
def bands(spark, sf):
    share, pct = F.col("l_discount") * 8, F.col("l_quantity") * 2
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        numeric.silhouette_band(share).alias("silhouette_band"),
        numeric.coherence_band(share).alias("coherence_band"),
        numeric.coverage_band(pct).alias("coverage_band"),
        numeric.relevance_band(share).alias("relevance_band"),
        numeric.focus_band(share).alias("focus_band"),
        numeric.balance_band(F.col("l_discount") * 12).alias("balance_band"),
        numeric.davies_bouldin_band(F.col("l_discount") * 30).alias("davies_bouldin_band"),
        numeric.grade(share).alias("grade"),
    )


@query(
    "sx_all_derived",
    f"""{CTE_SCORED} SELECT row_id, product_id, total_votes, vote_ratio, helpfulness_score, review_length, word_count,
 rating_category, rating_sentiment, review_year_month, {rounded('sentiment_score', 3)} AS sentiment_score FROM scored""",
)
def all_derived(spark, sf):
    return scored(spark, sf).select(
        "row_id", "product_id", "total_votes", "vote_ratio", "helpfulness_score", "review_length", "word_count",
        "rating_category", "rating_sentiment", "review_year_month",
        numeric.round_to(F.col("sentiment_score"), 3).alias("sentiment_score"),
    )
