"""Aggregation, window, top-k and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import (
    CTE_ANALYSED,
    CTE_EMBEDDED,
    CTE_REVIEWS,
    CTE_SCORED,
    analysed,
    embedded,
    query,
    reviews,
    rounded,
    scored,
    sql_stamp,
    stamp,
    table,
)
from registry.joins import SQL_COSINE, SQL_FIRST_VECTOR, first_vector
from reviewgrain.functions.numeric import round_to
from reviewgrain.operators import aspects, categories, clusters, enrichment, insights, retrieval, sentiment
from reviewgrain.plans import evaluation
from reviewgrain.plans.discovery import sample_per_category


def _counts(column: str) -> str:
    return f"{CTE_SCORED} SELECT {column}, count(*) AS count FROM scored WHERE {column} IS NOT NULL GROUP BY 1"


@query("ag1_sentiment_counts", _counts("sentiment"))
def sentiment_counts(spark, sf):
    return categories.value_counts(scored(spark, sf), "sentiment")


@query("ag1_category_counts", _counts("product_category"))
def category_counts(spark, sf):
    return categories.value_counts(scored(spark, sf), "product_category")


@query("ag1_rating_counts", _counts("rating"))
def rating_counts(spark, sf):
    return categories.value_counts(scored(spark, sf), "rating")


@query(
    "ag2_category_summary",
    f"""{CTE_SCORED} SELECT product_category, count(uniq_id) AS review_count, {rounded('avg(rating)', 2)} AS avg_rating,
 sum(review_upvotes) AS review_upvotes, sum(review_downvotes) AS review_downvotes FROM scored GROUP BY 1""",
)
def category_summary(spark, sf):
    return categories.category_summary(scored(spark, sf))


@query(
    "ag3_sentiment_by_category",
    f"""{CTE_SCORED} SELECT product_category, {rounded('avg(sentiment_score)', 3)} AS avg_sentiment,
 {rounded('stddev_samp(sentiment_score)', 3)} AS sentiment_std, {rounded('avg(rating)', 3)} AS avg_rating, count(uniq_id) AS review_count
FROM scored GROUP BY 1""",
)
def sentiment_by_category(spark, sf):
    return sentiment.by_category(scored(spark, sf))


@query(
    "ag4_sentiment_by_month",
    f"""{CTE_SCORED} SELECT strftime(review_date, '%Y-%m') AS year_month, {rounded('avg(sentiment_score)', 3)} AS avg_sentiment,
 {rounded('avg(rating)', 3)} AS avg_rating, count(uniq_id) AS review_count FROM scored WHERE review_date IS NOT NULL GROUP BY 1""",
)
def sentiment_by_month(spark, sf):
    return sentiment.by_month(scored(spark, sf))


def _rate(part: str, whole: str, places: int) -> str:
    return f"CASE WHEN {whole} > 0 THEN {rounded(f'({part})::DOUBLE / {whole} * 100', places)} ELSE 0.0::DOUBLE END"


_SUMMARY = f"""aspect, mentions, {_rate('mentions', 'total', 2)} AS mention_rate, positive, negative, neutral,
 {_rate('positive - negative', 'mentions', 2)} AS sentiment_score"""


@query("ag5_aspect_summary", f"{CTE_ANALYSED} SELECT {_SUMMARY} FROM grid")
def aspect_summary(spark, sf):
    return aspects.aspect_summary(analysed(spark, sf))


@query("ag6_aspect_summary_by_category", f'{CTE_ANALYSED} SELECT product_category AS "group", {_SUMMARY} FROM category_grid')
def aspect_summary_by_category(spark, sf):
    return aspects.aspect_summary(analysed(spark, sf), "product_category")


@query(
    "ag7_data_summary",
    f"""{CTE_SCORED} SELECT count(*) AS total_reviews, count(DISTINCT product_id) AS unique_products,
 {sql_stamp('min(review_date)')} AS first_date, {sql_stamp('max(review_date)')} AS last_date, {rounded('avg(rating)', 2)} AS avg_rating,
 count(DISTINCT product_category) AS categories_count FROM scored""",
)
def data_summary(spark, sf):
    out = insights.data_summary(scored(spark, sf))
    return out.withColumns({c: stamp(c) for c in ("first_date", "last_date")})


SQL_CATEGORY_SENTIMENT = f"""category_sentiment AS (SELECT product_category, review_count, avg_rating,
 {rounded('pos::DOUBLE / review_count * 100', 1)} AS positive_pct, {rounded('neu::DOUBLE / review_count * 100', 1)} AS neutral_pct,
 {rounded('neg::DOUBLE / review_count * 100', 1)} AS negative_pct FROM (SELECT product_category, count(*) AS review_count,
 {rounded('avg(rating)', 2)} AS avg_rating, count(*) FILTER (sentiment = 'positive') AS pos,
 count(*) FILTER (sentiment = 'neutral') AS neu, count(*) FILTER (sentiment = 'negative') AS neg
 FROM scored WHERE product_category IS NOT NULL GROUP BY 1) WHERE review_count >= 10)"""
SQL_TOP_ASPECTS = f"""top_aspects AS (SELECT * FROM (SELECT product_category, position, aspect, mention_rate,
 row_number() OVER (PARTITION BY product_category ORDER BY mention_rate DESC, position)::INTEGER AS place
 FROM (SELECT *, {rounded('mentions::DOUBLE / total * 100', 1)} AS mention_rate FROM category_grid
 WHERE total >= 10 AND mentions::DOUBLE / total * 100 > 5)) WHERE place <= 5)"""
SQL_PAIN_POINTS = f"""pain_points AS (SELECT product_category, aspect, negative_rate, mentions AS mention_count,
 row_number() OVER (PARTITION BY product_category ORDER BY negative_rate DESC, position)::INTEGER AS place
 FROM (SELECT *, {rounded('negative::DOUBLE / mentions * 100', 1)} AS negative_rate FROM category_grid
 WHERE total >= 10 AND mentions > 0 AND negative::DOUBLE / mentions * 100 > 30))"""


@query("ag8_category_sentiment", f"{CTE_SCORED}, {SQL_CATEGORY_SENTIMENT} SELECT * FROM category_sentiment")
def category_sentiment(spark, sf):
    return insights.category_sentiment(scored(spark, sf))


@query("ag8_category_top_aspects", f"{CTE_ANALYSED}, {SQL_TOP_ASPECTS} SELECT product_category, place, aspect, mention_rate FROM top_aspects")
def category_top_aspects(spark, sf):
    return insights.category_top_aspects(analysed(spark, sf))


@query("ag8_category_pain_points", f"{CTE_ANALYSED}, {SQL_PAIN_POINTS} SELECT * FROM pain_points")
def category_pain_points(spark, sf):
    return insights.category_pain_points(analysed(spark, sf))


@query(
    "ag8_category_insights",
    f"""{CTE_ANALYSED}, {SQL_CATEGORY_SENTIMENT}, {SQL_TOP_ASPECTS}, {SQL_PAIN_POINTS}
SELECT c.*, coalesce((SELECT string_agg(aspect, ',' ORDER BY place) FROM top_aspects t WHERE t.product_category = c.product_category), '') AS top_aspects,
 coalesce((SELECT string_agg(aspect, ',' ORDER BY place) FROM pain_points p WHERE p.product_category = c.product_category), '') AS pain_points
FROM category_sentiment c""",
)
def category_insights(spark, sf):
    def names(c):
        return F.coalesce(F.array_join(F.transform(c, lambda x: x["aspect"]), ","), F.lit("")).alias(c)

    out = insights.category_insights(analysed(spark, sf))
    plain = [c for c in out.columns if c not in ("top_aspects", "pain_points")]
    return out.select(*plain, names("top_aspects"), names("pain_points"))


SQL_ASPECT_STATS = f"""aspect_stats AS (SELECT position::INTEGER AS position, aspect, mentions AS mention_count, {_rate('mentions', 'total', 2)} AS mention_rate,
 nullif({_rate('positive', 'mentions', 2)}, 0) AS positive_rate, nullif({_rate('negative', 'mentions', 2)}, 0) AS negative_rate FROM grid)"""
SQL_HIGHLIGHTS = """highlights AS (SELECT
 (SELECT aspect FROM aspect_stats ORDER BY mention_count DESC, aspect LIMIT 1) AS most_discussed,
 (SELECT aspect FROM aspect_stats ORDER BY coalesce(positive_rate, 0) DESC, position LIMIT 1) AS highest_positive,
 (SELECT aspect FROM aspect_stats ORDER BY coalesce(negative_rate, 0) DESC, position LIMIT 1) AS highest_negative)"""


@query("ag9_aspect_stats", f"{CTE_ANALYSED}, {SQL_ASPECT_STATS} SELECT * FROM aspect_stats")
def aspect_stats(spark, sf):
    return insights.aspect_stats(analysed(spark, sf))


@query("ag9_aspect_highlights", f"{CTE_ANALYSED}, {SQL_ASPECT_STATS}, {SQL_HIGHLIGHTS} SELECT * FROM highlights")
def aspect_highlights(spark, sf):
    return insights.aspect_highlights(insights.aspect_stats(analysed(spark, sf)))


@query(
    "ag10_key_metrics",
    f"""{CTE_SCORED} SELECT count(*) AS reviews, count(DISTINCT pageurl) AS products, count(DISTINCT product_category) AS categories,
 {rounded('avg(rating)', 2)} AS avg_rating FROM scored""",
)
def key_metrics(spark, sf):
    return insights.key_metrics(scored(spark, sf))


SQL_RATINGS = f"""ratings AS (SELECT rating, count, {rounded('count::DOUBLE / everything * 100', 1)} AS pct,
 row_number() OVER (ORDER BY rating IS NULL, count DESC, rating) = 1 AS is_mode FROM (SELECT rating, count(*) AS count,
 (SELECT count(*) FROM reviews) AS everything FROM reviews GROUP BY 1) )"""


@query("ag11_rating_distribution", f"{CTE_REVIEWS}, {SQL_RATINGS} SELECT * FROM ratings WHERE rating IS NOT NULL")
def rating_distribution(spark, sf):
    return insights.rating_distribution(reviews(spark, sf))


@query(
    "ag11_rating_headline",
    f"""{CTE_REVIEWS}, {SQL_RATINGS} SELECT max(rating) FILTER (is_mode) AS mode_rating, max(count) FILTER (rating IS NOT NULL) AS mode_count,
 coalesce(max(pct) FILTER (rating = 5), 0) AS five_star_pct, coalesce(max(count) FILTER (rating = 1), 0) AS one_star_count FROM ratings""",
)
def rating_headline(spark, sf):
    return insights.rating_headline(reviews(spark, sf))


@query(
    "ag12_rating_sentiment_distribution",
    f"""{CTE_SCORED} SELECT rating_sentiment, count(*) AS count, {rounded('count(*)::DOUBLE / (SELECT count(*) FROM scored) * 100', 1)} AS pct
FROM scored WHERE rating_sentiment IS NOT NULL GROUP BY 1""",
)
def rating_sentiment_distribution(spark, sf):
    return insights.rating_sentiment_distribution(scored(spark, sf))


@query(
    "ag13_category_performance",
    f"""{CTE_SCORED}, per AS (SELECT product_category, count(rating) AS reviews, avg(rating) AS avg_rating,
 avg(helpfulness_score) AS avg_helpfulness FROM scored GROUP BY 1 HAVING count(rating) > 50),
sides AS ((SELECT *, 'best' AS side FROM per ORDER BY avg_rating DESC, product_category LIMIT 5)
 UNION ALL (SELECT *, 'worst' AS side FROM per ORDER BY avg_rating, product_category LIMIT 5))
SELECT side, product_category, reviews, {rounded('avg_rating', 6)} AS avg_rating, {rounded('avg_helpfulness', 6)} AS avg_helpfulness FROM sides""",
)
def category_performance(spark, sf):
    out = insights.category_performance(scored(spark, sf))
    return out.withColumns({c: round_to(F.col(c), 6) for c in ("avg_rating", "avg_helpfulness")})


@query(
    "ag14_monthly_trend",
    f"""{CTE_SCORED} SELECT review_year_month, count(rating) AS review_count, {rounded('avg(rating)', 6)} AS avg_rating
FROM scored WHERE review_year_month IS NOT NULL GROUP BY 1""",
)
def monthly_trend(spark, sf):
    return insights.monthly_trend(scored(spark, sf)).withColumn("avg_rating", round_to(F.col("avg_rating"), 6))


@query(
    "ag15_aspect_map",
    f"""{CTE_ANALYSED} SELECT aspect, mentions, {_rate('mentions', 'total', 6)} AS mention_rate,
 {_rate('positive', 'mentions', 6)} AS positive_rate, {_rate('negative', 'mentions', 6)} AS negative_rate FROM grid""",
)
def aspect_map(spark, sf):
    out = aspects.aspect_map(analysed(spark, sf))
    return out.withColumns({c: round_to(F.col(c), 6) for c in ("mention_rate", "positive_rate", "negative_rate")})


def _balance(source: str, keys: str) -> str:
    group = f"GROUP BY {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    return f"""SELECT {lead}min_size, max_size, {rounded('mean', 1)} AS mean_size, {rounded('std', 1)} AS std_size,
 {rounded('std / mean', 3)} AS variation, CASE WHEN std / mean < 0.5 THEN 'good' WHEN std / mean < 1 THEN 'fair' ELSE 'weak' END AS balance
FROM (SELECT {lead}min(n) AS min_size, max(n) AS max_size, avg(n) AS mean, stddev_pop(n) AS std
 FROM (SELECT {lead}cluster, count(*) AS n FROM {source} GROUP BY ALL) {group})"""


@query("ag16_cluster_balance", _balance("(SELECT label AS cluster FROM embeddings)", ""))
def cluster_balance(spark, sf):
    return clusters.cluster_balance(table(spark, sf, "embeddings").withColumnRenamed("label", "cluster"))


@query("ag16_cluster_balance_by_category", f"{CTE_EMBEDDED} {_balance('embedded', 'product_category')}")
def cluster_balance_by_category(spark, sf):
    return clusters.cluster_balance(embedded(spark, sf), ["product_category"])


@query(
    "ag17_coverage",
    f"""{CTE_ANALYSED} SELECT product_category, total_reviews, reviews_with_aspects, {rounded('rate', 2)} AS coverage_rate,
 CASE WHEN rate >= 70 THEN 'good' WHEN rate >= 40 THEN 'fair' ELSE 'weak' END AS coverage_band
FROM (SELECT *, reviews_with_aspects::DOUBLE / total_reviews * 100 AS rate FROM (SELECT s.product_category, count(*) AS total_reviews,
 count(*) FILTER (s.row_id IN (SELECT row_id FROM mentions)) AS reviews_with_aspects FROM scored s GROUP BY 1))""",
)
def coverage(spark, sf):
    return clusters.coverage(analysed(spark, sf), F.size("aspects") > 0, ["product_category"])


@query(
    "ag21_eligible_categories",
    f"""{CTE_SCORED} SELECT product_category, count(*) AS review_count FROM scored
WHERE product_category NOT IN ('Unknown', 'Other') GROUP BY 1 HAVING count(*) >= 50""",
)
def eligible_categories(spark, sf):
    return categories.eligible_categories(scored(spark, sf))


@query(
    "ag21_category_choices",
    f"""{CTE_SCORED} SELECT product_category, count(*) AS review_count FROM scored
WHERE product_category NOT IN ('Unknown', 'Other') GROUP BY 1 HAVING count(*) >= 50 ORDER BY product_category LIMIT 4""",
)
def category_choices(spark, sf):
    return categories.eligible_categories(scored(spark, sf), first=4, by_name=True)


def category_metrics(spark, sf):
    """Stand-in measures per category, from the sentiment figures."""
    rows = insights.category_sentiment(scored(spark, sf))
    return rows.select(
        "product_category",
        (F.col("positive_pct") / 100).alias("squared_silhouette"),
        (F.col("avg_rating") / 5).alias("coherence"),
        F.col("neutral_pct").alias("coverage"),
        round_to(
            clusters.overall_score(F.col("positive_pct") / 100, F.col("avg_rating") / 5, F.col("neutral_pct")), 4
        ).alias("overall_score"),
    )


SQL_METRICS = f"""metrics AS (SELECT product_category, positive_pct / 100 AS squared_silhouette, avg_rating / 5 AS coherence, neutral_pct AS coverage,
 {rounded('((positive_pct / 100 + 1) / 2 + avg_rating / 5 + neutral_pct / 100) / 3', 4)} AS overall_score FROM category_sentiment)"""
_GRADE = "CASE WHEN score >= 0.7 THEN 'A' WHEN score >= 0.55 THEN 'B' WHEN score >= 0.4 THEN 'C' WHEN score >= 0.25 THEN 'D' ELSE 'F' END"


@query(
    "ag22_evaluation_rollup",
    f"""{CTE_SCORED}, {SQL_CATEGORY_SENTIMENT}, {SQL_METRICS},
means AS (SELECT *, ((s + 1) / 2 + c + v / 100) / 3 AS score FROM (SELECT count(*) AS n, avg(squared_silhouette) AS s, avg(coherence) AS c, avg(coverage) AS v FROM metrics))
SELECT n AS categories_evaluated, {rounded('s', 4)} AS avg_squared_silhouette, {rounded('c', 4)} AS avg_coherence, {rounded('v', 1)} AS avg_coverage,
 {rounded('score', 4)} AS overall_score, {_GRADE} AS grade FROM means""",
)
def evaluation_rollup(spark, sf):
    return evaluation.rollup(category_metrics(spark, sf))


@query(
    "ag22_evaluation_extremes",
    f"""{CTE_SCORED}, {SQL_CATEGORY_SENTIMENT}, {SQL_METRICS}
(SELECT 'best' AS side, product_category, overall_score FROM metrics ORDER BY overall_score DESC, product_category LIMIT 5)
UNION ALL (SELECT 'worst', product_category, overall_score FROM metrics ORDER BY overall_score, product_category LIMIT 5)""",
)
def evaluation_extremes(spark, sf):
    return evaluation.extremes(category_metrics(spark, sf))


# --- over time -----------------------------------------------------------------
SQL_TIME = f"""monthly AS (SELECT strftime(review_date, '%Y-%m') AS year_month, {rounded('avg(rating)', 2)} AS avg_rating,
 {rounded('avg(sentiment_score)', 2)} AS avg_sentiment, count(uniq_id) AS review_count FROM scored WHERE review_date IS NOT NULL GROUP BY 1),
steps AS (SELECT *, avg_rating - lag(avg_rating) OVER (ORDER BY year_month) AS step FROM monthly),
time_insights AS (SELECT count(*) AS months_analyzed, CASE WHEN coalesce(min(step), 0) >= 0 THEN 'improving'
 WHEN coalesce(max(step), 0) <= 0 THEN 'declining' ELSE 'fluctuating' END AS trend_direction,
 (SELECT year_month FROM monthly ORDER BY review_count DESC, year_month LIMIT 1) AS peak_month,
 (SELECT year_month FROM monthly ORDER BY avg_rating, year_month LIMIT 1) AS lowest_rating_month,
 (SELECT year_month FROM monthly ORDER BY avg_rating DESC, year_month LIMIT 1) AS highest_rating_month FROM steps)"""


@query("wn2_trend_direction", f"{CTE_SCORED}, {SQL_TIME} SELECT months_analyzed, trend_direction FROM time_insights")
def trend_direction(spark, sf):
    return insights.time_insights(scored(spark, sf)).select("months_analyzed", "trend_direction")


@query("wn3_peak_months", f"{CTE_SCORED}, {SQL_TIME} SELECT * FROM time_insights")
def peak_months(spark, sf):
    return insights.time_insights(scored(spark, sf))


@query("wn3_monthly_figures", f"{CTE_SCORED}, {SQL_TIME} SELECT * FROM monthly")
def monthly_figures(spark, sf):
    return insights.monthly_figures(scored(spark, sf))


@query(
    "wn4_sample_per_category",
    f"""{CTE_SCORED} SELECT row_id, product_category FROM (SELECT row_id, product_category,
 row_number() OVER (PARTITION BY product_category ORDER BY md5(row_id::VARCHAR), row_id) AS rn FROM scored) WHERE rn <= 60""",
)
def sample_categories(spark, sf):
    return sample_per_category(scored(spark, sf), 60).select("row_id", "product_category")


@query(
    "wn5_first_samples",
    f"""{CTE_EMBEDDED}, ranked AS (SELECT cluster, row_id, review, row_number() OVER (PARTITION BY cluster ORDER BY row_id) AS rn FROM embedded)
SELECT cluster, rn::INTEGER AS place, coalesce(md5(review), '') AS digest FROM ranked WHERE rn <= 5 AND review IS NOT NULL""",
)
def first_samples(spark, sf):
    from reviewgrain.operators.scaling import first_per_group

    rows = first_per_group(embedded(spark, sf), ["cluster"], ["row_id"], 5)
    return rows.where(F.col("review").isNotNull()).select("cluster", "place", F.md5("review").alias("digest"))


# --- top-k and sets ------------------------------------------------------------
@query(
    "sl1_best_rated_titles",
    f"""{CTE_SCORED} SELECT title, count(*) AS reviews, {rounded('avg(helpfulness_score)', 6)} AS helpfulness FROM scored WHERE title IS NOT NULL
GROUP BY 1 ORDER BY {rounded('avg(helpfulness_score)', 6)} DESC, title LIMIT 5""",
)
def best_rated_titles(spark, sf):
    rows = scored(spark, sf).where(F.col("title").isNotNull())
    figures = rows.groupBy("title").agg(
        F.count(F.lit(1)).alias("reviews"), round_to(F.avg("helpfulness_score"), 6).alias("helpfulness")
    )
    return insights.top_rows(figures, "helpfulness", 5, ["title"])


_SIMILAR = f"""near_rows AS (SELECT vec_id, {SQL_COSINE} AS similarity FROM (SELECT vec_id, embedding::DOUBLE[] AS a,
 {SQL_FIRST_VECTOR} AS b FROM embeddings))"""


def _selected(threshold: float) -> str:
    return f"""WITH {_SIMILAR}, ranked AS (SELECT *, row_number() OVER (ORDER BY similarity DESC, vec_id) AS rn,
 count(*) FILTER (similarity >= {threshold}) OVER () AS passing FROM near_rows)
SELECT vec_id, {rounded('similarity', 6)} AS similarity, similarity >= {threshold} AS by_threshold FROM ranked
WHERE similarity >= {threshold} OR (passing = 0 AND rn <= 20)"""


def _relevant(spark, sf, threshold):
    rows = retrieval.with_similarity(table(spark, sf, "embeddings"), first_vector(spark, sf))
    found = retrieval.relevant_rows(rows.select("vec_id", "similarity"), threshold, key="vec_id")
    return found.select("vec_id", round_to(F.col("similarity"), 6).alias("similarity"), "by_threshold")


@query("sl2_relevant_rows", _selected(0.3))
def relevant_rows(spark, sf):
    return _relevant(spark, sf, 0.3)


@query("sl2_nearest_fallback", _selected(1.5))
def nearest_fallback(spark, sf):
    return _relevant(spark, sf, 1.5)


@query(
    "sl3_most_common_words",
    r"""SELECT word, count(*) AS count FROM (SELECT unnest(list_filter(string_split_regex(lower(text), '[\t-\r\x1c-\x20\x85\p{Z}]+'),
 lambda t: t <> '')) AS word FROM documents) GROUP BY 1 ORDER BY count(*) DESC, word LIMIT 25""",
)
def most_common_words(spark, sf):
    words = sentiment.word_rows(table(spark, sf, "documents"), [], "text")
    return categories.value_counts(words, "word").limit(25)


@query(
    "so1_category_choices",
    f"{CTE_SCORED} SELECT DISTINCT product_category FROM scored WHERE product_category NOT IN ('Unknown', 'Other')",
)
def distinct_categories(spark, sf):
    return categories.distinct_values(scored(spark, sf), "product_category")


@query("so1_distinct_urls", "SELECT DISTINCT url FROM pages WHERE url NOT IN ('Unknown', 'Other')")
def distinct_urls(spark, sf):
    return categories.distinct_values(table(spark, sf, "pages"), "url")


@query(
    "so2_unlabelled_documents",
    "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels",
)
def unlabelled_documents(spark, sf):
    return enrichment.not_in(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")


@query(
    "so3_append_documents",
    """SELECT 'doc' || doc_id AS doc_id, lang AS category FROM documents
UNION ALL SELECT 'item' || item_id, 'benchmark' FROM benchmark""",
)
def append_documents(spark, sf):
    from reviewgrain.sources.aspect_store import add_documents

    stored = table(spark, sf, "documents").select(
        F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("doc_id"), F.col("lang").alias("category")
    )
    new = table(spark, sf, "benchmark").select(
        F.concat(F.lit("item"), F.col("item_id").cast("string")).alias("doc_id"), F.lit("benchmark").alias("category")
    )
    return add_documents(stored, new)
