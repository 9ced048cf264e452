"""The composite jobs end to end."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.aggregates import (
    SQL_ASPECT_STATS,
    SQL_CATEGORY_SENTIMENT,
    SQL_HIGHLIGHTS,
    SQL_PAIN_POINTS,
    SQL_TIME,
    _rate,
)
from registry.base import (
    CTE_ANALYSED,
    CTE_EMBEDDED,
    CTE_REVIEWS,
    RAW_COLUMNS,
    SQL_DERIVED,
    analysed,
    cte_mentions,
    embedded,
    query,
    raw_reviews,
    rounded,
    sql_category,
    sql_label,
    sql_score,
    sql_stamp,
    sql_tokens,
    stamp,
)
from registry.clusters import CTE_NEAR, CTE_VECTORS, _sql_silhouette, labelled, near_reviews
from registry.cleaning import _FILLABLE, _FIRSTS, _sql_valid, sql_clean, sql_mapped, sql_tokenless
from registry.profiling import scraped, url_status
from registry.textual import sql_polarity_table, sql_simple_sentiment
from reviewgrain import lexicons as lx
from reviewgrain.functions.numeric import round_to
from reviewgrain.operators import aspects, categories, sentiment
from reviewgrain.operators.scaling import store
from reviewgrain.plans import discovery, evaluation, preparation, reporting

# --- cleaning, end to end ---------------------------------------------------------
_OTHERS = [c for c in RAW_COLUMNS if c not in lx.TEXT_COLUMNS]
_TYPED = ", ".join(f"{sql_tokenless(sql_clean(c))} AS {c}" for c in lx.TEXT_COLUMNS)
_FILL = ", ".join(f"coalesce(t.{c}, f_{c}) AS {c}" for c in _FILLABLE)
_KEEP = ", ".join(f"t.{c}" for c in RAW_COLUMNS if c not in _FILLABLE and c != "rating")
_FIX_VOTES = ", ".join(f"CASE WHEN coalesce({c}, 0) < 0 THEN 0.0::DOUBLE ELSE coalesce({c}, 0) END AS {c}" for c in lx.VOTE_COLUMNS)
_FIX_STARS = ", ".join(
    f"CAST(round_even(CASE WHEN coalesce({c}, 0) < 0 THEN 0.0::DOUBLE ELSE coalesce({c}, 0)::DOUBLE END, 0) AS BIGINT) AS {c}" for c in lx.STAR_COLUMNS
)
_SPACES = r"[\t-\r\x1c-\x20\x85\p{Z}]"
CTE_PREPROCESSED = rf"""{CTE_REVIEWS},
typed AS MATERIALIZED (SELECT row_id, {', '.join(_OTHERS)}, {_TYPED} FROM reviews),
firsts AS (SELECT pageurl, {_FIRSTS} FROM typed WHERE pageurl IS NOT NULL GROUP BY pageurl),
merged AS (SELECT t.row_id, {_KEEP}, {_FILL}, coalesce(t.rating, (SELECT median(rating) FROM typed)) AS rating
 FROM typed t LEFT JOIN firsts f ON f.pageurl = t.pageurl),
fixed AS MATERIALIZED (SELECT row_id, uniq_id, pageurl, coalesce(title, 'Unknown Product') AS title, review, coalesce(reviewer_name, 'Anonymous') AS reviewer_name,
 CASE WHEN rating < 1 THEN 1.0::DOUBLE WHEN rating > 5 THEN 5.0::DOUBLE ELSE rating END AS rating, {_FIX_VOTES}, {_FIX_STARS},
 {sql_mapped('verified_purchaser', lx.VERIFIED_MAP)} AS verified_purchaser, {sql_mapped('recommended_purchase', lx.RECOMMENDED_MAP)} AS recommended_purchase,
 regexp_replace(lower(website), '^{_SPACES}+|{_SPACES}+$', '', 'g') AS website,
 {_sql_valid('(review_date - INTERVAL 10 YEAR)')} AS review_date, {_sql_valid('(crawl_timestamp - INTERVAL 10 YEAR)')} AS crawl_timestamp FROM merged),
pass1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(RAW_COLUMNS)} ORDER BY row_id) AS rn1 FROM fixed) WHERE rn1 = 1),
pass2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pageurl, reviewer_name, review ORDER BY row_id) AS rn2 FROM pass1) WHERE rn2 = 1),
pass3 AS (SELECT * EXCLUDE (rn1, rn2, rn3) FROM (SELECT *, row_number() OVER (PARTITION BY uniq_id ORDER BY row_id) AS rn3 FROM pass2) WHERE rn3 = 1),
processed AS MATERIALIZED (SELECT *, {SQL_DERIVED} FROM pass3)"""
CTE_FULL = f"""{CTE_PREPROCESSED},
named AS MATERIALIZED (SELECT *, {sql_category('title')} AS first_category FROM processed),
sized AS (SELECT first_category, count(*) AS n FROM named GROUP BY 1),
categorised AS MATERIALIZED (SELECT named.* EXCLUDE (first_category), CASE WHEN n < 10 THEN 'Other' ELSE first_category END AS product_category
 FROM named JOIN sized USING (first_category)),
scored AS MATERIALIZED (SELECT *, {sql_label('sentiment_score')} AS sentiment FROM (SELECT *, {sql_score('review')} AS sentiment_score FROM categorised)),
{cte_mentions('scored')}"""


def processed(spark, sf):
    return preparation.preprocess(raw_reviews(spark, sf))


def stored(rows):
    """Stage boundary: later stages read what the earlier one has written."""
    return store(rows, "stage")


_SHOWN = [
    "row_id", "uniq_id", "pageurl", "title", "rating", "reviewer_name", "review_upvotes", "review_downvotes", *lx.STAR_COLUMNS,
    "verified_purchaser", "recommended_purchase", "website", "product_id", "total_votes", "vote_ratio", "helpfulness_score",
    "review_length", "word_count", "rating_category", "rating_sentiment", "review_year_month",
]


@query(
    "pl1_preprocess",
    f"""{CTE_PREPROCESSED} SELECT {', '.join(_SHOWN)}, md5(review) AS review_digest, {sql_stamp('review_date')} AS review_date,
 {sql_stamp('crawl_timestamp')} AS crawl_timestamp FROM processed""",
)
def preprocess(spark, sf):
    rows = processed(spark, sf)
    return rows.select(*_SHOWN, F.md5("review").alias("review_digest"), stamp("review_date"), stamp("crawl_timestamp"))


@query(
    "pl2_impute",
    f"""{CTE_REVIEWS}, url_status AS (SELECT pageurl AS url, 200 + 204 * max(coalesce(toxic, 0)) AS status FROM reviews WHERE pageurl IS NOT NULL GROUP BY 1),
scraped AS (SELECT url, CASE WHEN status < 400 THEN 'Scraped ' || right(url, 6) END AS title, CASE WHEN status < 400 THEN (length(url) % 5 + 1)::DOUBLE END AS rating FROM url_status WHERE status < 400),
kept AS (SELECT r.* FROM reviews r LEFT JOIN url_status u ON u.url = r.pageurl WHERE u.status IS NULL OR u.status < 400),
filled AS (SELECT k.* REPLACE (coalesce(k.title, s.title) AS title, coalesce(k.rating, s.rating) AS rating) FROM kept k LEFT JOIN scraped s ON s.url = k.pageurl),
inferred AS (SELECT uniq_id, 'Inferred' AS title, 4 AS rating FROM reviews GROUP BY uniq_id),
guessed AS (SELECT f.* REPLACE (CASE WHEN f.title IS NULL OR f.title = 'Unknown Product' THEN i.title ELSE f.title END AS title,
 CASE WHEN f.rating IS NULL OR f.rating = 0 THEN i.rating::DOUBLE ELSE f.rating END AS rating) FROM filled f LEFT JOIN inferred i USING (uniq_id))
SELECT row_id, coalesce(title, 'Unknown Product') AS title, coalesce(rating, (SELECT median(rating) FROM guessed)) AS rating,
 coalesce(reviewer_name, 'Anonymous') AS reviewer_name, coalesce(review_downvotes, 0) AS review_downvotes, coalesce(five_star, 0) AS five_star,
 coalesce(verified_purchaser, 'Unknown') AS verified_purchaser FROM guessed""",
)
def impute(spark, sf):
    rows = raw_reviews(spark, sf)
    inferred = rows.groupBy("uniq_id").agg(F.lit("Inferred").alias("title"), F.lit(4).alias("rating"))
    filled = preparation.impute(rows, url_status(spark, sf), scraped(spark, sf), inferred)
    return filled.select("row_id", "title", "rating", "reviewer_name", "review_downvotes", "five_star", "verified_purchaser")


@query(
    "pl3_categorise",
    f"""{CTE_FULL} SELECT product_category, count(uniq_id) AS review_count, {rounded('avg(rating)', 2)} AS avg_rating,
 sum(review_upvotes) AS review_upvotes, sum(review_downvotes) AS review_downvotes FROM categorised GROUP BY 1""",
)
def categorise(spark, sf):
    return categories.category_summary(preparation.categorise(stored(processed(spark, sf))))


def full(spark, sf):
    """Preprocessed, categorised and analysed reviews."""
    return preparation.analyse(preparation.categorise(stored(processed(spark, sf))))


@query(
    "pl4_analyse_aspects",
    f"""{CTE_FULL} SELECT aspect, mentions, {_rate('mentions', 'total', 2)} AS mention_rate, positive, negative, neutral,
 {_rate('positive - negative', 'mentions', 2)} AS sentiment_score FROM grid""",
)
def analyse_aspects(spark, sf):
    return aspects.aspect_summary(full(spark, sf))


@query(
    "pl4_analyse_categories",
    f"""{CTE_FULL} SELECT product_category, {rounded('avg(sentiment_score)', 3)} AS avg_sentiment, {rounded('stddev_samp(sentiment_score)', 3)} AS sentiment_std,
 {rounded('avg(rating)', 3)} AS avg_rating, count(uniq_id) AS review_count FROM scored GROUP BY 1""",
)
def analyse_categories(spark, sf):
    return sentiment.by_category(full(spark, sf))


def facts(spark, sf):
    """What the report needs of the analysed reviews, stored without their text."""
    return stored(analysed(spark, sf).select(*reporting.FACTS))


SQL_ADVICE = f"""{SQL_CATEGORY_SENTIMENT}, {SQL_PAIN_POINTS}, {SQL_ASPECT_STATS}, {SQL_HIGHLIGHTS}, {SQL_TIME},
biggest AS (SELECT product_category, review_count FROM category_sentiment ORDER BY review_count DESC, product_category LIMIT 3),
advice AS (SELECT 0 AS position, 'high' AS priority, highest_negative AS area,
 'No aspect is blamed as often as ' || highest_negative || '.' AS recommendation,
 'Sort complaints about ' || highest_negative || ' by cause.' AS action FROM highlights WHERE highest_negative IS NOT NULL
UNION ALL SELECT (row_number() OVER (ORDER BY review_count DESC, b.product_category))::INTEGER, 'medium', b.product_category || ': ' || aspect,
 'Within ' || b.product_category || ', most trouble comes from ' || aspect || '.',
 'Look into the ' || negative_rate::VARCHAR || '% of its mentions that are negative.'
 FROM biggest b JOIN pain_points p ON p.product_category = b.product_category AND p.place = 1
UNION ALL SELECT 99, 'high', 'all reviews', 'No month was rated better than the one before it.', 'Find out what changed after the best month.'
 FROM time_insights WHERE trend_direction = 'declining')"""


@query("pl5_recommendations", f"{CTE_ANALYSED}, {SQL_ADVICE} SELECT * FROM advice")
def recommendations(spark, sf):
    return reporting.recommendations(facts(spark, sf))


def _cells(*parts: str) -> str:
    return "'| ' || " + " || ' | ' || ".join(parts) + " || ' |'"


def _known(c: str) -> str:
    return f"coalesce({c}::VARCHAR, 'unknown')"


@query(
    "pl6_report",
    f"""{CTE_ANALYSED}, {SQL_ADVICE},
summary AS (SELECT count(*) AS n, count(DISTINCT product_id) AS p, count(DISTINCT product_category) AS c, {rounded('avg(rating)', 2)} AS r,
 {sql_stamp('min(review_date)')} AS d1, {sql_stamp('max(review_date)')} AS d2 FROM scored),
head AS (SELECT unnest(['# What the reviews say', n || ' reviews of ' || p || ' products in ' || c || ' categories', 'Rated ' || r || ' on average',
 'Written between ' || d1 || ' and ' || d2]) AS line, generate_subscripts([1,2,3,4], 1) - 1 AS ord FROM summary),
trend AS (SELECT unnest(['# Over time', months_analyzed || ' months, ratings ' || trend_direction, 'Busiest: ' || peak_month,
 'Best and worst rated: ' || highest_rating_month || ', ' || lowest_rating_month]) AS line, generate_subscripts([1,2,3,4], 1) - 1 AS ord FROM time_insights)
SELECT 0 AS section, ord::BIGINT AS ord, line FROM head
UNION ALL SELECT 1, -3, '# Categories' UNION ALL SELECT 1, -2, '| category | reviews | % positive | % negative | rating |' UNION ALL SELECT 1, -1, '|:--|--:|--:|--:|--:|'
UNION ALL SELECT 1, place, {_cells('product_category', *map(_known, ('review_count', 'positive_pct', 'negative_pct', 'avg_rating')))}
 FROM (SELECT *, row_number() OVER (ORDER BY review_count DESC, product_category) AS place FROM category_sentiment) WHERE place <= 10
UNION ALL SELECT 2, -3, '# Aspects' UNION ALL SELECT 2, -2, '| aspect | mentions | % positive | % negative | % of reviews |' UNION ALL SELECT 2, -1, '|:--|--:|--:|--:|--:|'
UNION ALL SELECT 2, place, {_cells('aspect', *map(_known, ('mention_count', 'positive_rate', 'negative_rate', 'mention_rate')))}
 FROM (SELECT *, row_number() OVER (ORDER BY mention_count DESC, aspect) AS place FROM aspect_stats) WHERE place <= 10
UNION ALL SELECT 3, ord, line FROM trend
UNION ALL SELECT 4, -1, '# What to do' UNION ALL SELECT 4, position, '* ' || area || ' (' || priority || '): ' || recommendation || ' ' || action FROM advice""",
)
def report(spark, sf):
    return reporting.report_lines(facts(spark, sf))


# --- discovery and evaluation ------------------------------------------------------
@query("pl7_discover_aspects")
def discover_aspects(spark, sf):
    return discovery.discover_aspects(embedded(spark, sf), 4, category="Electronics", tries=3).drop("samples")


@query(
    "pl7_too_few_reviews",
    f"""{CTE_EMBEDDED} SELECT false AS success, 'only ' || count(*) || ' reviews, at least 4 needed' AS error FROM embedded
WHERE contains(lower(product_category), 'no such category')""",
)
def too_few_reviews(spark, sf):
    found = discovery.discover_aspects(embedded(spark, sf), 4, category="no such category", tries=1)
    return found.select("success", "error")


def _sql_by_name(where: str, name: str, threshold: float) -> str:
    """Figures of the reviews at or above the threshold; the check has no fallback branch."""
    return f"""{CTE_NEAR}, rows AS (SELECT * FROM near_rows WHERE {where}),
relevant AS (SELECT *, 1 AS one FROM rows WHERE similarity >= {threshold})
SELECT '{name}' AS aspect_name, (SELECT count(*) FROM rows) AS total_reviews_analyzed, review_count AS relevant_reviews_count,
 (SELECT {rounded('avg(similarity)', 6)} FROM relevant) AS avg_similarity, positive_pct, negative_pct, neutral_pct, mixed_count,
 review_count::VARCHAR || ' reviews about {name}.' AS summary, true AS success FROM {sql_simple_sentiment('relevant', 'one')}"""


@query("pl8_aspect_in_category", _sql_by_name("product_category = 'Electronics'", "sound", 0.0))
def aspect_in_category(spark, sf):
    rows = near_reviews(spark, sf).where(F.col("product_category") == "Electronics")
    found = discovery.aspect_by_name(rows, "sound", 0.0)
    return found.withColumn("avg_similarity", round_to(F.col("avg_similarity"), 6))


def clustered(spark, sf):
    return discovery.cluster_categories(embedded(spark, sf), 3, min_reviews=20, iterations=5)


@query("pl9_aspect_documents")
def all_documents(spark, sf):
    made = discovery.aspect_documents(clustered(spark, sf), F.lit("2020-01-01 00:00:00"))
    return made.drop("embedding", "sample_reviews", "sentiment", "created_at")


@query(
    "pl9_documents_of_given_clusters",
    f"""{CTE_EMBEDDED}, polarity AS (SELECT * FROM {sql_polarity_table('embedded', 'product_category, cluster')}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY product_category, cluster ORDER BY row_id) AS rn FROM embedded),
words AS (SELECT product_category, cluster, unnest({sql_tokens('lower(review)')}) AS word FROM ranked WHERE rn <= 10),
counted AS (SELECT product_category, cluster, word, count(*) AS n FROM words GROUP BY ALL),
top AS (SELECT *, row_number() OVER (PARTITION BY product_category, cluster ORDER BY n DESC, word) AS place FROM counted),
names AS (SELECT product_category, cluster, coalesce(string_agg(word, ' / ' ORDER BY place) FILTER (length(word) > 3), '') AS name
 FROM top WHERE place <= 3 GROUP BY 1, 2),
samples AS (SELECT product_category, cluster, string_agg(md5(review), ' ' ORDER BY rn) AS samples FROM ranked WHERE rn <= 3 GROUP BY 1, 2)
SELECT product_category || '_' || (cluster + 1) AS doc_id, product_category AS category, coalesce(name, '') AS aspect_name,
 review_count::VARCHAR || ' reviews about ' || coalesce(name, '') || '.' AS summary, overall, positive_pct, negative_pct, neutral_pct, review_count,
 coalesce(samples, '') AS samples FROM polarity LEFT JOIN names USING (product_category, cluster) LEFT JOIN samples USING (product_category, cluster)""",
)
def documents_of_given_clusters(spark, sf):
    made = discovery.aspect_documents(embedded(spark, sf), F.lit("2020-01-01 00:00:00"))
    shown = F.array_join(F.transform("sample_reviews", F.md5), " ").alias("samples")
    return made.select("doc_id", "category", "aspect_name", "summary", "sentiment.*", "review_count", shown)


@query(
    "pl9_run_outcome",
    f"""{CTE_EMBEDDED} SELECT product_category AS category, true AS processed, 3::BIGINT AS n_aspects FROM embedded
WHERE product_category NOT IN ('Unknown', 'Other') GROUP BY 1 HAVING count(*) >= 20""",
)
def run_outcome(spark, sf):
    made = discovery.aspect_documents(clustered(spark, sf), F.lit("2020-01-01 00:00:00"))
    return discovery.run_outcome(embedded(spark, sf), made, 20)


def _totals(spark, sf):
    return categories.eligible_categories(embedded(spark, sf), 20).withColumnRenamed("review_count", "total_reviews")


@query("pl10_full_evaluation")
def full_evaluation(spark, sf):
    rows = clustered(spark, sf)
    return evaluation.evaluate_categories(rows, _totals(spark, sf), relevance=evaluation.vector_relevance(rows))


@query("pl10_evaluation_rollup")
def evaluation_rollup(spark, sf):
    return evaluation.rollup(full_evaluation(spark, sf))


def _sql_measures(source: str) -> str:
    """All measures per category from their definitions, over all pairs and dimensions."""
    key = "product_category"
    return f"""{_sql_silhouette(source, 'list_distance(a.v, b.v) ** 2', key)},
long AS (SELECT {key}, row_id, cluster, i, v[i] AS x FROM {source}, range(1, 65) t(i)),
centers AS MATERIALIZED (SELECT {key}, cluster, i, avg(x) AS m, count(*) AS n FROM long GROUP BY ALL),
means AS (SELECT {key}, i, avg(x) AS m FROM long GROUP BY ALL),
sizes AS (SELECT {key}, count(*) AS n, count(DISTINCT cluster) AS k FROM {source} GROUP BY 1),
b AS (SELECT {key}, sum(c.n * (c.m - o.m) ** 2) AS between_ FROM centers c JOIN means o USING ({key}, i) GROUP BY 1),
gaps AS MATERIALIZED (SELECT {key}, row_id, cluster, sum((l.x - c.m) ** 2) AS dd FROM long l JOIN centers c USING ({key}, cluster, i) GROUP BY ALL),
w AS (SELECT {key}, sum(dd) AS within_ FROM gaps GROUP BY 1),
spread AS (SELECT {key}, cluster, avg(sqrt(dd)) AS s FROM gaps GROUP BY 1, 2),
apart AS (SELECT a.{key}, a.cluster AS ca, b.cluster AS cb, sqrt(sum((a.m - b.m) ** 2)) AS d FROM centers a
 JOIN centers b ON a.{key} = b.{key} AND a.i = b.i AND a.cluster <> b.cluster GROUP BY ALL),
db AS (SELECT {key}, avg(r) AS db FROM (SELECT apart.{key}, ca, max((x.s + y.s) / d) AS r FROM apart
 JOIN spread x ON x.{key} = apart.{key} AND x.cluster = ca JOIN spread y ON y.{key} = apart.{key} AND y.cluster = cb GROUP BY ALL) GROUP BY 1),
coh AS (SELECT {key}, avg(s) AS coherence FROM (SELECT a.{key}, a.cluster, avg(list_cosine_similarity(a.v, b.v)) AS s FROM {source} a
 JOIN {source} b ON a.{key} = b.{key} AND a.cluster = b.cluster AND a.row_id < b.row_id GROUP BY ALL) GROUP BY 1),
firsts AS (SELECT {key}, cluster, arg_min(v, row_id) AS v FROM {source} GROUP BY ALL),
rel AS (SELECT {key}, {rounded('avg(c)', 4)} AS relevance FROM (SELECT {key}, cluster, sum(m * f.v[i]) / sqrt(sum(m * m)) / sqrt(sum(f.v[i]::DOUBLE ** 2)) AS c
 FROM centers JOIN firsts f USING ({key}, cluster) GROUP BY ALL) GROUP BY 1),
balance AS (SELECT {key}, {rounded('stddev_pop(n) / avg(n)', 3)} AS variation FROM (SELECT {key}, cluster, count(*) AS n FROM {source} GROUP BY ALL) GROUP BY 1),
measures AS (SELECT {key}, sizes.n AS n_reviews, t.total_reviews, sizes.k AS n_clusters, {rounded('scores.score', 4)} AS squared_silhouette,
 {rounded('(between_ / (k - 1)) / (within_ / (sizes.n - k))', 2)} AS calinski_harabasz, {rounded('db', 4)} AS davies_bouldin,
 {rounded('coherence', 4)} AS coherence, {rounded('sizes.n::DOUBLE / t.total_reviews * 100', 2)} AS coverage, variation, relevance
 FROM sizes JOIN scores USING ({key}) JOIN b USING ({key}) JOIN w USING ({key}) JOIN db USING ({key}) JOIN coh USING ({key})
 JOIN balance USING ({key}) JOIN rel USING ({key}) JOIN totals t USING ({key})),
graded AS (SELECT *, {rounded('raw', 4)} AS overall_score, CASE WHEN raw >= 0.7 THEN 'A' WHEN raw >= 0.55 THEN 'B' WHEN raw >= 0.4 THEN 'C'
 WHEN raw >= 0.25 THEN 'D' ELSE 'F' END AS grade FROM (SELECT *, CASE WHEN relevance > 0 THEN ((squared_silhouette + 1) / 2 + coherence + coverage / 100 + relevance) / 4
 ELSE ((squared_silhouette + 1) / 2 + coherence + coverage / 100) / 3 END AS raw FROM measures))"""


CTE_GRADED = f"""{CTE_EMBEDDED}, totals AS (SELECT product_category, count(*) * 2 AS total_reviews FROM embedded GROUP BY 1),
{_sql_measures('embedded')}"""


def graded(spark, sf):
    """The given clusters, as if they covered half of the reviews."""
    rows = embedded(spark, sf)
    totals = rows.groupBy("product_category").agg((F.count(F.lit(1)) * 2).alias("total_reviews"))
    return evaluation.evaluate_categories(rows, totals, relevance=evaluation.vector_relevance(rows))


@query("pl10_evaluation_of_given_clusters", f"{CTE_GRADED} SELECT * EXCLUDE (raw) FROM graded")
def evaluation_of_given_clusters(spark, sf):
    return graded(spark, sf)


@query(
    "pl10_rollup_of_given_clusters",
    f"""{CTE_GRADED}, averages AS (SELECT *, ((s + 1) / 2 + c + v / 100) / 3 AS score FROM (SELECT count(*) AS n, avg(squared_silhouette) AS s,
 avg(coherence) AS c, avg(coverage) AS v FROM graded))
SELECT n AS categories_evaluated, {rounded('s', 4)} AS avg_squared_silhouette, {rounded('c', 4)} AS avg_coherence, {rounded('v', 1)} AS avg_coverage,
 {rounded('score', 4)} AS overall_score, CASE WHEN score >= 0.7 THEN 'A' WHEN score >= 0.55 THEN 'B' WHEN score >= 0.4 THEN 'C'
 WHEN score >= 0.25 THEN 'D' ELSE 'F' END AS grade FROM averages""",
)
def rollup_of_given_clusters(spark, sf):
    return evaluation.rollup(graded(spark, sf))


@query("pl12_given_clusters_of_category", f"{CTE_GRADED} SELECT * EXCLUDE (raw) FROM graded WHERE product_category = 'Electronics'")
def given_clusters_of_category(spark, sf):
    rows = embedded(spark, sf)
    totals = rows.groupBy("product_category").agg((F.count(F.lit(1)) * 2).alias("total_reviews"))
    return evaluation.evaluate_category(rows, totals, "Electronics", relevance=evaluation.vector_relevance(rows))


def _band(x: str, cuts: tuple[float, ...], names: tuple[str, ...]) -> str:
    whens = " ".join(f"WHEN {x} >= {c} THEN '{n}'" for c, n in zip(cuts, names))
    return f"CASE {whens} ELSE '{names[-1]}' END"


_SIL_BAND = _band("squared_silhouette", (0.5, 0.25), ("good", "fair", "weak"))
_COH_BAND = _band("coherence", (0.6, 0.4, 0.25), ("very_good", "good", "fair", "weak"))


@query(
    "pl11_evaluation_report",
    f"""{CTE_VECTORS}, all_points AS (SELECT *, 'all' AS product_category FROM points),
totals AS (SELECT 'all' AS product_category, count(*) AS total_reviews FROM points),
{_sql_measures('all_points')},
lines AS (SELECT ['# Clusters graded ' || grade || ', score ' || format('{{:.4f}}', overall_score), '| measure | value | reading |', '|:--|--:|:--|',
 '| squared silhouette | ' || format('{{:.4f}}', squared_silhouette) || ' | ' || {_SIL_BAND} || ' |',
 '| dispersion between over within | ' || format('{{:.2f}}', calinski_harabasz) || ' |  |',
 '| closeness of the nearest clusters | ' || format('{{:.4f}}', davies_bouldin) || ' | ' || CASE WHEN davies_bouldin < 1 THEN 'good' WHEN davies_bouldin < 2 THEN 'fair' ELSE 'weak' END || ' |',
 '| similarity inside clusters | ' || format('{{:.4f}}', coherence) || ' | ' || {_COH_BAND} || ' |', '| clusters | ' || n_clusters || ' |  |',
 '| reviews in clusters | ' || n_reviews || ' of ' || total_reviews || ' |  |', '| share in percent | ' || format('{{:.1f}}', coverage) || ' |  |'] AS l FROM graded)
SELECT 0 AS section, (generate_subscripts(l, 1) - 1)::BIGINT AS ord, unnest(l) AS line FROM lines""",
)
def evaluation_report(spark, sf):
    rows = labelled(spark, sf).withColumn("product_category", F.lit("all"))
    totals = rows.groupBy("product_category").agg(F.count(F.lit(1)).alias("total_reviews"))
    metrics = evaluation.with_bands(evaluation.evaluate_categories(rows, totals, relevance=evaluation.vector_relevance(rows)))
    shaped = metrics.withColumnsRenamed({"n_reviews": "reviews_with_aspects", "coverage": "coverage_rate"})
    return reporting.evaluation_lines(shaped)


@query("pl12_category_evaluation")
def category_evaluation(spark, sf):
    rows = clustered(spark, sf)
    return evaluation.evaluate_category(rows, _totals(spark, sf), "Electronics", relevance=evaluation.vector_relevance(rows))


@query(
    "pl13_summarise_aspect",
    f"""SELECT aspect_name AS aspect, relevant_reviews_count AS review_count, summary, CASE WHEN positive_pct > 50 THEN 'positive'
 WHEN negative_pct > 30 THEN 'negative' ELSE 'neutral' END AS sentiment FROM ({_sql_by_name('true', 'sound quality', 0.3)})""",
)
def summarise_aspect(spark, sf):
    return discovery.summarise_aspect(near_reviews(spark, sf), "sound quality")


@query("pl13_top_aspects")
def top_aspects(spark, sf):
    return discovery.top_aspects_for_category(embedded(spark, sf), "Electronics", 3, tries=2).drop("sample_reviews")
