"""Category, sentiment and aspect queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import (
    CTE_ANALYSED,
    CTE_EMBEDDED,
    CTE_REVIEWS,
    CTE_SCORED,
    embedded,
    query,
    quoted,
    reviews,
    rounded,
    scored,
    sql_category,
    sql_hits,
    sql_label,
    sql_score,
    sql_tokens,
    table,
)
from reviewgrain import lexicons as lx
from reviewgrain.functions import text
from reviewgrain.operators import aspects, categories, sentiment

PART_LEXICON = {
    "Fasteners": ["bolt", "nut", "screw"],
    "Rings & Seals": ["ring", "seal", "washer"],
    "Warm": ["hot", "red", "large"],
}


@query("tx1_keyword_category", f"{CTE_REVIEWS} SELECT row_id, {sql_category('title')} AS product_category FROM reviews")
def keyword_category(spark, sf):
    rows = categories.assign_by_keyword(reviews(spark, sf).select("row_id", "title"))
    return rows.select("row_id", "product_category")


_PART_CASE = (
    "CASE "
    + " ".join(f"WHEN {sql_hits('lower(p_name)', words)} > 0 THEN '{name}'" for name, words in PART_LEXICON.items())
    + " ELSE 'Other' END"
)


@query("tx1_part_category", f"SELECT p_partkey, {_PART_CASE} AS product_category FROM part")
def part_category(spark, sf):
    rows = categories.assign_by_keyword(table(spark, sf, "part"), PART_LEXICON, title="p_name")
    return rows.select("p_partkey", "product_category")


@query(
    "tx2_consolidate_categories",
    f"""{CTE_SCORED}, sized AS (SELECT product_category, count(*) AS n FROM scored GROUP BY 1)
SELECT row_id, CASE WHEN n < 100 THEN 'Other' ELSE s.product_category END AS product_category
FROM scored s JOIN sized z ON s.product_category = z.product_category""",
)
def consolidate_categories(spark, sf):
    rows = categories.assign_by_keyword(reviews(spark, sf).select("row_id", "title"))
    return categories.consolidate(rows, 100).select("row_id", "product_category")


@query(
    "tx2_consolidate_titles",
    f"""{CTE_REVIEWS}, sized AS (SELECT title, count(*) AS n FROM reviews WHERE title IS NOT NULL GROUP BY 1)
SELECT row_id, CASE WHEN n < 85 THEN 'Other' ELSE s.title END AS title FROM reviews s LEFT JOIN sized z ON s.title = z.title""",
)
def consolidate_titles(spark, sf):
    return categories.consolidate(reviews(spark, sf).select("row_id", "title"), 85, name="title")


@query(
    "tx3_unique_products",
    f"""{CTE_REVIEWS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY row_id) AS rn FROM reviews WHERE title IS NOT NULL)
SELECT title, pageurl AS url, review FROM ranked WHERE rn = 1""",
)
def unique_products(spark, sf):
    return categories.unique_products(reviews(spark, sf))


def title_map(spark, sf):
    """Two rounds of title categories; the later assignment wins."""
    products = categories.unique_products(reviews(spark, sf))
    entry = F.inline(
        F.array(
            F.struct(F.lit(0).alias("round"), F.lit("Early").alias("category")),
            F.struct(F.lit(1).alias("round"), F.concat(F.lit("Group "), F.substring("title", 1, 1)).alias("category")),
        )
    )
    return categories.category_map(products.where(F.length("title") > 10).select("title", entry), "round")


_MAP = """title_map AS (SELECT DISTINCT title, 'Group ' || substring(title, 1, 1) AS category FROM reviews
 WHERE title IS NOT NULL AND length(title) > 10)"""


@query(
    "tx4_category_map",
    f"""{CTE_REVIEWS}, {_MAP} SELECT row_id, coalesce(m.category, 'Unknown') AS product_category
FROM reviews r LEFT JOIN title_map m ON r.title = m.title""",
)
def category_map(spark, sf):
    rows = categories.assign_from_map(reviews(spark, sf).select("row_id", "title"), title_map(spark, sf))
    return rows.select("row_id", "product_category")


@query("tx5_sentiment_score", f"{CTE_REVIEWS} SELECT row_id, {sql_score('review')} AS sentiment_score FROM reviews")
def sentiment_score(spark, sf):
    rows = reviews(spark, sf).select("row_id", "review")
    return rows.select("row_id", text.sentiment_score(F.col("review")).alias("sentiment_score"))


@query("tx6_sentiment_label", f"{CTE_REVIEWS} SELECT row_id, {sql_label(sql_score('review'))} AS sentiment FROM reviews")
def sentiment_label(spark, sf):
    return sentiment.score_reviews(reviews(spark, sf).select("row_id", "review")).select("row_id", "sentiment")


@query("tx7_aspect_mentions", f"{CTE_ANALYSED} SELECT row_id, aspect, keyword FROM mentions")
def aspect_mentions(spark, sf):
    rows = aspects.find_aspects(reviews(spark, sf).select("row_id", "review"))
    return aspects.long_form(rows, ["row_id"]).drop("context")


_WIDE = ", ".join(
    f"coalesce(bool_or(m.aspect = '{a}'), false) AS has_{a}, max(m.sentiment) FILTER (m.aspect = '{a}') AS {a}_sentiment"
    for a in lx.ASPECT_KEYWORDS
)


@query(
    "tx7_aspect_columns",
    f"{CTE_ANALYSED} SELECT s.row_id, {_WIDE} FROM scored s LEFT JOIN mentions m ON m.row_id = s.row_id GROUP BY s.row_id",
)
def aspect_columns(spark, sf):
    rows = aspects.find_aspects(reviews(spark, sf).select("row_id", "review"))
    return aspects.widen(rows).drop("review")


@query("tx8_aspect_sentiment", f"{CTE_ANALYSED} SELECT row_id, aspect, sentiment FROM mentions")
def aspect_sentiment(spark, sf):
    rows = aspects.find_aspects(reviews(spark, sf).select("row_id", "review"))
    return aspects.mentions(rows, ["row_id"]).drop("keyword")


def _drivers(where: str) -> str:
    return f"""{CTE_SCORED}, rows AS (SELECT * FROM scored WHERE {where}),
words AS (SELECT unnest({sql_tokens('lower(review)')}) AS theme FROM rows)
SELECT theme, count(*) AS count, {rounded('count(*)::DOUBLE / (SELECT count(*) FROM rows) * 100', 2)} AS percentage FROM words
WHERE length(theme) > 2 AND NOT list_contains({quoted(lx.DRIVER_STOP_WORDS)}, theme) GROUP BY theme ORDER BY count(*) DESC, theme LIMIT 10"""


@query("tx9_negative_drivers", _drivers("sentiment = 'negative'"))
def negative_drivers(spark, sf):
    return sentiment.drivers(scored(spark, sf))


@query("tx9_category_drivers", _drivers("sentiment = 'positive' AND product_category = 'Electronics'"))
def category_drivers(spark, sf):
    return sentiment.drivers(scored(spark, sf), "positive", "Electronics")


_CLUSTER = "product_category"


def _ranked_words(n_words: int) -> str:
    return f"""words AS (SELECT {_CLUSTER}, unnest({sql_tokens('lower(review)')}) AS word FROM scored),
counted AS (SELECT {_CLUSTER}, word, count(*) AS n FROM words GROUP BY 1, 2),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_CLUSTER} ORDER BY n DESC, word) AS place FROM counted) WHERE place <= {n_words})"""


@query(
    "tx10_cluster_names",
    f"""{CTE_SCORED}, {_ranked_words(3)} SELECT {_CLUSTER},
 coalesce(string_agg(word, ' / ' ORDER BY place) FILTER (length(word) > 3), '') AS aspect_name FROM top GROUP BY 1""",
)
def cluster_names(spark, sf):
    return sentiment.cluster_names(scored(spark, sf), [_CLUSTER])


@query(
    "tx11_summary_sentence",
    f"{CTE_SCORED} SELECT {_CLUSTER}, count(*)::VARCHAR || ' reviews about ' || {_CLUSTER} || '.' AS summary FROM scored GROUP BY 1",
)
def summary_sentence(spark, sf):
    sizes = scored(spark, sf).groupBy(_CLUSTER).agg(F.count(F.lit(1)).alias("n"))
    return sizes.select(_CLUSTER, sentiment.summary_sentence(F.col("n"), F.col(_CLUSTER)).alias("summary"))


_HAS_POS = f"coalesce({sql_hits('lower(review)', lx.CLUSTER_POSITIVE_WORDS)} > 0, false)"
_HAS_NEG = f"coalesce({sql_hits('lower(review)', lx.CLUSTER_NEGATIVE_WORDS)} > 0, false)"


def sql_polarity_table(source: str, keys: str) -> str:
    pct = lambda c: rounded(f"{c}::DOUBLE / review_count * 100", 1)
    return f"""(SELECT *, CASE WHEN positive_pct >= 60 THEN 'positive' WHEN negative_pct >= 40 THEN 'negative'
 WHEN positive_pct > negative_pct THEN 'mixed_positive' WHEN negative_pct > positive_pct THEN 'mixed_negative' ELSE 'neutral' END AS overall
FROM (SELECT *, {pct('positive_count')} AS positive_pct, {pct('negative_count')} AS negative_pct, {pct('neutral_count')} AS neutral_pct
FROM (SELECT {keys}, count(*) AS review_count, count(*) FILTER (p AND NOT n) AS positive_count,
 count(*) FILTER (n AND NOT p) AS negative_count, count(*) FILTER (p = n) AS neutral_count
 FROM (SELECT *, {_HAS_POS} AS p, {_HAS_NEG} AS n FROM {source}) GROUP BY {keys})))"""


@query("tx12_cluster_polarity", f"{CTE_EMBEDDED} SELECT * FROM {sql_polarity_table('embedded', 'cluster')}")
def cluster_polarity(spark, sf):
    return sentiment.cluster_polarity(embedded(spark, sf), ["cluster"])


@query("tx12_category_polarity", f"{CTE_SCORED} SELECT * FROM {sql_polarity_table('scored', 'product_category')}")
def category_polarity(spark, sf):
    return sentiment.cluster_polarity(scored(spark, sf), ["product_category"])


_P2 = f"coalesce({sql_hits('lower(review)', lx.ASPECT_NAME_POSITIVE_WORDS)} > 0, false)"
_N2 = f"coalesce({sql_hits('lower(review)', lx.ASPECT_NAME_NEGATIVE_WORDS)} > 0, false)"


def sql_simple_sentiment(source: str, keys: str) -> str:
    pct = lambda c: rounded(f"({c})::DOUBLE / review_count * 100", 1)
    return f"""(SELECT *, {pct('positive_count')} AS positive_pct, {pct('negative_count')} AS negative_pct,
 {pct('review_count - positive_count - negative_count')} AS neutral_pct FROM (SELECT {keys}, count(*) AS review_count,
 count(*) FILTER (p) AS positive_count, count(*) FILTER (n) AS negative_count, count(*) FILTER (p AND n) AS mixed_count
 FROM (SELECT *, {_P2} AS p, {_N2} AS n FROM {source}) GROUP BY {keys}))"""


@query("tx13_aspect_name_sentiment", f"{CTE_SCORED} SELECT * FROM {sql_simple_sentiment('scored', 'product_category')}")
def aspect_name_sentiment(spark, sf):
    return sentiment.aspect_name_sentiment(scored(spark, sf), ["product_category"])


@query(
    "tx14_cluster_top_words",
    f"""{CTE_SCORED}, {_ranked_words(30)},
kept AS (SELECT *, row_number() OVER (PARTITION BY {_CLUSTER} ORDER BY place) AS rn FROM top
 WHERE length(word) > 2 AND NOT list_contains({quoted(lx.CLUSTER_STOP_WORDS)}, word))
SELECT {_CLUSTER}, string_agg(word, ' ' ORDER BY place) AS top_words FROM kept WHERE rn <= 10 GROUP BY 1""",
)
def cluster_top_words(spark, sf):
    words = sentiment.cluster_top_words(scored(spark, sf), [_CLUSTER])
    return words.where(F.size("top_words") > 0).select(_CLUSTER, F.array_join("top_words", " ").alias("top_words"))


@query(
    "tx15_aspect_name_label",
    f"""{CTE_SCORED} SELECT title, CASE WHEN positive_pct > 50 THEN 'positive' WHEN negative_pct > 30 THEN 'negative' ELSE 'neutral' END AS sentiment
FROM {sql_simple_sentiment('scored', 'title')}""",
)
def aspect_name_label(spark, sf):
    counted = sentiment.aspect_name_sentiment(scored(spark, sf), ["title"])
    label = sentiment.aspect_name_label(F.col("positive_pct"), F.col("negative_pct"))
    return counted.select("title", label.alias("sentiment"))
