"""Input tables, the review view, and helpers that write the check SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewgrain import lexicons as lx
from reviewgrain.operators import aspects, categories, cleaning, sentiment

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL it must agree with where there is one."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


# --- tables -----------------------------------------------------------------
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; one that arrives in a handful of splits is spread over the cores.

    A big table has far more splits than that and is read as it is.
    """
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    few = min(cores // 2, 8)
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < few else rows


# The given tables hold no reviews, so this view makes one review per document:
# a phrase from a short list in front of the whole document text.  The text runs
# unchanged in Spark and DuckDB.
BASE = """
WITH phrase(k, phrase, title) AS (VALUES
 (0,'great quality and fast shipping, works perfect .','Wireless Headphone Speaker'),
 (1,'terrible quality , broke after a week . waste of money','Kitchen Cookware Set'),
 (2,'not good , box was damaged and customer service was useless','Kids Puzzle Game'),
 (3,'love the color and design , easy to install','Running Shoes'),
 (4,'okay size , nothing special','Unknown Product'),
 (5,'cheap price but poor material , refund took long','Vitamin Supplement'),
 (6,'best value ever , highly recommend','Camping Bike Gear'),
 (7,'arrived late , package dented , very disappointed','Organic Snack'),
 (8,'never had a better fit , amazing performance','Dog Toy Bed'),
 (9,'<b>good</b>  but too small ,   setup was difficult','Baby Stroller'),
 (10,'horrible support , warranty is garbage','Office Desk'),
 (11,'no complaints , looks beautiful and works','Plain Item')),
base AS (
SELECT /*+ BROADCAST(p) */ d.doc_id AS row_id,
 CAST(d.doc_id - CASE WHEN d.doc_id % 50 = 49 THEN 1 ELSE 0 END AS STRING) AS uniq_id,
 CASE WHEN d.doc_id % 41 = 0 THEN NULL
      WHEN d.doc_id % 3 = 0 THEN concat('https://shop.example.com/ip/item-', CAST(d.doc_id % 97 AS STRING), '/', CAST(100000 + d.doc_id % 97 AS STRING))
      WHEN d.doc_id % 3 = 1 THEN concat('https://shop.example.com/ip/', CAST(100000 + d.doc_id % 97 AS STRING))
      ELSE concat('https://shop.example.com/p/', CAST(100000000 + d.doc_id % 97 AS STRING), '?x=1') END AS pageurl,
 CASE WHEN d.doc_id % 7 = 0 THEN NULL ELSE p.title END AS title,
 CASE WHEN d.doc_id % 29 = 0 THEN NULL WHEN d.doc_id % 31 = 0 THEN 7.0E0 ELSE CAST(1 + (d.doc_id * 7) % 5 AS DOUBLE) END AS rating,
 CASE WHEN d.doc_id % 23 = 0 THEN NULL ELSE concat(p.phrase, ' ', d.text) END AS review,
 CASE WHEN d.doc_id % 19 = 0 THEN NULL ELSE concat('user', CAST(d.doc_id % 13 AS STRING)) END AS reviewer_name,
 CAST(d.doc_id % 11 - 1 AS DOUBLE) AS review_upvotes,
 CASE WHEN d.doc_id % 37 = 0 THEN NULL ELSE CAST(d.doc_id % 4 AS DOUBLE) END AS review_downvotes,
 CASE d.doc_id % 6 WHEN 0 THEN 'true' WHEN 1 THEN 'No' WHEN 2 THEN '1' WHEN 3 THEN 'Y' WHEN 4 THEN 'FALSE' ELSE NULL END AS verified_purchaser,
 e.ts + INTERVAL '1' MONTH * CAST(CASE WHEN d.doc_id % 43 = 0 THEN 36 ELSE d.doc_id % 14 END AS INT) AS review_date,
 e.ts + INTERVAL '1' MONTH * 15 AS crawl_timestamp,
 CASE WHEN d.doc_id % 2 = 0 THEN ' Shop.Example.COM ' ELSE 'shop.example.com' END AS website,
 CASE d.doc_id % 5 WHEN 0 THEN 'true' WHEN 1 THEN 'TRUE' WHEN 2 THEN 'yes' WHEN 3 THEN 'False' ELSE NULL END AS recommended_purchase,
 CASE WHEN d.doc_id % 4 = 0 THEN NULL ELSE CAST(d.doc_id % 97 AS DOUBLE) / 2 END AS five_star,
 CASE WHEN d.doc_id % 5 = 0 THEN NULL ELSE CAST(d.doc_id % 97 AS DOUBLE) / 4 END AS four_star,
 CASE WHEN d.doc_id % 6 = 0 THEN NULL ELSE CAST(d.doc_id % 97 - 5 AS DOUBLE) END AS three_star,
 CAST(d.doc_id % 97 % 8 AS DOUBLE) AS two_star,
 CASE WHEN d.doc_id % 97 < 10 THEN NULL ELSE CAST(d.doc_id % 97 % 12 AS DOUBLE) END AS one_star,
 CASE WHEN d.doc_id % 17 = 0 THEN 'n/a' ELSE CAST(1 + d.doc_id % 5 AS STRING) END AS rating_text,
 CASE WHEN d.doc_id % 15 = 0 THEN 'not a date' ELSE concat('2020-0', CAST(1 + d.doc_id % 9 AS STRING), '-15') END AS date_text,
 d.lang, d.source, l.quality, l.toxic
FROM {documents} d JOIN phrase p ON p.k = d.doc_id % 12
LEFT JOIN {events} e ON e.event_id = d.doc_id
LEFT JOIN {labels} l ON l.doc_id = d.doc_id)
SELECT * FROM base
"""

# Labelled documents are posted again: quality 0 as an exact copy, toxic 1 under
# a new id with one more upvote.  Spark makes the copies in the same scan.
COPY = 1_000_000_000_000
SQL_REVIEWS = f"""SELECT * FROM base UNION ALL
SELECT * REPLACE (row_id + {COPY} AS row_id) FROM base WHERE quality = 0 UNION ALL
SELECT * REPLACE (row_id + {2 * COPY} AS row_id, uniq_id || 'b' AS uniq_id, review_upvotes + 1 AS review_upvotes) FROM base WHERE toxic = 1"""

RAW_COLUMNS = [
    "uniq_id", "pageurl", "title", "rating", "review", "reviewer_name", "review_upvotes", "review_downvotes",
    "verified_purchaser", "review_date", "crawl_timestamp", "website", "recommended_purchase",
    *lx.STAR_COLUMNS,
]


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The review view; the event join disappears from plans that need no date."""
    dates = spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_id").agg(F.min("ts").alias("ts"))
    base = spark.sql(
        BASE,
        documents=table(spark, sf_dir, "documents"),
        events=dates,
        labels=spark.read.parquet(f"{sf_dir}/labels.parquet"),
    )
    copies = F.array_compact(
        F.array(F.lit(0), F.when(F.col("quality") == 0, 1), F.when(F.col("toxic") == 1, 2))
    )
    posted = base.withColumn("_copy", F.explode_outer(copies))
    renamed = F.col("_copy") == 2
    return posted.withColumns(
        {
            "row_id": F.col("row_id") + F.col("_copy") * F.lit(COPY),
            "uniq_id": F.when(renamed, F.concat("uniq_id", F.lit("b"))).otherwise(F.col("uniq_id")),
            "review_upvotes": F.col("review_upvotes") + renamed.cast("int"),
        }
    ).drop("_copy")


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The review file columns and the row id only."""
    return reviews(spark, sf_dir).select("row_id", *RAW_COLUMNS)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews with derived columns, category and sentiment."""
    return sentiment.score_reviews(
        categories.assign_by_keyword(cleaning.add_derived(reviews(spark, sf_dir)))
    )


def analysed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``scored`` with the aspects array."""
    return aspects.find_aspects(scored(spark, sf_dir))


def embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored reviews that have a stored vector; the vector label serves as cluster."""
    stored = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    vectors = stored.select(
        F.col("vec_id").alias("row_id"), "embedding", F.col("label").cast("long").alias("cluster")
    )
    return scored(spark, sf_dir).join(vectors, "row_id")


# --- SQL text ---------------------------------------------------------------
def rounded(x: str, places: int) -> str:
    return f"(round_even(CAST(({x}) * 1e{places} AS DOUBLE), 0)::DOUBLE / 1e{places})"


def quoted(words: Sequence[str]) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def sql_tokens(x: str) -> str:
    return rf"list_filter(string_split_regex({x}, '[\t-\r\x1c-\x20\x85\p{{Z}}]+'), lambda t: t <> '')"


def sql_hits(x: str, words: Sequence[str]) -> str:
    """Number of listed words contained in ``x``."""
    return f"len(list_filter({quoted(words)}, lambda w: contains({x}, w)))"


def sql_category(title: str) -> str:
    whens = " ".join(
        f"WHEN {sql_hits(f'lower({title})', words)} > 0 THEN '{name}'" for name, words in lx.CATEGORY_KEYWORDS.items()
    )
    return f"CASE {whens} ELSE 'Other' END"


def sql_score(review: str) -> str:
    words = sql_tokens(f"lower({review})")
    p = f"len(list_filter({words}, lambda t: list_contains({quoted(lx.POSITIVE_WORDS)}, t)))"
    n = f"len(list_filter({words}, lambda t: list_contains({quoted(lx.NEGATIVE_WORDS)}, t)))"
    return f"CASE WHEN {review} IS NULL OR {p} + {n} = 0 THEN 0.0::DOUBLE ELSE {rounded(f'({p} - {n})::DOUBLE / ({p} + {n})', 3)} END"


def sql_label(score: str) -> str:
    return f"CASE WHEN {score} > 0.1 THEN 'positive' WHEN {score} < -0.1 THEN 'negative' ELSE 'neutral' END"


def sql_polarity(context: str) -> str:
    p, n = sql_hits(context, lx.POSITIVE_WORDS), sql_hits(context, lx.NEGATIVE_WORDS)
    neg = f"{sql_hits(context, lx.NEGATION_WORDS)} > 0"
    return (
        f"CASE WHEN {p} > {n} THEN CASE WHEN {neg} THEN 'negative' ELSE 'positive' END "
        f"WHEN {n} > {p} THEN CASE WHEN {neg} THEN 'positive' ELSE 'negative' END ELSE 'neutral' END"
    )


def sql_product_id(url: str) -> str:
    tries = ", ".join(
        f"nullif(regexp_extract({url}, '{p}', 1), '')" for p in lx.PRODUCT_ID_PATTERNS
    )
    return f"coalesce({tries})"


def sql_wilson(up: str, total: str) -> str:
    zz = repr(lx.WILSON_Z * lx.WILSON_Z) + "::DOUBLE"
    p = f"({up} / {total})"
    low = (
        f"({p} + {zz} / (2 * {total}) - 1.96::DOUBLE * sqrt(({p} * (1 - {p}) + {zz} / (4 * {total})) / {total}))"
        f" / (1 + {zz} / {total})"
    )
    return f"CASE WHEN {total} > 0 THEN {rounded(f'greatest(0.0::DOUBLE, {low})', 4)} ELSE 0.0::DOUBLE END"


SQL_DERIVED = f"""
 {sql_product_id('pageurl')} AS product_id,
 review_upvotes + review_downvotes AS total_votes,
 CASE WHEN review_upvotes + review_downvotes > 0 THEN review_upvotes / (review_upvotes + review_downvotes) ELSE 0.5::DOUBLE END AS vote_ratio,
 {sql_wilson('review_upvotes', '(review_upvotes + review_downvotes)')} AS helpfulness_score,
 coalesce(length(review), 0)::INTEGER AS review_length,
 coalesce(len({sql_tokens('review')}), 0)::INTEGER AS word_count,
 CASE WHEN rating < 0 THEN NULL WHEN rating <= 2 THEN 'Low' WHEN rating <= 3.5 THEN 'Medium' WHEN rating <= 5 THEN 'High' END AS rating_category,
 CASE WHEN rating < 0 THEN NULL WHEN rating <= 2.5 THEN 'Negative' WHEN rating <= 3.5 THEN 'Neutral' WHEN rating <= 5 THEN 'Positive' END AS rating_sentiment,
 year(review_date)::INTEGER AS review_year, month(review_date)::INTEGER AS review_month,
 strftime(review_date, '%Y-%m') AS review_year_month"""

SQL_BASE = BASE.format(documents="documents", events="events", labels="labels").strip()
CTE_REVIEWS = f"WITH base AS MATERIALIZED ({SQL_BASE}), reviews AS MATERIALIZED ({SQL_REVIEWS})"

CTE_SCORED = f"""{CTE_REVIEWS},
scored AS MATERIALIZED (SELECT *, {sql_label('sentiment_score')} AS sentiment FROM (
 SELECT *, {SQL_DERIVED}, {sql_category('title')} AS product_category, {sql_score('review')} AS sentiment_score FROM reviews))"""


def cte_mentions(source: str) -> str:
    """``mentions``: one row per review and aspect it mentions; ``aspect_list``: the listed aspects."""
    listed = ",\n ".join(f"({i}, '{a}', {quoted(ws)})" for i, (a, ws) in enumerate(lx.ASPECT_KEYWORDS.items()))
    window = (
        "substring(t, greatest(instr(t, kw) - 50, 1), "
        "instr(t, kw) + length(kw) + 50 - greatest(instr(t, kw) - 50, 1))"
    )
    return f"""aspect_list(position, aspect, keywords) AS (VALUES {listed}),
mentions AS MATERIALIZED (SELECT row_id, product_category, position, aspect, kw AS keyword, {sql_polarity('context')} AS sentiment FROM (
 SELECT *, {window} AS context FROM (
  SELECT r.row_id, r.product_category, a.position, a.aspect, r.t, list_filter(a.keywords, lambda k: contains(r.t, k))[1] AS kw
  FROM (SELECT row_id, product_category, lower(review) AS t FROM {source}) r, aspect_list a) WHERE kw IS NOT NULL)),
grid AS MATERIALIZED (SELECT a.position, a.aspect, (SELECT count(*) FROM {source}) AS total, count(m.row_id) AS mentions,
  count(*) FILTER (m.sentiment = 'positive') AS positive, count(*) FILTER (m.sentiment = 'negative') AS negative,
  count(*) FILTER (m.sentiment = 'neutral') AS neutral
 FROM aspect_list a LEFT JOIN mentions m USING (aspect) GROUP BY a.position, a.aspect),
category_grid AS MATERIALIZED (SELECT c.product_category, a.position, a.aspect, c.total, count(m.row_id) AS mentions,
  count(*) FILTER (m.sentiment = 'positive') AS positive, count(*) FILTER (m.sentiment = 'negative') AS negative,
  count(*) FILTER (m.sentiment = 'neutral') AS neutral
 FROM (SELECT product_category, count(*) AS total FROM {source} WHERE product_category IS NOT NULL GROUP BY 1) c CROSS JOIN aspect_list a
 LEFT JOIN mentions m ON m.product_category = c.product_category AND m.aspect = a.aspect
 GROUP BY c.product_category, a.position, a.aspect, c.total)"""


CTE_ANALYSED = f"{CTE_SCORED},\n{cte_mentions('scored')}"

CTE_EMBEDDED = f"""{CTE_SCORED},
embedded AS MATERIALIZED (SELECT s.*, v.embedding::DOUBLE[] AS v, v.label::BIGINT AS cluster
 FROM scored s JOIN embeddings v ON v.vec_id = s.row_id)"""


def sql_stamp(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def stamp(name: str):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)
