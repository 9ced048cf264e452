"""Join queries: side tables are derived from the reviews themselves."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import CTE_EMBEDDED, CTE_REVIEWS, CTE_SCORED, embedded, query, reviews, rounded, scored, table
from registry.profiling import CTE_SIDE, scraped, url_status
from registry.textual import _MAP, title_map
from reviewgrain import lexicons as lx
from reviewgrain.functions.numeric import round_to
from reviewgrain.operators import categories, clusters, enrichment, retrieval, sentiment, topics
from reviewgrain.operators.scaling import with_row_id


@query(
    "jn2_category_join",
    f"""{CTE_REVIEWS}, {_MAP} SELECT coalesce(m.category, 'Unknown') AS product_category, count(*) AS reviews
FROM reviews r LEFT JOIN title_map m ON r.title = m.title GROUP BY 1""",
)
def category_join(spark, sf):
    rows = categories.assign_from_map(reviews(spark, sf).select("row_id", "title"), title_map(spark, sf))
    return rows.groupBy("product_category").agg(F.count(F.lit(1)).alias("reviews"))


@query(
    "jn3_drop_invalid_urls",
    f"{CTE_REVIEWS}, {CTE_SIDE} SELECT row_id, pageurl FROM reviews WHERE pageurl IS NULL OR pageurl NOT IN (SELECT pageurl FROM invalid)",
)
def drop_invalid_urls(spark, sf):
    bad = url_status(spark, sf).where("status >= 400").withColumnRenamed("url", "pageurl")
    return enrichment.drop_invalid_urls(reviews(spark, sf), bad).select("row_id", "pageurl")


@query(
    "jn4_fill_from_scraped",
    f"""{CTE_REVIEWS}, {CTE_SIDE} SELECT r.row_id, coalesce(r.title, s.title) AS title, coalesce(r.rating, s.rating) AS rating
FROM reviews r LEFT JOIN scraped s ON s.url = r.pageurl AND s.success""",
)
def fill_from_scraped(spark, sf):
    rows = reviews(spark, sf).select("row_id", "pageurl", "title", "rating")
    return enrichment.fill_from_scraped(rows, scraped(spark, sf)).drop("pageurl")


@query(
    "jn4_repeated_records",
    f"""{CTE_REVIEWS}, {CTE_SIDE} SELECT r.row_id, coalesce(r.title, s.title) AS title, coalesce(r.rating, s.rating) AS rating
FROM reviews r LEFT JOIN scraped s ON s.url = r.pageurl AND s.success""",
)
def fill_from_repeated_records(spark, sf):
    """Every page was read twice; the later record counts and no review is repeated."""
    rows = reviews(spark, sf).select("row_id", "pageurl", "title", "rating")
    records = scraped(spark, sf).withColumn("read", F.lit(2))
    earlier = records.withColumns({"title": F.lit("earlier"), "rating": F.lit(0.5), "read": F.lit(1)})
    return enrichment.fill_from_scraped(rows, earlier.unionByName(records), order="read").drop("pageurl")


def seller_record(spark, sf):
    """Fresh values per URL: a title that may be empty and a reviewer name."""
    rows = scraped(spark, sf)
    title = F.when(F.col("rating") > 3, F.col("title")).otherwise("")
    return rows.select(F.col("url").alias("pageurl"), title.alias("title"), F.col("error").alias("reviewer_name"))


_RECORD = """record AS (SELECT url AS pageurl, CASE WHEN rating > 3 THEN title ELSE '' END AS title,
 CASE WHEN NOT success THEN 'not found' END AS reviewer_name FROM scraped)"""


def _fill_sql(overwrite: bool) -> str:
    def one(c: str) -> str:
        guard = "" if overwrite else f" AND (r.{c} IS NULL OR r.{c} = '')"
        return f"CASE WHEN s.{c} IS NOT NULL AND s.{c} <> ''{guard} THEN s.{c} ELSE r.{c} END AS {c}"

    return (
        f"{CTE_REVIEWS}, {CTE_SIDE}, {_RECORD} SELECT r.row_id, {one('title')}, {one('reviewer_name')} "
        "FROM reviews r LEFT JOIN record s ON s.pageurl = r.pageurl"
    )


def _fill(spark, sf, overwrite):
    rows = reviews(spark, sf).select("row_id", "pageurl", "title", "reviewer_name")
    filled = enrichment.fill_record(rows, seller_record(spark, sf), "pageurl", ["title", "reviewer_name"], overwrite)
    return filled.drop("pageurl")


@query("jn5_fill_record", _fill_sql(False))
def fill_record(spark, sf):
    return _fill(spark, sf, False)


@query("jn5_overwrite_record", _fill_sql(True))
def overwrite_record(spark, sf):
    return _fill(spark, sf, True)


@query(
    "jn6_is_complete",
    f"""{CTE_REVIEWS} SELECT row_id, (title IS NOT NULL AND title <> '' AND rating IS NOT NULL AND review IS NOT NULL AND review <> '') AS success
FROM reviews""",
)
def is_complete(spark, sf):
    rows = reviews(spark, sf)
    return rows.select("row_id", enrichment.is_complete(rows, lx.SCRAPABLE_COLUMNS).alias("success"))


_SHARES = ["title", *lx.STAR_COLUMNS]


@query(
    "jn7_fill_title_and_stars",
    f"""{CTE_REVIEWS}, per_url AS (SELECT pageurl, 'Shared title' AS title, {', '.join(f'max({c}) AS {c}' for c in lx.STAR_COLUMNS)}
 FROM reviews WHERE pageurl IS NOT NULL AND quality = 1 GROUP BY pageurl)
SELECT r.row_id, {', '.join(f'coalesce(r.{c}, p.{c}) AS {c}' for c in _SHARES)} FROM reviews r LEFT JOIN per_url p ON p.pageurl = r.pageurl""",
)
def fill_title_and_stars(spark, sf):
    rows = reviews(spark, sf)
    good = rows.where((F.col("quality") == 1) & F.col("pageurl").isNotNull())
    found = good.groupBy("pageurl").agg(F.lit("Shared title").alias("title"), *[F.max(c).alias(c) for c in lx.STAR_COLUMNS])
    return enrichment.fill_missing(rows, found, "pageurl", _SHARES).select("row_id", *_SHARES)


@query(
    "jn8_apply_inferred",
    f"""{CTE_REVIEWS}, needing AS (SELECT uniq_id, min(review) AS review FROM reviews
 WHERE (title IS NULL OR title = 'Unknown Product' OR rating IS NULL OR rating = 0) AND length(review) > 10 GROUP BY uniq_id),
inferred AS (SELECT uniq_id, 'Inferred ' || upper(substring(review, 1, 5)) AS title, length(review) % 6 AS rating FROM needing)
SELECT r.row_id, CASE WHEN (r.title IS NULL OR r.title = 'Unknown Product') AND i.title <> '' THEN i.title ELSE r.title END AS title,
 CASE WHEN (r.rating IS NULL OR r.rating = 0) AND i.rating <> 0 THEN i.rating::DOUBLE ELSE r.rating END AS rating
FROM reviews r LEFT JOIN inferred i ON i.uniq_id = r.uniq_id""",
)
def apply_inferred(spark, sf):
    rows = reviews(spark, sf)
    needing = enrichment.needs_inference(rows).groupBy("uniq_id").agg(F.min("review").alias("review"))
    inferred = needing.select(
        "uniq_id",
        F.concat(F.lit("Inferred "), F.upper(F.substring("review", 1, 5))).alias("title"),
        (F.length("review") % 6).alias("rating"),
    )
    return enrichment.apply_inferred(rows, inferred).select("row_id", "title", "rating")


@query(
    "jn9_rows_of_small_categories",
    f"""{CTE_SCORED} SELECT row_id, product_category FROM scored WHERE product_category IN
 (SELECT product_category FROM scored GROUP BY 1 HAVING count(*) < 100)""",
)
def rows_of_small_categories(spark, sf):
    rows = categories.assign_by_keyword(reviews(spark, sf).select("row_id", "title"))
    return categories.rows_of_small_categories(rows, 100).select("row_id", "product_category")


def first_vector(spark, sf):
    """The vector with the lowest id, as a scalar sub-query."""
    rows = spark.read.parquet(f"{sf}/embeddings.parquet")
    return rows.agg(F.min_by("embedding", "vec_id").alias("q")).scalar()


SQL_FIRST_VECTOR = "(SELECT arg_min(embedding, vec_id) FROM embeddings)::DOUBLE[]"
SQL_COSINE = (
    "CASE WHEN list_inner_product(a, a) * list_inner_product(b, b) > 0 "
    "THEN list_inner_product(a, b) / (sqrt(list_inner_product(a, a)) * sqrt(list_inner_product(b, b))) ELSE 0 END"
)


@query(
    "jn10_query_similarity",
    f"""SELECT vec_id, {rounded(SQL_COSINE, 6)} AS similarity FROM
 (SELECT vec_id, embedding::DOUBLE[] AS a, {SQL_FIRST_VECTOR} AS b FROM embeddings)""",
)
def query_similarity(spark, sf):
    rows = retrieval.with_similarity(table(spark, sf, "embeddings"), first_vector(spark, sf))
    return rows.select("vec_id", round_to(F.col("similarity"), 6).alias("similarity"))


@query(
    "jn11_pairwise_similarity",
    f"""SELECT a.label::BIGINT AS cluster, count(*) AS pairs, {rounded("avg(list_cosine_similarity(a.v, b.v))", 6)} AS avg_similarity
FROM (SELECT *, embedding::DOUBLE[] AS v FROM embeddings) a JOIN (SELECT *, embedding::DOUBLE[] AS v FROM embeddings) b
 ON a.label = b.label AND a.vec_id < b.vec_id GROUP BY 1""",
)
def pairwise_similarity(spark, sf):
    rows = table(spark, sf, "embeddings").withColumn("cluster", F.col("label").cast("long"))
    n = F.col("n_reviews")
    return clusters.coherence(rows).select(
        "cluster",
        (n * (n - 1) / 2).cast("long").alias("pairs"),
        round_to(F.col("avg_similarity"), 6).alias("avg_similarity"),
    )


@query(
    "jn12_cluster_summaries",
    f"""{CTE_EMBEDDED}, summaries AS (SELECT cluster, count(*)::VARCHAR || ' reviews about cluster ' || cluster || '.' AS summary FROM embedded GROUP BY 1)
SELECT e.row_id, s.summary FROM embedded e JOIN summaries s ON s.cluster = e.cluster""",
)
def cluster_summaries(spark, sf):
    from reviewgrain.operators.scaling import attach_derived

    rows = embedded(spark, sf).select("row_id", "cluster")
    sizes = rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    name = F.concat(F.lit("cluster "), F.col("cluster").cast("string"))
    summaries = sizes.select("cluster", sentiment.summary_sentence(F.col("n"), name).alias("summary"))
    return attach_derived(rows, summaries, ["cluster"], "row_id", "inner").select("row_id", "summary")


@query(
    "jn13_topic_documents",
    f"""{CTE_SCORED} SELECT s.row_id, v.label::BIGINT AS topic_id, s.product_category FROM scored s
JOIN embeddings v ON v.vec_id = s.row_id WHERE s.review IS NOT NULL AND s.review <> '' AND s.product_category = 'Electronics'""",
)
def topic_documents(spark, sf):
    assignments = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("row_id"), F.col("label").cast("long").alias("topic_id")
    )
    docs = scored(spark, sf).where(F.col("product_category") == "Electronics")
    return topics.with_topics(docs, assignments).select("row_id", "topic_id", "product_category")


@query(
    "wn6_row_ordinals",
    "SELECT source, count(*) AS documents, count(*) AS ordinals FROM documents GROUP BY 1",
)
def row_ordinals(spark, sf):
    """Documents numbered without a key of their own: as many numbers as documents."""
    numbered = with_row_id(table(spark, sf, "documents").select("source"))
    return numbered.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.count_distinct("row_id").alias("ordinals"))
