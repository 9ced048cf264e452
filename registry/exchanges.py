"""Prompt and response tables; responses are made from the data itself."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import CTE_EMBEDDED, CTE_REVIEWS, CTE_SCORED, embedded, query, reviews, scored, table
from registry.joins import first_vector
from registry.textual import sql_polarity_table
from reviewgrain.operators import categories, exchanges, retrieval, sentiment

NL = "chr(10)"


def _sql_batches(source: str, key: str, size: int) -> str:
    return f"""numbered AS (SELECT *, row_number() OVER (ORDER BY md5({key}::VARCHAR), {key}) - 1 AS o FROM {source}),
batched AS MATERIALIZED (SELECT *, (o // {size})::BIGINT AS batch_id, (o % {size} + 1)::INTEGER AS item FROM numbered)"""


_HEAD = "'Give one descriptive category per product as a numbered list, one line each.' || chr(10)"
_PART_TITLES = "titles AS (SELECT p_name || ' ' || p_partkey AS title, p_brand FROM part)"


def part_titles(spark, sf):
    title = F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string"))
    return table(spark, sf, "part").select(title.alias("title"), "p_brand")


@query(
    "bm1_category_prompts",
    f"""WITH {_PART_TITLES}, {_sql_batches('titles', 'title', 20)}
SELECT batch_id, count(*) AS expected, {_HEAD} || {NL} || 'Products:' || {NL} || string_agg(item || '. ' || title, {NL} ORDER BY item)
 || {NL} || {NL} || 'Categories:' AS prompt FROM batched GROUP BY 1""",
)
def category_prompts(spark, sf):
    return exchanges.category_prompts(part_titles(spark, sf))


@query(
    "bm1_guided_category_prompts",
    f"""{CTE_REVIEWS}, titles AS (SELECT DISTINCT title FROM reviews WHERE title IS NOT NULL), {_sql_batches('titles', 'title', 5)}
SELECT batch_id, count(*) AS expected, {_HEAD} || {NL} || 'Prefer one of these categories: Toys, Food' || {NL} || {NL} || 'Products:' || {NL}
 || string_agg(item || '. ' || title, {NL} ORDER BY item) || {NL} || {NL} || 'Categories:' AS prompt FROM batched GROUP BY 1""",
)
def guided_category_prompts(spark, sf):
    products = categories.unique_products(reviews(spark, sf)).select("title")
    return exchanges.category_prompts(products, 5, ["Toys", "Food"])


def category_answers(spark, sf):
    """Answers to the part prompts: bracketed brands, with a stray line and one item short."""
    rows = exchanges.batches(part_titles(spark, sf), "title", 20)
    mark = F.when(F.col("item") % 2 == 0, ") ").otherwise(". ")
    line = F.concat(F.col("item").cast("string"), mark, F.lit("["), "p_brand", F.lit("]"))
    kept = F.when(F.col("item") < 20, F.struct("item", line.alias("line")))
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(kept)), lambda x: x["line"]), "\n")
    return rows.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("expected"), F.concat(F.lit("Here they are:\n"), lines).alias("response")
    )


@query(
    "bm2_parse_categories",
    f"""WITH {_PART_TITLES}, {_sql_batches('titles', 'title', 20)}
SELECT batch_id, item, CASE WHEN item < 20 THEN p_brand ELSE 'Unknown' END AS category FROM batched""",
)
def parse_categories(spark, sf):
    return exchanges.parse_categories(category_answers(spark, sf))


@query(
    "bm2_categories_by_title",
    f"""WITH {_PART_TITLES}, {_sql_batches('titles', 'title', 20)}
SELECT title, CASE WHEN item < 20 THEN p_brand ELSE 'Unknown' END AS category FROM batched""",
)
def categories_by_title(spark, sf):
    asked = exchanges.batches(part_titles(spark, sf), "title", 20).select("batch_id", "item", "title")
    return asked.join(parse_categories(spark, sf), ["batch_id", "item"]).select("title", "category")


@query(
    "bm3_parse_aspects",
    r"""WITH lines AS (SELECT conv_id * 1000 + turn AS id, unnest(string_split(response, chr(10))) AS line, generate_subscripts(string_split(response, chr(10)), 1) AS i
 FROM (SELECT *, 'Quality : POSITIVE' || chr(10) || role || ': negative' || chr(10) || text || chr(10) || 'quality:Neutral and more' || chr(10) || 'size: big' AS response FROM conversations)),
hits AS (SELECT id, i, lower(regexp_extract(trim(line), '(?i)^(\w+)\s*:\s*(positive|negative|neutral)', 1)) AS aspect,
 lower(regexp_extract(trim(line), '(?i)^(\w+)\s*:\s*(positive|negative|neutral)', 2)) AS sentiment FROM lines)
SELECT id, aspect, arg_max(sentiment, i) AS sentiment FROM hits WHERE aspect <> '' GROUP BY 1, 2""",
)
def parse_aspects(spark, sf):
    response = F.concat(
        F.lit("Quality : POSITIVE\n"), "role", F.lit(": negative\n"), "text", F.lit("\nquality:Neutral and more\nsize: big")
    )
    rows = table(spark, sf, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), response.alias("response")
    )
    return exchanges.parse_aspects(rows, "id")


_INFER = "SELECT row_id, review FROM reviews WHERE (title IS NULL OR title = 'Unknown Product' OR rating IS NULL OR rating = 0) AND length(review) > 10"


@query(
    "bm4_inference_prompts",
    f"""{CTE_REVIEWS}, needing AS ({_INFER}), {_sql_batches('needing', 'row_id', 10)}
SELECT batch_id, count(*) AS expected, 'Infer the product name and a rating from 1 to 5 for each review.' || {NL} || {NL} || 'Reviews:' || {NL}
 || string_agg('Review ' || item || ': ' || replace(review, {NL}, ' '), {NL} ORDER BY item) || {NL} || {NL}
 || 'Answer with a JSON list of {{"title": text, "rating": number}}; use "Generic Product" and 3 where unsure.' AS prompt
FROM batched GROUP BY 1""",
)
def inference_prompts(spark, sf):
    from reviewgrain.operators.enrichment import needs_inference

    return exchanges.inference_prompts(needs_inference(reviews(spark, sf)), "row_id")


@query(
    "bm5_parse_inferred",
    f"""WITH {_PART_TITLES}, {_sql_batches('(SELECT p_partkey, p_brand, p_size FROM part)', 'p_partkey', 10)}
SELECT batch_id, item, CASE WHEN batch_id % 7 = 0 THEN NULL WHEN item > 8 THEN 'Unknown' ELSE p_brand END AS title,
 CASE WHEN batch_id % 7 = 0 THEN NULL WHEN item > 8 THEN '3' ELSE (p_size % 5 + 1)::VARCHAR END AS rating FROM batched""",
)
def parse_inferred(spark, sf):
    """JSON answers two items short, inside other text; every seventh one has no list."""
    rows = exchanges.batches(table(spark, sf, "part"), "p_partkey", 10)
    answer = F.to_json(F.struct(F.col("p_brand").alias("title"), (F.col("p_size") % 5 + 1).alias("rating")))
    kept = F.when(F.col("item") <= 8, F.struct("item", answer.alias("answer")))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(kept)), lambda x: x["answer"]), ",\n")
    block = F.concat(F.lit("Sure:\n["), joined, F.lit("]\nDone."))
    responses = rows.groupBy("batch_id").agg(F.count(F.lit(1)).alias("expected"), block.alias("response"))
    broken = F.when(F.col("batch_id") % 7 == 0, "no idea").otherwise(F.col("response"))
    found = exchanges.parse_inferred(responses.withColumn("response", broken))
    return found.withColumn("rating", F.col("rating").cast("string"))


@query(
    "bm5_event_properties",
    """SELECT event_id, json_extract_string(props, '$.k')::INTEGER AS k FROM events""",
)
def event_properties(spark, sf):
    parsed = F.from_json("props", "struct<k:int>")
    return table(spark, sf, "events").select("event_id", parsed["k"].alias("k"))


@query(
    "bm6_parse_insights",
    """SELECT conv_id, turn, trim(replace('INSIGHT: second ' || role, 'INSIGHT:', '')) AS insight,
 CASE WHEN turn = 0 THEN '' ELSE 'read ' || trim(string_split(text, chr(10))[1]) END AS action FROM conversations""",
)
def parse_insights(spark, sf):
    first = F.trim(F.get(F.split("text", "\n"), 0))
    response = F.concat(
        F.lit("INSIGHT: first\n"),
        F.when(F.col("turn") == 0, "Action: none\n").otherwise(F.concat(F.lit("ACTION: read "), first, F.lit("\n"))),
        F.lit("INSIGHT: second "),
        "role",
    )
    rows = table(spark, sf, "conversations").select("conv_id", "turn", response.alias("response"))
    insight, action = exchanges.parse_insight(F.col("response"))
    return rows.select("conv_id", "turn", insight.alias("insight"), action.alias("action"))


def _sql_bullets(n: int) -> str:
    return f"""ranked AS (SELECT product_category, review, row_number() OVER (PARTITION BY product_category ORDER BY row_id) AS rn FROM scored),
bullets AS (SELECT product_category, string_agg('- ' || review, {NL} ORDER BY rn) FILTER (review IS NOT NULL) AS bullets
 FROM ranked WHERE rn <= {n} GROUP BY 1)"""


@query(
    "bm7_naming_prompts",
    f"""{CTE_SCORED}, {_sql_bullets(10)} SELECT product_category,
 'Name the common aspect of these reviews in 2-3 words:' || {NL} || bullets AS prompt FROM bullets""",
)
def naming_prompts(spark, sf):
    return exchanges.naming_prompts(scored(spark, sf), ["product_category"])


@query(
    "bm7_summary_prompts",
    f"""{CTE_SCORED}, {_sql_bullets(20)} SELECT product_category, 'Summarise in 2-3 sentences what customers say about "'
 || upper(product_category) || '":' || {NL} || bullets AS prompt FROM bullets""",
)
def summary_prompts(spark, sf):
    rows = scored(spark, sf)
    names = rows.select("product_category", F.upper("product_category").alias("aspect_name")).distinct()
    return exchanges.summary_prompts(rows, names, ["product_category"])


_SUMMARIES = """summaries AS (SELECT lang, title AS aspect_name, count(*)::VARCHAR || ' reviews about ' || title || '.' AS summary
 FROM scored WHERE title IS NOT NULL GROUP BY 1, 2)"""


def title_summaries(spark, sf):
    rows = scored(spark, sf).where(F.col("title").isNotNull())
    sizes = rows.groupBy("lang", F.col("title").alias("aspect_name")).agg(F.count(F.lit(1)).alias("n"))
    summary = sentiment.summary_sentence(F.col("n"), F.col("aspect_name")).alias("summary")
    return sizes.select("lang", "aspect_name", summary)


@query(
    "bm7_insight_prompts",
    f"""{CTE_SCORED}, {_SUMMARIES} SELECT lang, 'Aspect: ' || aspect_name || {NL} || 'Summary: ' || summary || {NL}
 || 'Answer with one line INSIGHT: and one line ACTION:' AS prompt FROM summaries""",
)
def insight_prompts(spark, sf):
    return exchanges.insight_prompts(title_summaries(spark, sf), ["lang"])


@query(
    "bm7_overview_prompts",
    f"""{CTE_SCORED}, {_SUMMARIES} SELECT lang, 'Write an overview of 3-5 sentences from these aspects:' || {NL}
 || string_agg('- ' || aspect_name || ': ' || summary, {NL} ORDER BY aspect_name) AS prompt FROM summaries GROUP BY 1""",
)
def overview_prompts(spark, sf):
    return exchanges.overview_prompts(title_summaries(spark, sf), ["lang"], "aspect_name")


CTE_DOCUMENTS = f"""{CTE_EMBEDDED}, polarity AS (SELECT * FROM {sql_polarity_table('embedded', 'product_category, cluster')}),
first_docs AS (SELECT product_category, cluster, arg_min(v, row_id) AS v FROM embedded GROUP BY 1, 2),
aspect_documents AS MATERIALIZED (SELECT p.product_category || '_' || p.cluster AS doc_id, p.product_category AS category, 'cluster ' || p.cluster AS aspect_name,
 p.review_count::VARCHAR || ' reviews about cluster ' || p.cluster || '.' AS summary, p.overall, p.positive_pct, p.negative_pct, p.review_count, f.v
 FROM polarity p JOIN first_docs f USING (product_category, cluster))"""


def aspect_documents(spark, sf):
    """One document per category and cluster, with the vector of its first review."""
    rows = embedded(spark, sf)
    keys = ["product_category", "cluster"]
    polarity = sentiment.cluster_polarity(rows, keys)
    first = rows.groupBy(*keys).agg(F.min_by("embedding", "row_id").alias("embedding"))
    name = F.concat(F.lit("cluster "), F.col("cluster").cast("string"))
    return polarity.join(first, keys).select(
        F.concat("product_category", F.lit("_"), F.col("cluster").cast("string")).alias("doc_id"),
        F.col("product_category").alias("category"),
        name.alias("aspect_name"),
        sentiment.summary_sentence(F.col("review_count"), name).alias("summary"),
        F.struct("overall", "positive_pct", "negative_pct", "neutral_pct").alias("sentiment"),
        "review_count",
        "embedding",
    )


_HITS = """hits AS (SELECT *, row_number() OVER (ORDER BY similarity DESC, doc_id) AS place FROM (SELECT *,
 list_cosine_similarity(v, (SELECT arg_min(embedding, vec_id) FROM embeddings)::DOUBLE[]) AS similarity FROM aspect_documents)
 QUALIFY place <= 5)"""


@query(
    "bm8_retrieved_context",
    f"""{CTE_DOCUMENTS}, {_HITS} SELECT true AS success, 'What about sound?' AS query, count(*) AS n_results,
 string_agg('[' || category || ' / ' || aspect_name || '] ' || summary || ' (' || review_count || ' reviews; ' || overall || ', ' || positive_pct || '% for and ' || negative_pct || '% against' || ')', {NL} ORDER BY place) AS context,
 'What about sound?' || {NL} || string_agg(place || ') ' || aspect_name || ' in ' || category || ': ' || summary || ' It is ' || overall || ', ' || positive_pct || '% for and ' || negative_pct || '% against' || '.', {NL} ORDER BY place) AS response FROM hits""",
)
def retrieved_context(spark, sf):
    hits = retrieval.search(aspect_documents(spark, sf), first_vector(spark, sf), 5)
    return retrieval.retrieved_context(hits, "What about sound?").drop("similarities")


@query("bm8_no_hits", "SELECT false AS success, 'Anything?' AS query, 0::BIGINT AS n_results")
def no_hits(spark, sf):
    hits = retrieval.search(aspect_documents(spark, sf), first_vector(spark, sf), 5, "no such category")
    return retrieval.retrieved_context(hits, "Anything?").select("success", "query", "n_results")


@query(
    "bm9_aspect_prompts",
    f"""{CTE_REVIEWS} SELECT row_id, 'List the aspects of this review as ''aspect: positive/negative/neutral''.' || {NL} || 'Common aspects: '
 || 'quality, price, shipping, packaging, durability, ease_of_use, value, appearance, customer_service' || {NL} || {NL}
 || 'Review: ' || review AS prompt FROM reviews WHERE review IS NOT NULL AND review <> ''""",
)
def aspect_prompts(spark, sf):
    return exchanges.aspect_prompts(reviews(spark, sf))
