"""Vector, clustering and cluster-quality queries over the given vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import (
    CTE_EMBEDDED,
    CTE_SCORED,
    embedded,
    query,
    reviews,
    rounded,
    scored,
    sql_tokens,
    table,
)
from registry.joins import SQL_FIRST_VECTOR, first_vector
from registry.textual import sql_simple_sentiment
from reviewgrain.functions import numeric, vectors
from reviewgrain.functions.numeric import round_to
from reviewgrain.operators import clusters, retrieval, search_index, sentiment, silhouettes
from reviewgrain.plans import discovery
from reviewgrain.sources import encodings


def labelled(spark, sf):
    """The given vectors with their label as cluster."""
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("row_id"), "embedding", F.col("label").cast("long").alias("cluster")
    )


CTE_VECTORS = "WITH points AS MATERIALIZED (SELECT vec_id AS row_id, label::BIGINT AS cluster, embedding::DOUBLE[] AS v FROM embeddings)"


# --- vectors ---------------------------------------------------------------------
@query("ml1_hashed_vectors")
def hashed_vectors(spark, sf):
    rows = scored(spark, sf).select("row_id", "review")
    encoded = encodings.encode_hashed(encodings.hashed_model(rows), rows)
    return encoded.select("row_id", F.size("embedding").alias("dimensions"), round_to(vectors.norm(F.col("embedding")), 4).alias("norm"))


@query(
    "ml1_stored_vectors",
    f"""{CTE_EMBEDDED} SELECT row_id, len(v)::INTEGER AS dimensions, {rounded('sqrt(list_inner_product(v, v))', 5)} AS norm FROM embedded""",
)
def stored_vectors(spark, sf):
    stored = table(spark, sf, "embeddings").withColumnRenamed("vec_id", "row_id")
    rows = encodings.join_stored(reviews(spark, sf).select("row_id"), stored, "row_id")
    return rows.select("row_id", F.size("embedding").alias("dimensions"), round_to(vectors.norm(F.col("embedding")), 5).alias("norm"))


@query("ml2_reduced_vectors")
def reduced_vectors(spark, sf):
    rows = encodings.reduce_dimensions(labelled(spark, sf), 10)
    return rows.select("row_id", F.size("reduced").alias("dimensions"), F.round(vectors.norm(F.col("reduced")), 3).alias("norm"))


@query("ml3_kmeans")
def kmeans(spark, sf):
    points = labelled(spark, sf).drop("cluster")
    found = discovery.best_kmeans(points, 5, "embedding", tries=3)
    return found.select("row_id", F.col("cluster").cast("int").alias("cluster"))


def _seeded(spark, sf):
    return embedded(spark, sf).select("row_id", "product_category", "embedding")


@query(
    "ml4_assign_step",
    f"""{CTE_EMBEDDED}, seeds AS (SELECT product_category, rn - 1 AS cluster, v AS center FROM
 (SELECT *, row_number() OVER (PARTITION BY product_category ORDER BY md5('42:' || row_id::VARCHAR), row_id) AS rn FROM embedded) WHERE rn <= 3),
gaps AS (SELECT e.row_id, e.product_category, s.cluster, list_distance(e.v, s.center) ** 2 AS cost
 FROM embedded e JOIN seeds s ON s.product_category = e.product_category),
best AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY cost, cluster) AS rn FROM gaps)
SELECT row_id, product_category, cluster::INTEGER AS cluster, {rounded('cost', 5)} AS cost FROM best WHERE rn = 1""",
)
def assign_step(spark, sf):
    from reviewgrain.operators.scaling import cut_lineage

    points = _seeded(spark, sf)
    centers = cut_lineage(clusters.initial_centers(points, ["product_category"], 3, "row_id", "embedding"))
    assigned = clusters.assign(points, centers, ["product_category"], "row_id", "embedding")
    return assigned.select("row_id", "product_category", "cluster", round_to(F.col("cost"), 5).alias("cost"))


_NEAREST = """(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY cost, cluster) AS rn
 FROM (SELECT e.row_id, e.product_category, e.v, c.cluster, list_distance(e.v, c.center) ** 2 AS cost
 FROM embedded e JOIN {centers} c ON c.product_category = e.product_category)) WHERE rn = 1)"""


@query(
    "ml4_one_round",
    f"""{CTE_EMBEDDED}, seeds AS MATERIALIZED (SELECT product_category, rn - 1 AS cluster, v AS center FROM
 (SELECT *, row_number() OVER (PARTITION BY product_category ORDER BY md5('42:' || row_id::VARCHAR), row_id) AS rn FROM embedded) WHERE rn <= 3),
first_round AS MATERIALIZED {_NEAREST.format(centers='seeds')},
moved AS MATERIALIZED (SELECT product_category, cluster, list(m ORDER BY i) AS center FROM (SELECT product_category, cluster, i, avg(v[i]) AS m
 FROM first_round, range(1, 65) t(i) GROUP BY ALL) GROUP BY ALL)
SELECT row_id, product_category, cluster::INTEGER AS cluster, {rounded('cost', 5)} AS cost FROM {_NEAREST.format(centers='moved')}""",
)
def one_round(spark, sf):
    found = clusters.grouped_kmeans(_seeded(spark, sf), ["product_category"], 3, iterations=1)
    return found.select("row_id", "product_category", "cluster", round_to(F.col("cost"), 5).alias("cost"))


@query("ml4_grouped_kmeans")
def grouped_kmeans(spark, sf):
    found = clusters.grouped_kmeans(_seeded(spark, sf), ["product_category"], 3, iterations=5)
    return found.groupBy("product_category", "cluster").agg(
        F.count(F.lit(1)).alias("size"), F.round(F.sum("cost"), 3).alias("cost")
    )


@query("ml4_grouped_kmeans_tries")
def grouped_kmeans_tries(spark, sf):
    found = clusters.grouped_kmeans(_seeded(spark, sf), ["product_category"], 3, iterations=3, tries=3)
    return found.groupBy("product_category").agg(F.count(F.lit(1)).alias("size"), F.round(F.sum("cost"), 3).alias("cost"))


@query(
    "ml5_cosine_to_center",
    f"""{CTE_VECTORS}, centers AS (SELECT cluster, list(m ORDER BY i) AS c FROM (SELECT cluster, i, avg(v[i]) AS m
 FROM points, range(1, 65) t(i) GROUP BY 1, 2) GROUP BY 1)
SELECT row_id, {rounded('list_cosine_similarity(p.v, c.c)', 6)} AS similarity FROM points p JOIN centers c ON c.cluster = p.cluster""",
)
def cosine_to_center(spark, sf):
    from reviewgrain.operators.scaling import attach_derived

    points = labelled(spark, sf)
    centers = clusters.cluster_sums(points, []).select("cluster", "mean")
    rows = attach_derived(points, centers, ["cluster"], "row_id", "inner")
    return rows.select("row_id", round_to(vectors.cosine(F.col("embedding"), F.col("mean")), 6).alias("similarity"))


_SEARCH = f"""near_rows AS (SELECT row_id, {{extra}} list_cosine_similarity(v, {SQL_FIRST_VECTOR}) AS similarity FROM {{source}})
SELECT row_id, {{extra}} {rounded('similarity', 6)} AS similarity FROM near_rows {{where}} ORDER BY similarity DESC, row_id LIMIT {{k}}"""


@query("ml6_search", f"{CTE_VECTORS}, {_SEARCH.format(extra='', source='points', where='', k=5)}")
def search(spark, sf):
    hits = retrieval.search(labelled(spark, sf), first_vector(spark, sf), 5, key="row_id")
    return hits.select("row_id", round_to(F.col("similarity"), 6).alias("similarity"))


@query(
    "ml6_search_in_category",
    CTE_EMBEDDED + ", " + _SEARCH.format(
        extra="product_category,", source="embedded", where="WHERE lower(product_category) = 'electronics'", k=10
    ),
)
def search_in_category(spark, sf):
    docs = embedded(spark, sf).withColumnRenamed("product_category", "category")
    hits = retrieval.search(docs, first_vector(spark, sf), 10, "ELECTRONICS", key="row_id")
    return hits.select("row_id", F.col("category").alias("product_category"), round_to(F.col("similarity"), 6).alias("similarity"))


@query(
    "ml6_indexed_search",
    f"""{CTE_VECTORS}, scored_pairs AS (SELECT q.row_id AS query, d.row_id, list_cosine_similarity(d.v, q.v) AS s FROM points q JOIN points d ON q.row_id % 100 = 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY s DESC, row_id) AS place FROM scored_pairs)
SELECT query, row_id, place, {rounded('s', 6)} AS similarity, true AS all_rows_known FROM placed WHERE place <= 5""",
)
def indexed_search(spark, sf):
    """Every row whose id is divisible by 100 against all rows, through the index; no query was compared with more rows than there are."""
    rows = labelled(spark, sf)
    index = search_index.build(rows, "row_id")
    hits = search_index.search_many(index, rows.where("row_id % 100 = 0"))
    total = sum(n for _, n, _ in index.cells)
    return hits.select("query", "row_id", "place", round_to(F.col("similarity"), 6).alias("similarity"), (F.col("compared") <= total).alias("all_rows_known"))


CTE_NEAR = f"""{CTE_EMBEDDED}, near_rows AS MATERIALIZED (SELECT *, list_cosine_similarity(v, {SQL_FIRST_VECTOR}) AS similarity
 FROM embedded WHERE review IS NOT NULL AND review <> '')"""


def near_reviews(spark, sf):
    """Reviews with their similarity to the first vector, which stands for an aspect name."""
    rows = discovery.select_reviews(embedded(spark, sf))
    return retrieval.with_similarity(rows, first_vector(spark, sf))


@query(
    "ml7_aspect_by_name",
    f"""{CTE_NEAR}, relevant AS (SELECT *, 1 AS one FROM near_rows WHERE similarity >= 0.3)
SELECT 'sound quality' AS aspect_name, (SELECT count(*) FROM near_rows) AS total_reviews_analyzed, review_count AS relevant_reviews_count,
 (SELECT {rounded('avg(similarity)', 6)} FROM relevant) AS avg_similarity, positive_pct, negative_pct, neutral_pct, mixed_count,
 review_count::VARCHAR || ' reviews about sound quality.' AS summary, true AS success
FROM {sql_simple_sentiment('relevant', 'one')}""",
)
def aspect_by_name(spark, sf):
    found = discovery.aspect_by_name(near_reviews(spark, sf), "sound quality")
    return found.withColumn("avg_similarity", round_to(F.col("avg_similarity"), 6))


@query(
    "ml7_relevance_samples",
    f"""{CTE_NEAR} SELECT row_id, md5(review) AS digest, {rounded('similarity', 3)} AS similarity FROM near_rows
WHERE similarity >= 0.3 ORDER BY row_id LIMIT 5""",
)
def relevance_samples(spark, sf):
    relevant = retrieval.relevant_rows(near_reviews(spark, sf))
    return retrieval.relevance_samples(relevant).select("row_id", F.md5("review").alias("digest"), "similarity")


# --- quality -----------------------------------------------------------------------
def _sql_silhouette(source: str, gap: str, group: str) -> str:
    """Brute force over all pairs, for the check only."""
    same = f"a.{group} = b.{group}" if group else "true"
    lead = f"{group}, " if group else ""
    tail = f"GROUP BY {group}" if group else ""
    return f"""pairs AS (SELECT a.row_id, {'a.' + group + ',' if group else ''} a.cluster AS own, b.cluster AS other, sum({gap}) AS total, count(*) AS n
 FROM {source} a JOIN {source} b ON {same} GROUP BY ALL),
widths AS (SELECT row_id, {lead} max(n) FILTER (own = other) AS size, count(*) AS k,
 max(total) FILTER (own = other) / nullif(max(n) FILTER (own = other) - 1, 0) AS a, min(total / n) FILTER (own <> other) AS b FROM pairs GROUP BY ALL),
scores AS (SELECT {lead} max(k) AS n_clusters, CASE WHEN max(k) >= 2 THEN avg(CASE WHEN size > 1 AND greatest(a, b) > 0
 THEN (b - a) / greatest(a, b) ELSE 0.0::DOUBLE END) ELSE 0.0::DOUBLE END AS score FROM widths {tail})"""


_SQUARE = "list_distance(a.v, b.v) ** 2"


@query(
    "ml8_squared_silhouette",
    f"{CTE_VECTORS}, {_sql_silhouette('points', _SQUARE, '')} SELECT n_clusters, {rounded('score', 6)} AS squared_silhouette FROM scores",
)
def squared_silhouette(spark, sf):
    found = clusters.squared_silhouette(labelled(spark, sf))
    return found.withColumn("squared_silhouette", round_to(F.col("squared_silhouette"), 6))


@query(
    "ml8_squared_silhouette_by_category",
    f"""{CTE_EMBEDDED}, {_sql_silhouette('embedded', _SQUARE, 'product_category')}
SELECT product_category, n_clusters, {rounded('score', 6)} AS squared_silhouette FROM scores""",
)
def squared_silhouette_by_category(spark, sf):
    found = clusters.squared_silhouette(embedded(spark, sf), ["product_category"])
    return found.withColumn("squared_silhouette", round_to(F.col("squared_silhouette"), 6))


_EUCLIDEAN = "list_distance(a.v, b.v)"


@query(
    "ml8_silhouette",
    f"{CTE_VECTORS}, {_sql_silhouette('points', _EUCLIDEAN, '')} SELECT n_clusters, {rounded('score', 6)} AS silhouette FROM scores",
)
def euclidean_silhouette(spark, sf):
    found = silhouettes.silhouette(labelled(spark, sf))
    return found.withColumn("silhouette", round_to(F.col("silhouette"), 6))


@query(
    "ml8_silhouette_by_category",
    f"""{CTE_EMBEDDED}, {_sql_silhouette('embedded', _EUCLIDEAN, 'product_category')}
SELECT product_category, n_clusters, {rounded('score', 6)} AS silhouette FROM scores""",
)
def euclidean_silhouette_by_category(spark, sf):
    found = silhouettes.silhouette(embedded(spark, sf), ["product_category"])
    return found.withColumn("silhouette", round_to(F.col("silhouette"), 6))


CTE_CENTERS = f"""{CTE_VECTORS}, long AS (SELECT row_id, cluster, i, v[i] AS x FROM points, range(1, 65) t(i)),
centers AS MATERIALIZED (SELECT cluster, i, avg(x) AS m, count(*) AS n FROM long GROUP BY 1, 2)"""


@query(
    "ml9_calinski_harabasz",
    f"""{CTE_CENTERS}, overall AS (SELECT i, avg(x) AS m FROM long GROUP BY 1),
b AS (SELECT sum(c.n * (c.m - o.m) ** 2) AS between_, count(DISTINCT c.cluster) AS k FROM centers c JOIN overall o USING (i)),
w AS (SELECT sum((l.x - c.m) ** 2) AS within_, count(DISTINCT row_id) AS n FROM long l JOIN centers c ON c.cluster = l.cluster AND c.i = l.i)
SELECT {rounded('(between_ / (k - 1)) / (within_ / (n - k))', 5)} AS calinski_harabasz FROM b, w""",
)
def calinski_harabasz(spark, sf):
    found = clusters.calinski_harabasz(labelled(spark, sf))
    return found.withColumn("calinski_harabasz", round_to(F.col("calinski_harabasz"), 5))


@query(
    "ml10_davies_bouldin",
    f"""{CTE_CENTERS}, gaps AS (SELECT l.row_id, l.cluster, sqrt(sum((l.x - c.m) ** 2)) AS d FROM long l
 JOIN centers c ON c.cluster = l.cluster AND c.i = l.i GROUP BY 1, 2),
spread AS (SELECT cluster, avg(d) AS s FROM gaps GROUP BY 1),
apart AS (SELECT a.cluster AS ca, b.cluster AS cb, sqrt(sum((a.m - b.m) ** 2)) AS d FROM centers a JOIN centers b ON a.i = b.i AND a.cluster <> b.cluster GROUP BY 1, 2),
worst AS (SELECT ca, max((x.s + y.s) / d) AS r FROM apart JOIN spread x ON x.cluster = ca JOIN spread y ON y.cluster = cb GROUP BY 1)
SELECT {rounded('avg(r)', 5)} AS davies_bouldin FROM worst""",
)
def davies_bouldin(spark, sf):
    found = clusters.davies_bouldin(labelled(spark, sf))
    return found.withColumn("davies_bouldin", round_to(F.col("davies_bouldin"), 5))


_COHERENCE = """coherent AS (SELECT {lead} a.cluster, avg(list_cosine_similarity(a.v, b.v)) AS s,
 (1 + sqrt(1 + 8 * count(*))) / 2 AS n FROM {source} a JOIN {source} b ON {same} a.cluster = b.cluster AND a.row_id < b.row_id GROUP BY ALL)"""


@query(
    "ml11_coherence",
    f"""{CTE_VECTORS}, {_COHERENCE.format(lead='', source='points', same='')}
SELECT cluster, round(n)::BIGINT AS n_reviews, {rounded('s', 6)} AS avg_similarity FROM coherent""",
)
def coherence(spark, sf):
    found = clusters.coherence(labelled(spark, sf))
    return found.withColumn("avg_similarity", round_to(F.col("avg_similarity"), 6))


@query(
    "ml11_coherence_by_category",
    f"""{CTE_EMBEDDED}, {_COHERENCE.format(lead='a.product_category,', source='embedded', same='a.product_category = b.product_category AND')}
SELECT product_category, {rounded('avg(s)', 6)} AS coherence, count(*) AS n_clusters_evaluated FROM coherent GROUP BY 1""",
)
def coherence_by_category(spark, sf):
    per_cluster = clusters.coherence(embedded(spark, sf), ["product_category"])
    found = clusters.overall_coherence(per_cluster, ["product_category"])
    return found.withColumn("coherence", round_to(F.col("coherence"), 6))


_WORDS = f"coalesce(len({sql_tokens('review')}), 0)"


@query(
    "ml12_compression",
    f"""{CTE_SCORED}, ranked AS (SELECT *, row_number() OVER (PARTITION BY product_category ORDER BY row_id) AS rn FROM scored),
source AS (SELECT product_category, sum({_WORDS})::BIGINT AS source_words FROM ranked WHERE rn <= 20 GROUP BY 1),
summaries AS (SELECT product_category, count(*)::VARCHAR || ' reviews about ' || product_category || '.' AS review FROM scored GROUP BY 1)
SELECT product_category, {_WORDS}::BIGINT AS summary_words, source_words,
 CASE WHEN source_words > 0 THEN {rounded(f'{_WORDS}::DOUBLE / source_words', 4)} ELSE 0.0::DOUBLE END AS compression_ratio
FROM summaries JOIN source USING (product_category)""",
)
def compression(spark, sf):
    rows = scored(spark, sf)
    samples = sentiment.sample_reviews(rows, ["product_category"], 20)
    sizes = rows.groupBy("product_category").agg(F.count(F.lit(1)).alias("n"))
    summary = sentiment.summary_sentence(F.col("n"), F.col("product_category")).alias("summary")
    both = samples.join(sizes.select("product_category", summary), "product_category")
    return retrieval.compression(both).drop("samples", "summary")


@query("ml12_summary_relevance")
def summary_relevance(spark, sf):
    rows = scored(spark, sf)
    samples = sentiment.sample_reviews(rows, ["product_category"], 20)
    sizes = rows.groupBy("product_category").agg(F.count(F.lit(1)).alias("n"))
    model = encodings.hashed_model(rows.select("review"))
    texts = samples.join(sizes, "product_category").select(
        "product_category",
        sentiment.summary_sentence(F.col("n"), F.col("product_category")).alias("summary"),
        retrieval.combined_source(F.col("samples")).alias("source"),
    )
    for column in ("summary", "source", "product_category"):
        texts = encodings.encode_hashed(model, texts, column, f"v_{column}")
    relevance = vectors.cosine(F.col("v_summary"), F.col("v_source"))
    focus = vectors.cosine(F.col("v_summary"), F.col("v_product_category"))
    return texts.select(
        "product_category",
        F.round(relevance, 4).alias("relevance"),
        numeric.relevance_band(relevance).alias("relevance_band"),
        F.round(focus, 4).alias("focus"),
        numeric.focus_band(focus).alias("focus_band"),
    )


@query(
    "ml13_overall_score",
    f"""SELECT l_orderkey, l_linenumber, {rounded("CASE WHEN l_tax > 0 THEN (parts + l_tax * 10) / 4 ELSE parts / 3 END", 6)} AS overall_score
FROM (SELECT *, (l_discount * 8 + 1) / 2 + l_tax * 5 + l_quantity * 2 / 100 AS parts FROM lineitem)""",
)
def overall_score(spark, sf):
    score = clusters.overall_score(
        F.col("l_discount") * 8, F.col("l_tax") * 5, F.col("l_quantity") * 2, F.col("l_tax") * 10
    )
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", round_to(score, 6).alias("overall_score"))
