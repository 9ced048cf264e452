"""Topic queries; the vector labels serve as given topics."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import CTE_EMBEDDED, embedded, query, rounded, sql_tokens
from registry.clusters import CTE_VECTORS, labelled
from reviewgrain.functions.numeric import round_to
from reviewgrain.operators import density, topics


def given(spark, sf):
    """Embedded reviews with the label as topic; label 9 plays the outliers."""
    topic = F.when(F.col("cluster") == 9, -1).otherwise(F.col("cluster")).cast("long")
    return embedded(spark, sf).withColumn("topic_id", topic)


CTE_TOPICS = f"""{CTE_EMBEDDED},
docs AS MATERIALIZED (SELECT *, CASE WHEN cluster = 9 THEN -1 ELSE cluster END AS topic_id FROM embedded),
words AS (SELECT topic_id, unnest({sql_tokens('lower(review)')}) AS word FROM docs),
tf AS MATERIALIZED (SELECT topic_id, word, count(*) AS tf FROM words GROUP BY 1, 2),
f AS (SELECT word, sum(tf) AS f FROM tf GROUP BY 1),
a AS (SELECT avg(n) AS a FROM (SELECT topic_id, sum(tf) AS n FROM tf GROUP BY 1)),
weights AS MATERIALIZED (SELECT topic_id, word, tf, tf * ln(1 + a / f) AS weight FROM tf JOIN f USING (word), a),
terms AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY weight DESC, word)::INTEGER AS place FROM weights) WHERE place <= 10),
topics AS MATERIALIZED (SELECT d.topic_id, count(*) AS size, coalesce((SELECT list(word ORDER BY place) FROM terms t WHERE t.topic_id = d.topic_id), []) AS keywords
 FROM docs d GROUP BY 1),
labels2 AS (SELECT *, CASE WHEN len(keywords) > 0 THEN array_to_string(keywords[1:3], ' / ') ELSE 'Topic ' || topic_id END AS label FROM topics)"""


def described(spark, sf):
    return topics.describe_topics(given(spark, sf))


@query("ml14_fit_topics")
def fit_topics(spark, sf):
    points = embedded(spark, sf).select("row_id", "embedding")
    model = topics.fit_topics(points, 8)
    found = topics.assign_topics(model, points, min_size=60)
    return found.groupBy("topic_id").agg(F.count(F.lit(1)).alias("size"), F.round(F.avg("distance"), 4).alias("distance"))


@query(
    "ml14_number_topics",
    f"""{CTE_EMBEDDED}, sizes AS (SELECT product_category, count(*) AS n FROM embedded GROUP BY 1),
numbers AS (SELECT product_category, CASE WHEN n < 40 THEN -1 ELSE row_number() OVER (ORDER BY n DESC, product_category) - 1 END AS topic_id FROM sizes)
SELECT row_id, topic_id FROM embedded JOIN numbers USING (product_category)""",
)
def number_topics(spark, sf):
    return topics.number_topics(embedded(spark, sf).select("row_id", "product_category"), "product_category", 40)


RADIUS, MIN_ROWS, MIN_SIZE = 1.12, 3, 5

CTE_DENSITY = f"""{CTE_VECTORS.replace("WITH ", "WITH RECURSIVE ", 1)},
near AS MATERIALIZED (SELECT a.row_id AS a, b.row_id AS b, list_distance(a.v, b.v) AS d FROM points a, points b WHERE list_distance(a.v, b.v) <= {RADIUS}),
counts AS MATERIALIZED (SELECT a, count(*) AS n, count(*) >= {MIN_ROWS} AS core FROM near GROUP BY a),
cores AS MATERIALIZED (SELECT a FROM counts WHERE core),
edges AS MATERIALIZED (SELECT n.a, n.b FROM near n JOIN cores x ON x.a = n.a JOIN cores y ON y.a = n.b),
reach(a, b) AS (SELECT a, a FROM cores UNION SELECT r.a, e.b FROM reach r JOIN edges e ON e.a = r.b),
roots AS MATERIALIZED (SELECT a, min(b) AS root FROM reach GROUP BY a),
border AS (SELECT n.a, arg_min(r.root, struct_pack(d := n.d, b := n.b)) AS root FROM near n JOIN roots r ON r.a = n.b WHERE n.a NOT IN (SELECT a FROM cores) GROUP BY n.a),
density AS MATERIALIZED (SELECT p.row_id, c.n AS near, c.core, coalesce(r.root, b.root, -1) AS cluster FROM points p JOIN counts c ON c.a = p.row_id
 LEFT JOIN roots r ON r.a = p.row_id LEFT JOIN border b ON b.a = p.row_id)"""


@query("ml14_density_clusters", f"{CTE_DENSITY} SELECT row_id, near, core, cluster FROM density")
def density_clusters(spark, sf):
    return density.density_clusters(labelled(spark, sf).select("row_id", "embedding"), RADIUS, MIN_ROWS)


@query(
    "ml14_density_topics",
    f"""{CTE_DENSITY}, sizes AS (SELECT cluster, count(*) AS n FROM density WHERE cluster <> -1 GROUP BY 1),
numbers AS (SELECT cluster, CASE WHEN n < {MIN_SIZE} THEN -1 ELSE row_number() OVER (ORDER BY n DESC, cluster) - 1 END AS topic_id FROM sizes)
SELECT row_id, coalesce(topic_id, -1) AS topic_id FROM density LEFT JOIN numbers USING (cluster)""",
)
def density_topics(spark, sf):
    return topics.density_topics(labelled(spark, sf).select("row_id", "embedding"), RADIUS, MIN_ROWS, MIN_SIZE)


@query("ml15_topic_terms", f"{CTE_TOPICS} SELECT topic_id, place, word, tf, {rounded('weight', 5)} AS weight FROM terms")
def topic_terms(spark, sf):
    found = topics.top_terms(topics.term_weights(given(spark, sf)))
    return found.withColumn("weight", round_to(F.col("weight"), 5))


@query("ml16_topic_labels", f"{CTE_TOPICS} SELECT topic_id, size, label FROM labels2")
def topic_labels(spark, sf):
    label = topics.topic_label(F.col("topic_id"), F.col("keywords")).alias("label")
    return described(spark, sf).select("topic_id", "size", label)


SQL_CENTERED = """centered AS MATERIALIZED (SELECT d.row_id, d.topic_id, d.review, d.product_category, list_distance(d.v, c.c) AS distance FROM docs d
 JOIN (SELECT topic_id, list(m ORDER BY i) AS c FROM (SELECT topic_id, i, avg(v[i]) AS m FROM docs, range(1, 65) t(i) GROUP BY 1, 2) GROUP BY 1) c USING (topic_id)),
near_docs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY distance, row_id)::INTEGER AS place
 FROM centered WHERE topic_id <> -1) WHERE place <= 5)"""


def centered(spark, sf):
    """Given topics with the distance of each document to its topic's mean vector."""
    from reviewgrain.functions import vectors
    from reviewgrain.operators.clusters import mean_vector
    from reviewgrain.operators.scaling import attach_derived

    docs = given(spark, sf)
    centers = docs.groupBy("topic_id").agg(mean_vector(F.col("embedding")).alias("center"))
    beside = attach_derived(docs, centers, ["topic_id"], "row_id", "inner")
    return beside.withColumn("distance", vectors.distance(F.col("embedding"), F.col("center")))


@query("ml17_representative_docs", f"{CTE_TOPICS}, {SQL_CENTERED} SELECT topic_id, place, row_id FROM near_docs")
def representative_docs(spark, sf):
    return topics.representative_docs(centered(spark, sf)).drop("review")


@query("ml18_biggest_topics", f"{CTE_TOPICS} SELECT topic_id, size FROM topics WHERE topic_id <> -1 ORDER BY size DESC, topic_id LIMIT 5")
def biggest_topics(spark, sf):
    return topics.biggest_topics(described(spark, sf), 5).select("topic_id", "size")


_ASPECT = "and"
_MATCHED = f"""matched AS (SELECT topic_id, label, len(list_filter(keywords, lambda k: contains(lower(k), '{_ASPECT}'))) AS relevance FROM labels2
 WHERE topic_id <> -1 AND len(list_filter(keywords, lambda k: contains(lower(k), '{_ASPECT}') OR contains('{_ASPECT}', lower(k)))) > 0)"""


@query("ml19_topics_for_aspect", f"{CTE_TOPICS}, {_MATCHED} SELECT topic_id, label, relevance FROM matched")
def topics_for_aspect(spark, sf):
    return topics.topics_for_aspect(described(spark, sf), "And").drop("keywords")


@query(
    "ml20_documents_for_aspect",
    f"""{CTE_TOPICS}, {_MATCHED}, best AS (SELECT topic_id FROM matched)
SELECT row_id, topic_id FROM docs WHERE review IS NOT NULL AND review <> '' AND topic_id IN (SELECT topic_id FROM best)""",
)
def documents_for_aspect(spark, sf):
    found = topics.documents_for_aspect(given(spark, sf), described(spark, sf), "and", regex=False)
    return found.select("row_id", "topic_id")


@query(
    "ml20_documents_by_keyword",
    f"{CTE_TOPICS} SELECT row_id, topic_id FROM docs WHERE contains(lower(review), 'support')",
)
def documents_by_keyword(spark, sf):
    found = topics.documents_for_aspect(given(spark, sf), described(spark, sf), "Support", regex=False)
    return found.select("row_id", "topic_id")


_FOR_CATEGORY = f"""{CTE_TOPICS}, {SQL_CENTERED},
top AS (SELECT topic_id, count(*) AS count FROM docs WHERE product_category = 'Other' AND topic_id <> -1 AND review IS NOT NULL AND review <> ''
 GROUP BY 1 ORDER BY count(*) DESC, topic_id LIMIT 5)"""


@query(
    "ag19_topics_for_category",
    f"""{_FOR_CATEGORY} SELECT t.topic_id, t.count, l.label, array_to_string(l.keywords, ' ') AS keywords,
 (SELECT string_agg(md5(review), ' ' ORDER BY place) FROM near_docs n WHERE n.topic_id = t.topic_id AND n.place <= 3) AS examples
FROM top t JOIN labels2 l ON l.topic_id = t.topic_id""",
)
def topics_for_category(spark, sf):
    found = topics.topics_for_category(centered(spark, sf), described(spark, sf), "Other")
    return found.select(
        "topic_id",
        "count",
        "label",
        F.array_join("keywords", " ").alias("keywords"),
        F.array_join(F.transform("representative_docs", F.md5), " ").alias("examples"),
    )


@query(
    "ag20_category_aspects",
    f"""{_FOR_CATEGORY} SELECT 'Other' AS category, (SELECT count(*) FROM top) AS total_aspects, l.label AS name,
 array_to_string(l.keywords[1:5], ' ') AS keywords, t.count AS mention_count,
 (SELECT string_agg(md5(review), ' ' ORDER BY place) FROM near_docs n WHERE n.topic_id = t.topic_id AND n.place <= 2) AS examples
FROM top t JOIN labels2 l ON l.topic_id = t.topic_id""",
)
def category_aspects(spark, sf):
    found = topics.category_aspect_summary(centered(spark, sf), described(spark, sf), "Other")
    rows = found.select("category", "total_aspects", F.inline("aspects"))
    return rows.select(
        "category",
        "total_aspects",
        "name",
        F.array_join("keywords", " ").alias("keywords"),
        "mention_count",
        F.array_join(F.transform("sample_reviews", F.md5), " ").alias("examples"),
    )
