"""Topics: fitting, keywords, labels, representatives and look-ups by aspect.

Tables: ``assignments(row_id, topic_id, distance)`` with -1 for outliers, and
``topics(topic_id, size, keywords)`` with one row per topic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewgrain.functions import text, vectors
from reviewgrain.operators import density
from reviewgrain.operators.scaling import attach_derived, first_per_group, store
from reviewgrain.operators.sentiment import word_rows

OUTLIER = -1


# --- fitting ----------------------------------------------------------------
def fit_topics(points: DataFrame, k: int, vector: str = "embedding", seed: int = 42) -> KMeansModel:
    prepared = points.withColumn("_features", array_to_vector(vectors.doubles(F.col(vector))))
    return KMeans(k=k, seed=seed, featuresCol="_features", predictionCol="_raw").fit(prepared)


def assign_topics(
    model: KMeansModel,
    points: DataFrame,
    min_size: int = 50,
    row_id: str = "row_id",
    vector: str = "embedding",
) -> DataFrame:
    """(row_id, topic_id, distance): topics numbered by size, too small ones are outliers."""
    prepared = points.withColumn("_features", array_to_vector(vectors.doubles(F.col(vector))))
    centers = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    table = points.sparkSession.createDataFrame(centers, "_raw int, _center array<double>")
    # the model already holds its k centers on the driver and in every task
    own = model.transform(prepared).join(F.broadcast(table), "_raw")
    rows = own.select(row_id, "_raw", vectors.distance(vector_to_array("_features"), F.col("_center")).alias("distance"))
    return number_topics(rows, "_raw", min_size, row_id)


def number_topics(
    rows: DataFrame, cluster: str, min_size: int = 50, row_id: str = "row_id"
) -> DataFrame:
    """Replace cluster ids by topic ids: biggest is 0, below ``min_size`` rows is -1.

    The window runs over the size table, one row per cluster.
    """
    from pyspark.sql import Window

    sizes = rows.groupBy(cluster).agg(F.count(F.lit(1)).alias("_size"))
    rank = F.row_number().over(Window.orderBy(F.desc("_size"), cluster)) - 1
    numbers = sizes.select(
        cluster, F.when(F.col("_size") < min_size, OUTLIER).otherwise(rank).cast("long").alias("topic_id")
    )
    return attach_derived(rows, numbers, [cluster], row_id, "inner").drop(cluster)


def density_topics(
    points: DataFrame, radius: float, min_rows: int = 5, min_size: int = 50, row_id: str = "row_id", vector: str = "embedding"
) -> DataFrame:
    """(row_id, topic_id): density clusters numbered by size; rows in none of them, or in one below ``min_size`` rows, are outliers."""
    found = store(density.density_clusters(points, radius, min_rows, row_id, vector).select(row_id, "cluster"), "density-topics")
    numbered = number_topics(found.where(F.col("cluster") != OUTLIER), "cluster", min_size, row_id)
    outside = found.where(F.col("cluster") == OUTLIER).select(row_id, F.lit(OUTLIER).cast("long").alias("topic_id"))
    return numbered.select(row_id, "topic_id").unionByName(outside)


def save_model(model: KMeansModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> KMeansModel:
    return KMeansModel.load(path)


# --- descriptions -----------------------------------------------------------
def term_weights(docs: DataFrame, topic: str = "topic_id", review: str = "review") -> DataFrame:
    """Class-based tf-idf: tf(term, topic) x ln(1 + A / f(term)), A the mean words per topic.

    Terms are counted once per (topic, term); everything after works on counts.
    """
    per_topic = word_rows(docs, [topic], review).groupBy(topic, "word").agg(F.count(F.lit(1)).alias("tf"))
    per_term = per_topic.groupBy("word").agg(F.sum("tf").alias("f"))
    sizes = per_topic.groupBy(topic).agg(F.sum("tf").alias("words"))
    mean_words = sizes.agg(F.avg("words").alias("a")).scalar()
    weighted = per_topic.join(per_term, "word")
    return weighted.select(topic, "word", "tf", (F.col("tf") * F.log1p(mean_words / F.col("f"))).alias("weight"))


def top_terms(weights: DataFrame, topic: str = "topic_id", top_n: int = 10) -> DataFrame:
    return first_per_group(weights, [topic], [F.desc("weight"), "word"], top_n)


def describe_topics(docs: DataFrame, topic: str = "topic_id", review: str = "review", top_n: int = 10) -> DataFrame:
    """topics(topic_id, size, keywords) from rows that carry their topic."""
    terms = top_terms(term_weights(docs, topic, review), topic, top_n)
    ordered = F.array_sort(F.collect_list(F.struct("place", "word")))
    keywords = terms.groupBy(topic).agg(F.transform(ordered, lambda s: s["word"]).alias("keywords"))
    sizes = docs.groupBy(topic).agg(F.count(F.lit(1)).alias("size"))
    empty = F.array().cast("array<string>")
    return (
        sizes.join(keywords, topic, "left")
        .withColumn("keywords", F.coalesce("keywords", empty))
        .withColumnRenamed(topic, "topic_id")
        .select("topic_id", "size", "keywords")
    )


def topic_label(topic_id: Column, keywords: Column) -> Column:
    """First three keywords, or ``Topic n`` without any."""
    named = F.array_join(F.slice(keywords, 1, 3), " / ")
    return F.when(F.size(keywords) > 0, named).otherwise(F.concat(F.lit("Topic "), topic_id.cast("string")))


def biggest_topics(topics: DataFrame, top_n: int = 20) -> DataFrame:
    return topics.where(F.col("topic_id") != OUTLIER).orderBy(F.desc("size"), "topic_id").limit(top_n)


def representative_docs(
    docs: DataFrame, n: int = 5, topic: str = "topic_id", row_id: str = "row_id", review: str = "review"
) -> DataFrame:
    """The ``n`` documents of each topic nearest to its center; needs ``distance``."""
    near = first_per_group(docs.where(F.col(topic) != OUTLIER), [topic], ["distance", row_id], n)
    return near.select(topic, "place", row_id, review)


# --- look-ups ---------------------------------------------------------------
def topics_for_category(
    docs: DataFrame, topics: DataFrame, category: str, top_n: int = 5, representatives: int = 3
) -> DataFrame:
    """The most frequent topics among the reviews of one category, with three examples each.

    Everything joined here has at most ``top_n`` or one-per-topic rows.
    """
    wanted = docs.where(
        (F.col("product_category") == category)
        & (F.col("topic_id") != OUTLIER)
        & text.non_empty(F.col("review"))
    )
    counts = wanted.groupBy("topic_id").agg(F.count(F.lit(1)).alias("count"))
    top = counts.orderBy(F.desc("count"), "topic_id").limit(top_n)
    chosen = docs.join(F.broadcast(top.select("topic_id")), "topic_id", "left_semi")
    ordered = F.array_sort(F.collect_list(F.struct("place", "review")))
    examples = (
        representative_docs(chosen, representatives)
        .groupBy("topic_id")
        .agg(F.transform(ordered, lambda s: s["review"]).alias("representative_docs"))
    )
    return (
        top.join(topics.select("topic_id", "keywords"), "topic_id")
        .join(examples, "topic_id", "left")
        .withColumn("label", topic_label(F.col("topic_id"), F.col("keywords")))
        .orderBy(F.desc("count"), "topic_id")
    )


def category_aspect_summary(
    docs: DataFrame, topics: DataFrame, category: str, top_n: int = 5
) -> DataFrame:
    """One row: the category, the number of aspects and a nested list of at most ``top_n``."""
    entry = F.struct(
        (-F.col("count")).alias("order"),
        "topic_id",
        F.col("label").alias("name"),
        F.slice("keywords", 1, 5).alias("keywords"),
        F.col("count").alias("mention_count"),
        F.slice("representative_docs", 1, 2).alias("sample_reviews"),
    )
    return topics_for_category(docs, topics, category, top_n).agg(
        F.lit(category).alias("category"),
        F.count(F.lit(1)).alias("total_aspects"),
        F.array_sort(F.collect_list(entry)).alias("aspects"),
    )


def topics_for_aspect(topics: DataFrame, aspect: str) -> DataFrame:
    """Topics with a keyword that contains the aspect or is contained in it.

    ``relevance`` counts the keywords that contain the aspect; highest first.
    """
    wanted = F.lit(aspect.lower())

    def holds(word: Column) -> Column:
        return F.contains(F.lower(word), wanted)

    either = F.exists("keywords", lambda w: holds(w) | F.contains(wanted, F.lower(w)))
    return (
        topics.where((F.col("topic_id") != OUTLIER) & either)
        .select(
            "topic_id",
            topic_label(F.col("topic_id"), F.col("keywords")).alias("label"),
            "keywords",
            F.size(F.filter("keywords", holds)).cast("long").alias("relevance"),
        )
        .orderBy(F.desc("relevance"), "topic_id")
    )


def keyword_documents(
    docs: DataFrame, pattern: str, first: int | None = None, regex: bool = True, row_id: str = "row_id"
) -> DataFrame:
    """Documents whose text matches, case-insensitively; all, or the ``first`` ones by row id."""
    found = docs.where(text.matches(F.col("review"), pattern, regex))
    return found if first is None else found.orderBy(row_id).limit(first)


def documents_for_aspect(
    docs: DataFrame,
    topics: DataFrame,
    aspect: str,
    max_docs: int | None = None,
    regex: bool = True,
    max_topics: int | None = None,
) -> DataFrame:
    """Documents of the matching topics; a keyword search when no topic matches.

    ``max_topics`` takes only the best matching topics, ``max_docs`` only the first documents.
    """
    best = topics_for_aspect(topics, aspect).select("topic_id")
    best = best if max_topics is None else best.limit(max_topics)
    matched = best.agg(F.count(F.lit(1)).alias("n")).scalar()
    rows = docs.where(text.non_empty(F.col("review")))
    by_topic = rows.join(best, "topic_id", "left_semi")
    by_word = keyword_documents(docs, aspect, None, regex).where(matched == 0)
    found = by_topic.unionByName(by_word)
    return found if max_docs is None else found.orderBy("row_id").limit(max_docs)


def with_topics(docs: DataFrame, assignments: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Documents with text and the topic they were assigned to; documents without an assignment are left out."""
    return docs.where(text.non_empty(F.col("review"))).join(assignments.select(row_id, "topic_id"), row_id)


def keywords_of(topics: DataFrame, topic_id: int, top_n: int = 10) -> DataFrame:
    """Keywords of one topic in rank order."""
    words: Sequence[str] = ["place", "keyword"]
    listed = topics.where(F.col("topic_id") == topic_id).select(F.posexplode("keywords").alias(*words))
    return listed.where(F.col("place") < top_n).orderBy("place").select((F.col("place") + 1).alias("place"), "keyword")
