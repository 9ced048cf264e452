"""Quality of clustered reviews per category and over all categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewgrain.functions import numeric, vectors
from reviewgrain.functions.numeric import round_to
from reviewgrain.operators import clusters
from reviewgrain.operators.scaling import cut_lineage

GROUP = ["product_category"]


def evaluate_categories(
    assigned: DataFrame,
    totals: DataFrame,
    vector: str = "embedding",
    row_id: str = "row_id",
    relevance: DataFrame | None = None,
) -> DataFrame:
    """One row of measures per category, all of them over all rows.

    ``assigned`` are clustered reviews, ``totals(product_category,
    total_reviews)`` the number of reviews that should have been covered,
    ``relevance(product_category, relevance)`` how well the cluster summaries
    match their reviews; it is the fourth part of the score where it is
    positive.  The silhouette is that of squared distances, which follows from
    sums per cluster; these are stored once and shared.
    """
    sums = cut_lineage(clusters.cluster_sums(assigned, GROUP, vector=vector))
    silhouette = clusters.squared_silhouette(assigned, GROUP, vector=vector, row_id=row_id).drop("n_clusters")
    ch = clusters.calinski_harabasz(assigned, GROUP, sums=sums)
    db = clusters.davies_bouldin(assigned, GROUP, vector=vector, row_id=row_id, sums=sums)
    coherent = clusters.overall_coherence(clusters.coherence(assigned, GROUP, vector=vector), GROUP)
    balance = clusters.cluster_balance(assigned, GROUP, sums=sums)
    sizes = sums.groupBy(*GROUP).agg(F.sum("n").alias("n_reviews"), F.count(F.lit(1)).alias("n_clusters"))
    if relevance is None:
        relevance = sizes.select(*GROUP, F.lit(None).cast("double").alias("relevance"))
    joined = sizes
    for part in (silhouette, ch, db, coherent, balance, totals, relevance):
        joined = joined.join(part, GROUP, "left")
    rate = numeric.percent(F.col("n_reviews"), F.col("total_reviews"))
    known = round_to(F.coalesce(F.col("relevance"), F.lit(0.0)), 4)
    score = clusters.overall_score(
        round_to(F.col("squared_silhouette"), 4), round_to(F.col("coherence"), 4), round_to(rate, 2), known
    )
    return joined.select(
        *GROUP,
        "n_reviews",
        "total_reviews",
        "n_clusters",
        round_to(F.col("squared_silhouette"), 4).alias("squared_silhouette"),
        round_to(F.col("calinski_harabasz"), 2).alias("calinski_harabasz"),
        round_to(F.col("davies_bouldin"), 4).alias("davies_bouldin"),
        round_to(F.col("coherence"), 4).alias("coherence"),
        round_to(rate, 2).alias("coverage"),
        "variation",
        known.alias("relevance"),
        round_to(score, 4).alias("overall_score"),
        numeric.grade(score).alias("grade"),
    )


def vector_relevance(assigned: DataFrame, vector: str = "embedding", row_id: str = "row_id") -> DataFrame:
    """(product_category, relevance): mean over the clusters of the cosine between a summary and its reviews.

    The first review of a cluster by row id stands for its summary, the mean vector for its reviews.
    """
    v = vectors.doubles(F.col(vector))
    per_cluster = assigned.groupBy(*GROUP, "cluster").agg(
        F.min_by(v, row_id).alias("summary"), clusters.mean_vector(F.col(vector)).alias("source")
    )
    return per_cluster.groupBy(*GROUP).agg(
        F.avg(vectors.cosine(F.col("summary"), F.col("source"))).alias("relevance")
    )


def summary_relevance(summaries: DataFrame, summary: str = "v_summary", source: str = "v_source") -> DataFrame:
    """(product_category, relevance) from encoded summaries and encoded source texts, one row per cluster."""
    return summaries.groupBy(*GROUP).agg(F.avg(vectors.cosine(F.col(summary), F.col(source))).alias("relevance"))


def rollup(metrics: DataFrame) -> DataFrame:
    """Averages over categories with the overall score and grade, in one row."""
    means = metrics.agg(
        F.count(F.lit(1)).alias("categories_evaluated"),
        F.avg("squared_silhouette").alias("_s"),
        F.avg("coherence").alias("_c"),
        F.avg("coverage").alias("_v"),
    ).where("categories_evaluated > 0")
    score = clusters.overall_score(F.col("_s"), F.col("_c"), F.col("_v"))
    return means.select(
        "categories_evaluated",
        round_to(F.col("_s"), 4).alias("avg_squared_silhouette"),
        round_to(F.col("_c"), 4).alias("avg_coherence"),
        round_to(F.col("_v"), 1).alias("avg_coverage"),
        round_to(score, 4).alias("overall_score"),
        numeric.grade(score).alias("grade"),
    )


def extremes(metrics: DataFrame, top_n: int = 5) -> DataFrame:
    """The best and the worst categories by overall score."""
    key = "product_category"
    best = metrics.orderBy(F.desc("overall_score"), key).limit(top_n).withColumn("side", F.lit("best"))
    worst = metrics.orderBy("overall_score", key).limit(top_n).withColumn("side", F.lit("worst"))
    return best.unionByName(worst).select("side", key, "overall_score")


def evaluate_category(
    assigned: DataFrame,
    totals: DataFrame,
    category: str,
    vector: str = "embedding",
    relevance: DataFrame | None = None,
) -> DataFrame:
    """The measures of one category."""
    wanted = F.col("product_category") == category
    known = None if relevance is None else relevance.where(wanted)
    return evaluate_categories(assigned.where(wanted), totals.where(wanted), vector, relevance=known)


def with_bands(metrics: DataFrame) -> DataFrame:
    """Reading aids beside the numbers."""
    return metrics.withColumns(
        {
            "silhouette_band": numeric.silhouette_band(F.col("squared_silhouette")),
            "davies_bouldin_band": numeric.davies_bouldin_band(F.col("davies_bouldin")),
            "coherence_band": numeric.coherence_band(F.col("coherence")),
            "coverage_band": numeric.coverage_band(F.col("coverage")),
        }
    )
