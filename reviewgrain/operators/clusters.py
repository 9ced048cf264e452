"""Clustering per group and its quality measures.

``keys`` name the group (for example the product category), ``cluster`` the
cluster inside it, ``vector`` an array column.  All measures are sums per
cluster, so nothing here forms pairs of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewgrain.functions import numeric, vectors
from reviewgrain.functions.numeric import round_to
from reviewgrain.operators.scaling import attach, cut_lineage, first_per_group, is_small, store


#: The cluster number of rows that are in no cluster.
OUTLIER = -1


def mean_vector(v: Column) -> Column:
    """Element-wise mean as an aggregate, combined map-side."""
    return vector_to_array(Summarizer.mean(array_to_vector(vectors.doubles(v))))


def _scaled(v: Column, by: Column) -> Column:
    return F.transform(v, lambda x: x * by)


# --- grouped k-means --------------------------------------------------------
def initial_centers(
    points: DataFrame, keys: Sequence[str], k: int, row_id: str, vector: str, seed: int = 42
) -> DataFrame:
    """(keys, centers): k points per group picked by a seeded md5 of the row id."""
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col(row_id).cast("string")))
    chosen = first_per_group(points, keys, [order, row_id], k)
    entry = F.struct((F.col("place") - 1).alias("cluster"), vectors.doubles(F.col(vector)).alias("center"))
    return chosen.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("centers"))


def assign(
    points: DataFrame,
    centers: DataFrame,
    keys: Sequence[str],
    row_id: str,
    vector: str,
    small: bool | None = None,
) -> DataFrame:
    """Adds ``cluster`` and ``cost``: the nearest center of the row's group, lowest id on ties."""
    joined = attach(points, centers, keys, row_id, "inner", small=small)
    nearest = F.array_min(
        F.transform(
            "centers",
            lambda c: F.struct(
                vectors.squared_distance(F.col(vector), c["center"]).alias("cost"), c["cluster"].alias("cluster")
            ),
        )
    )
    return joined.withColumn("_best", nearest).select(
        *points.columns, F.col("_best.cluster").alias("cluster"), F.col("_best.cost").alias("cost")
    )


def _moved(assigned: DataFrame, centers: DataFrame, keys: Sequence[str], vector: str) -> DataFrame:
    """New centers; a center that lost all its points stays where it is."""
    means = assigned.groupBy(*keys, "cluster").agg(mean_vector(F.col(vector)).alias("_mean"))
    old = centers.select(*keys, F.inline("centers"))
    entry = F.struct("cluster", F.coalesce("_mean", "center").alias("center"))
    return (
        old.join(means, [*keys, "cluster"], "left")
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(entry)).alias("centers"))
    )


def _farthest_move(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> float:
    """The largest squared distance that a center moved; the tables have one row per group."""
    one = lambda df, name: df.select(*keys, F.inline("centers")).withColumnRenamed("center", name)
    both = one(before, "_old").join(one(after, "_new"), [*keys, "cluster"])
    return both.agg(F.max(vectors.squared_distance(F.col("_old"), F.col("_new")))).first()[0] or 0.0


def grouped_kmeans(
    points: DataFrame,
    keys: Sequence[str],
    k: int,
    row_id: str = "row_id",
    vector: str = "embedding",
    iterations: int = 50,
    tries: int = 1,
    tolerance: float = 1e-8,
) -> DataFrame:
    """k-means for all groups in the same passes; adds ``cluster`` and ``cost``.

    Rounds end when no center of any group moves by more than the square root of ``tolerance``, or after
    ``iterations`` rounds.
    ``tries`` differently seeded starts run side by side and each group keeps
    its cheapest one.  Points and the (small) center tables are written to the
    shared folder, so a lost executor never replays earlier rounds.
    """
    columns = points.columns
    points = store(points, "points")
    if tries > 1:
        starts = [
            initial_centers(points, keys, k, row_id, vector, seed).withColumn("_try", F.lit(seed))
            for seed in range(tries)
        ]
        centers = starts[0]
        for start in starts[1:]:
            centers = centers.unionByName(start)
        keys = [*keys, "_try"]
        points = points.withColumn("_try", F.explode(F.sequence(F.lit(0), F.lit(tries - 1))))
    else:
        centers = initial_centers(points, keys, k, row_id, vector)
    centers = cut_lineage(centers)
    small = is_small(centers)  # one row per group, the same in every round
    for _ in range(iterations):
        assigned = assign(points, centers, keys, row_id, vector, small)
        before, centers = centers, cut_lineage(_moved(assigned, centers, keys, vector))
        if _farthest_move(before, centers, keys) <= tolerance:
            break
    result = assign(points, centers, keys, row_id, vector, small)
    if tries > 1:
        groups = keys[:-1]
        cost = result.groupBy(*keys).agg(F.sum("cost").alias("_cost"))
        best = cost.groupBy(*groups).agg(F.min_by("_try", F.struct("_cost", "_try")).alias("_try"))
        best = cut_lineage(best.withColumn("_keep", F.lit(True)))
        result = attach(result, best, keys, row_id, "inner")
    return result.select(*columns, "cluster", "cost")


# --- sums per cluster -------------------------------------------------------
def cluster_sums(
    points: DataFrame, keys: Sequence[str], cluster: str = "cluster", vector: str = "embedding"
) -> DataFrame:
    """n, mean vector and sum of squared norms per cluster."""
    v = F.col(vector)
    return points.groupBy(*keys, cluster).agg(
        F.count(F.lit(1)).alias("n"), mean_vector(v).alias("mean"), F.sum(vectors.dot(v, v)).alias("squares")
    )


def _per_group(sums: DataFrame, keys: Sequence[str], cluster: str) -> DataFrame:
    """(keys, clusters): the few clusters of a group as one array."""
    entry = F.struct(F.col(cluster).alias("cluster"), "n", "mean", "squares")
    return sums.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("clusters"))


def _grouped(points: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Give an ungrouped table one constant group."""
    return (points, list(keys)) if keys else (points.withColumn("_all", F.lit(0)), ["_all"])


def squared_silhouette(
    points: DataFrame,
    keys: Sequence[str] = (),
    cluster: str = "cluster",
    vector: str = "embedding",
    row_id: str = "row_id",
) -> DataFrame:
    """Silhouette per group over *squared* Euclidean distances, all points, linear time.

    The mean squared distance to a cluster follows from its sums.  Points that
    are alone in their cluster score 0; fewer than two clusters besides the outliers give 0.
    """
    points, groups = _grouped(points, keys)
    table = cut_lineage(_per_group(cluster_sums(points, groups, cluster, vector), groups, cluster))
    joined = attach(points, table, groups, row_id, "inner")
    v, own = F.col(vector), F.col(cluster)
    own_norm = vectors.dot(v, v)

    def total(c: Column) -> Column:
        return c["squares"] + c["n"] * own_norm - 2 * c["n"] * vectors.dot(v, c["mean"])

    mine = F.get(F.filter("clusters", lambda c: c["cluster"] == own), 0)
    others = F.filter("clusters", lambda c: c["cluster"] != own)
    scored = joined.select(
        *groups,
        F.size(F.filter("clusters", lambda c: c["cluster"] != OUTLIER)).alias("_k"),
        mine["n"].alias("_n"),
        (F.greatest(total(mine), F.lit(0.0)) / (mine["n"] - 1.0 + F.when(mine["n"] == 1, 1.0).otherwise(0.0))).alias("_a"),
        F.array_min(F.transform(others, lambda c: total(c) / c["n"])).alias("_b"),
    )
    a, b = F.col("_a"), F.col("_b")
    width = F.greatest(a, b)
    point = F.when((F.col("_n") > 1) & (width > 0), (b - a) / width).otherwise(0.0)
    return scored.groupBy(*groups).agg(
        F.max("_k").cast("long").alias("n_clusters"),
        F.when(F.max("_k") >= 2, F.avg(point)).otherwise(0.0).alias("squared_silhouette"),
    ).drop("_all")


def calinski_harabasz(
    points: DataFrame,
    keys: Sequence[str] = (),
    cluster: str = "cluster",
    vector: str = "embedding",
    sums: DataFrame | None = None,
) -> DataFrame:
    """Between over within dispersion per group; 0 with fewer than two clusters.

    Needs nothing but the ``cluster_sums``, which a caller may already have.
    """
    points, groups = _grouped(points, keys)
    known = cluster_sums(points, groups, cluster, vector) if sums is None else sums
    sums = known.withColumns(
        {
            "_total": _scaled(F.col("mean"), F.col("n")),
            "_spread": F.col("squares") - F.col("n") * vectors.dot(F.col("mean"), F.col("mean")),
        }
    )
    totals = sums.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("k"),
        F.count_if(F.col(cluster) != OUTLIER).alias("real"),
        F.sum("n").alias("n"),
        F.sum("_spread").alias("within"),
        F.sum("squares").alias("squares"),
        mean_vector(F.col("_total")).alias("_mean_total"),
    )
    center = _scaled(F.col("_mean_total"), F.col("k") / F.col("n"))
    between = F.col("squares") - F.col("n") * vectors.dot(center, center) - F.col("within")
    k, n, within = F.col("k"), F.col("n"), F.col("within")
    score = F.when(within <= 0, 1.0).otherwise(between / (k - 1) / (within / F.nullif(n - k, F.lit(0))))
    return totals.select(
        *groups, F.when(F.col("real") < 2, 0.0).otherwise(score).alias("calinski_harabasz")
    ).drop("_all")


def davies_bouldin(
    points: DataFrame,
    keys: Sequence[str] = (),
    cluster: str = "cluster",
    vector: str = "embedding",
    row_id: str = "row_id",
    sums: DataFrame | None = None,
) -> DataFrame:
    """Mean over clusters of the worst (s_i + s_j) / d_ij; NULL with fewer than two clusters."""
    points, groups = _grouped(points, keys)
    known = cluster_sums(points, groups, cluster, vector) if sums is None else sums
    table = cut_lineage(_per_group(known, groups, cluster))
    joined = attach(points, table, groups, row_id, "inner")
    mine = F.get(F.filter("clusters", lambda c: c["cluster"] == F.col(cluster)), 0)
    gap = vectors.distance(F.col(vector), mine["mean"])
    spread = joined.groupBy(*groups, cluster).agg(F.avg(gap).alias("s"), F.first(mine["mean"]).alias("mean"))
    entry = F.struct(F.col(cluster).alias("cluster"), "s", "mean")
    few = spread.groupBy(*groups).agg(F.collect_list(entry).alias("clusters"))

    def worst(c: Column) -> Column:
        others = F.filter("clusters", lambda o: o["cluster"] != c["cluster"])
        ratio = F.transform(
            others, lambda o: F.try_divide(o["s"] + c["s"], vectors.distance(o["mean"], c["mean"]))
        )
        return F.coalesce(F.array_max(ratio), F.lit(0.0))

    ratios = F.transform("clusters", worst)
    total = F.aggregate(ratios, F.lit(0.0), lambda acc, x: acc + x)
    return few.select(
        *groups,
        F.when(F.size(F.filter("clusters", lambda c: c["cluster"] != OUTLIER)) >= 2, total / F.size("clusters")).alias("davies_bouldin"),
    ).drop("_all")


def coherence(
    points: DataFrame, keys: Sequence[str] = (), cluster: str = "cluster", vector: str = "embedding"
) -> DataFrame:
    """Mean pairwise cosine per cluster of two or more rows, all rows, no pairs formed.

    For unit vectors the pair sum is |sum of u|^2 minus the squared lengths.
    """
    unit = points.withColumn("_unit", vectors.unit(F.col(vector)))
    sums = cluster_sums(unit, keys, cluster, "_unit")
    n = F.col("n")
    pairs = n * n * vectors.dot(F.col("mean"), F.col("mean")) - F.col("squares")
    return sums.where(n >= 2).select(
        *keys, cluster, n.alias("n_reviews"), (pairs / (n * (n - 1))).alias("avg_similarity")
    )


def overall_coherence(per_cluster: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return per_cluster.groupBy(*keys).agg(
        F.coalesce(F.avg("avg_similarity"), F.lit(0.0)).alias("coherence"),
        F.count(F.lit(1)).alias("n_clusters_evaluated"),
    )


def cluster_balance(
    points: DataFrame, keys: Sequence[str] = (), cluster: str = "cluster", sums: DataFrame | None = None
) -> DataFrame:
    """Smallest, biggest, mean and population deviation of the cluster sizes, and their ratio."""
    if sums is None:
        sizes = points.groupBy(*keys, cluster).agg(F.count(F.lit(1)).alias("size"))
    else:
        sizes = sums.select(*keys, cluster, F.col("n").alias("size"))
    out = sizes.groupBy(*keys).agg(
        F.min("size").alias("min_size"),
        F.max("size").alias("max_size"),
        F.avg("size").alias("_mean"),
        F.stddev_pop("size").alias("_std"),
    )
    cv = F.col("_std") / F.col("_mean")
    return out.select(
        *keys,
        "min_size",
        "max_size",
        round_to(F.col("_mean"), 1).alias("mean_size"),
        round_to(F.col("_std"), 1).alias("std_size"),
        round_to(cv, 3).alias("variation"),
        numeric.balance_band(cv).alias("balance"),
    )


def coverage(df: DataFrame, covered: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Share of rows for which ``covered`` holds."""
    out = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_reviews"), F.count_if(covered).alias("reviews_with_aspects")
    )
    rate = numeric.percent(F.col("reviews_with_aspects"), F.col("total_reviews"))
    return out.select(
        *keys,
        "total_reviews",
        "reviews_with_aspects",
        round_to(rate, 2).alias("coverage_rate"),
        numeric.coverage_band(rate).alias("coverage_band"),
    )


def overall_score(
    silhouette: Column, coherence: Column, coverage_pct: Column, relevance: Column | None = None
) -> Column:
    """Mean of the parts scaled to 0..1; missing coverage counts as 0, relevance only when positive."""
    parts = (
        (F.coalesce(silhouette, F.lit(0.0)) + 1) / 2
        + F.coalesce(coherence, F.lit(0.0))
        + F.coalesce(coverage_pct, F.lit(0.0)) / 100
    )
    if relevance is None:
        return parts / 3
    return F.when(relevance > 0, (parts + relevance) / 4).otherwise(parts / 3)
