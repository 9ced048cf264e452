"""Product categories: assignment, consolidation and per-category figures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewgrain import lexicons as lx
from reviewgrain.functions.numeric import round_to
from reviewgrain.functions.text import keyword_category, truncate
from reviewgrain.operators.scaling import attach_derived, spread_join


def assign_by_keyword(
    df: DataFrame,
    categories: Mapping[str, Sequence[str]] = lx.CATEGORY_KEYWORDS,
    title: str = "title",
    name: str = "product_category",
) -> DataFrame:
    return df.withColumn(name, keyword_category(F.col(title), categories))


def unique_products(df: DataFrame, row_id: str = "row_id", context: int | None = None) -> DataFrame:
    """One row per known title with the URL and the review of its first row, cut to ``context`` characters if that is given."""
    review = F.col("review") if context is None else truncate(F.col("review"), context)
    first = F.min_by(F.struct("pageurl", review.alias("review")), row_id)
    return (
        df.where(F.col("title").isNotNull())
        .groupBy("title")
        .agg(first.alias("first"))
        .select("title", F.col("first.pageurl").alias("url"), "first.review")
    )


def category_map(assigned: DataFrame, order: str) -> DataFrame:
    """One category per title: the last assignment by ``order`` wins."""
    return assigned.groupBy("title").agg(F.max_by("category", order).alias("category"))


def assign_from_map(
    df: DataFrame,
    mapping: DataFrame,
    row_id: str = "row_id",
    default: str = lx.UNKNOWN,
    name: str = "product_category",
) -> DataFrame:
    """Look the title up in a (title, category) table; of several categories of a title the last in the alphabet counts."""
    known = mapping.groupBy("title").agg(F.max("category").alias("_category"))
    joined = spread_join(df, known, ["title"], row_id)
    return joined.withColumn(name, F.coalesce("_category", F.lit(default))).select(
        *[c for c in df.columns if c != name], name
    )


def category_counts(df: DataFrame, name: str = "product_category") -> DataFrame:
    return df.groupBy(name).agg(F.count(F.lit(1)).alias("_rows"))


def consolidate(
    df: DataFrame,
    min_count: int = 10,
    row_id: str = "row_id",
    name: str = "product_category",
    other: str = lx.OTHER,
) -> DataFrame:
    """Categories with fewer than ``min_count`` rows become ``other``; NULL stays NULL."""
    joined = attach_derived(df, category_counts(df, name), [name], row_id)
    small = F.col("_rows") < min_count
    return joined.withColumn(name, F.when(small, F.lit(other)).otherwise(F.col(name))).select(*df.columns)


def rows_of_small_categories(
    df: DataFrame, min_count: int = 10, row_id: str = "row_id", name: str = "product_category"
) -> DataFrame:
    """Rows whose category has fewer than ``min_count`` rows."""
    counts = category_counts(df, name)
    small = counts.where((F.col("_rows") < min_count) & F.col(name).isNotNull()).select(name)
    return attach_derived(df, small, [name], row_id, "left_semi")


def category_summary(df: DataFrame, name: str = "product_category") -> DataFrame:
    """Reviews, average rating and vote sums per category, biggest first."""
    return (
        df.where(F.col(name).isNotNull())
        .groupBy(name)
        .agg(
            F.count("uniq_id").alias("review_count"),
            round_to(F.avg("rating"), 2).alias("avg_rating"),
            F.coalesce(round_to(F.sum("review_upvotes"), 2), F.lit(0.0)).alias("review_upvotes"),
            F.coalesce(round_to(F.sum("review_downvotes"), 2), F.lit(0.0)).alias("review_downvotes"),
        )
        .orderBy(F.desc("review_count"), name)
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Counts of the known values, most frequent first."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), column)
    )


def eligible_categories(
    df: DataFrame,
    min_reviews: int = 50,
    excluded: Sequence[str] = (lx.UNKNOWN, lx.OTHER),
    first: int | None = None,
    by_name: bool = False,
    name: str = "product_category",
) -> DataFrame:
    """Categories with enough reviews, by size or by name, optionally the first few."""
    counts = (
        df.where(F.col(name).isNotNull() & ~F.col(name).isin(*excluded))
        .groupBy(name)
        .agg(F.count(F.lit(1)).alias("review_count"))
        .where(F.col("review_count") >= min_reviews)
    )
    ranked = counts.orderBy(name) if by_name else counts.orderBy(F.desc("review_count"), name)
    return ranked if first is None else ranked.limit(first)


def distinct_values(
    df: DataFrame, column: str, excluded: Sequence[str] = (lx.UNKNOWN, lx.OTHER)
) -> DataFrame:
    """Pick list: distinct known values without the excluded ones, sorted."""
    known = df.where(F.col(column).isNotNull() & ~F.col(column).isin(*excluded))
    return known.select(column).distinct().orderBy(column)
