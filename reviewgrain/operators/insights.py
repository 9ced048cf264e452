"""Insight tables: overall, per category, per aspect, over time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewgrain.functions.dates import year_month
from reviewgrain.functions.numeric import percent, round_to
from reviewgrain.operators.aspects import aspect_grid
from reviewgrain.operators.scaling import first_per_group


def data_summary(df: DataFrame) -> DataFrame:
    """Rows, distinct products and categories, date range and mean rating, in one row."""
    return df.agg(
        F.count(F.lit(1)).alias("total_reviews"),
        F.count_distinct("product_id").alias("unique_products"),
        F.min("review_date").alias("first_date"),
        F.max("review_date").alias("last_date"),
        round_to(F.avg("rating"), 2).alias("avg_rating"),
        F.count_distinct("product_category").alias("categories_count"),
    )


def category_sentiment(df: DataFrame, min_reviews: int = 10) -> DataFrame:
    """Size, mean rating and sentiment shares of the categories with enough reviews."""
    n = F.col("review_count")
    return (
        df.where(F.col("product_category").isNotNull())
        .groupBy("product_category")
        .agg(
            F.count(F.lit(1)).alias("review_count"),
            round_to(F.avg("rating"), 2).alias("avg_rating"),
            *[F.count_if(F.col("sentiment") == s).alias(s) for s in ("positive", "neutral", "negative")],
        )
        .where(n >= min_reviews)
        .select(
            "product_category",
            "review_count",
            "avg_rating",
            *[percent(F.col(s), n, 1).alias(f"{s}_pct") for s in ("positive", "neutral", "negative")],
        )
    )


def category_top_aspects(
    df: DataFrame, min_reviews: int = 10, min_rate: float = 5.0, top_n: int = 5
) -> DataFrame:
    """The most mentioned aspects of every category; equal rounded rates keep the listed order."""
    grid = aspect_grid(df, ["product_category"]).where(F.col("total") >= min_reviews)
    rate = percent(F.col("mentions"), F.col("total"))
    rated = grid.where(rate > min_rate).withColumn("mention_rate", round_to(rate, 1))
    return first_per_group(
        rated, ["product_category"], [F.desc("mention_rate"), "position"], top_n, "place"
    ).select("product_category", "place", "aspect", "mention_rate")


def category_pain_points(df: DataFrame, min_reviews: int = 10, min_rate: float = 30.0) -> DataFrame:
    """Aspects with a negative share above ``min_rate`` among their mentions, worst first."""
    grid = aspect_grid(df, ["product_category"]).where(F.col("total") >= min_reviews)
    rate = percent(F.col("negative"), F.col("mentions"))
    rated = grid.where(rate > min_rate).withColumn("negative_rate", round_to(rate, 1))
    order = Window.partitionBy("product_category").orderBy(F.desc("negative_rate"), "position")
    return rated.withColumn("place", F.row_number().over(order)).select(
        "product_category", "place", "aspect", "negative_rate", F.col("mentions").alias("mention_count")
    )


def category_insights(df: DataFrame, min_reviews: int = 10) -> DataFrame:
    """One row per category with nested top aspects and pain points, biggest category first.

    The nested lists hold at most one entry per aspect.
    """
    top = category_top_aspects(df, min_reviews).groupBy("product_category").agg(
        F.array_sort(F.collect_list(F.struct("place", "aspect", "mention_rate"))).alias("top_aspects")
    )
    pain = category_pain_points(df, min_reviews).groupBy("product_category").agg(
        F.array_sort(
            F.collect_list(F.struct("place", "aspect", "negative_rate", "mention_count"))
        ).alias("pain_points")
    )
    return (
        category_sentiment(df, min_reviews)
        .join(top, "product_category", "left")
        .join(pain, "product_category", "left")
        .orderBy(F.desc("review_count"), "product_category")
    )


def aspect_stats(df: DataFrame) -> DataFrame:
    """Mention count and rate, positive and negative rate per aspect; a zero rate shows as NULL."""
    m = F.col("mentions")
    return (
        aspect_grid(df)
        .select(
            "position",
            "aspect",
            m.alias("mention_count"),
            percent(m, F.col("total"), 2).alias("mention_rate"),
            F.nullif(percent(F.col("positive"), m, 2), F.lit(0.0)).alias("positive_rate"),
            F.nullif(percent(F.col("negative"), m, 2), F.lit(0.0)).alias("negative_rate"),
        )
        .orderBy(F.desc("mention_count"), "aspect")
    )


def aspect_highlights(stats: DataFrame) -> DataFrame:
    """Most discussed aspect (ties by name), highest positive and negative (ties in listed order)."""

    def best(value, tie):
        return F.max_by("aspect", F.struct(F.coalesce(value, F.lit(0.0)), tie))

    listed = -F.col("position")
    by_name = F.struct(-F.col("mention_count"), F.col("aspect"))
    return stats.agg(
        F.min_by("aspect", by_name).alias("most_discussed"),
        best(F.col("positive_rate"), listed).alias("highest_positive"),
        best(F.col("negative_rate"), listed).alias("highest_negative"),
    )


def monthly_figures(df: DataFrame) -> DataFrame:
    """Mean rating and score (2 places) and size per month."""
    return (
        df.where(F.col("review_date").isNotNull())
        .groupBy(year_month(F.col("review_date")).alias("year_month"))
        .agg(
            round_to(F.avg("rating"), 2).alias("avg_rating"),
            round_to(F.avg("sentiment_score"), 2).alias("avg_sentiment"),
            F.count("uniq_id").alias("review_count"),
        )
    )


def time_insights(df: DataFrame) -> DataFrame:
    """Trend of the monthly ratings and the peak, lowest and highest month.

    Never falling is improving (also a constant or single month), never rising
    is declining.  The first month wins ties.  The window runs over the monthly
    table only.
    """
    previous = F.lag("avg_rating").over(Window.orderBy("year_month"))
    step = monthly_figures(df).withColumn("_step", F.col("avg_rating") - previous)
    first_max = lambda c: F.min_by("year_month", F.struct(-F.col(c), F.col("year_month")))
    return (
        step.agg(
            F.count(F.lit(1)).alias("months_analyzed"),
            F.coalesce(F.min("_step"), F.lit(0.0)).alias("_lowest"),
            F.coalesce(F.max("_step"), F.lit(0.0)).alias("_highest"),
            first_max("review_count").alias("peak_month"),
            F.min_by("year_month", F.struct("avg_rating", "year_month")).alias("lowest_rating_month"),
            first_max("avg_rating").alias("highest_rating_month"),
        )
        .where(F.col("months_analyzed") > 0)
        .select(
            "months_analyzed",
            F.when(F.col("_lowest") >= 0, "improving")
            .when(F.col("_highest") <= 0, "declining")
            .otherwise("fluctuating")
            .alias("trend_direction"),
            "peak_month",
            "lowest_rating_month",
            "highest_rating_month",
        )
    )


# --- exploratory tables -----------------------------------------------------
def key_metrics(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("reviews"),
        F.count_distinct("pageurl").alias("products"),
        F.count_distinct("product_category").alias("categories"),
        round_to(F.avg("rating"), 2).alias("avg_rating"),
    )


def rating_distribution(df: DataFrame) -> DataFrame:
    """Count per rating, its share of all rows, and whether it is the mode (lowest on ties)."""
    counts = df.groupBy("rating").agg(F.count(F.lit(1)).alias("count"))
    everything = Window.partitionBy()
    best = F.max(F.when(F.col("rating").isNotNull(), F.struct("count", -F.col("rating")))).over(everything)
    return (
        counts.withColumn("pct", F.col("count") / F.sum("count").over(everything) * 100)
        .withColumn("is_mode", F.struct("count", -F.col("rating")) == best)
        .where(F.col("rating").isNotNull())
        .select("rating", "count", round_to(F.col("pct"), 1).alias("pct"), "is_mode")
        .orderBy("rating")
    )


def rating_headline(df: DataFrame) -> DataFrame:
    """Most frequent rating and its count, share of five stars, number of one stars."""
    table = rating_distribution(df)
    return table.agg(
        F.max_by("rating", F.col("is_mode").cast("int")).alias("mode_rating"),
        F.max("count").alias("mode_count"),
        F.coalesce(F.max(F.when(F.col("rating") == 5, F.col("pct"))), F.lit(0.0)).alias("five_star_pct"),
        F.coalesce(F.max(F.when(F.col("rating") == 1, F.col("count"))), F.lit(0)).alias("one_star_count"),
    )


def rating_sentiment_distribution(df: DataFrame) -> DataFrame:
    """Count per rating sentiment and its share of all rows, most frequent first."""
    counts = df.groupBy("rating_sentiment").agg(F.count(F.lit(1)).alias("count"))
    share = F.col("count") / F.sum("count").over(Window.partitionBy()) * 100
    return (
        counts.withColumn("pct", round_to(share, 1))
        .where(F.col("rating_sentiment").isNotNull())
        .orderBy(F.desc("count"), "rating_sentiment")
    )


def category_performance(df: DataFrame, min_reviews: int = 50, top_n: int = 5) -> DataFrame:
    """The best and the worst categories by mean rating, more than ``min_reviews`` ratings each."""
    table = (
        df.where(F.col("product_category").isNotNull())
        .groupBy("product_category")
        .agg(
            F.count("rating").alias("reviews"),
            F.avg("rating").alias("avg_rating"),
            F.avg("helpfulness_score").alias("avg_helpfulness"),
        )
        .where(F.col("reviews") > min_reviews)
    )
    best = table.orderBy(F.desc("avg_rating"), "product_category").limit(top_n)
    worst = table.orderBy("avg_rating", "product_category").limit(top_n)
    return best.withColumn("side", F.lit("best")).unionByName(worst.withColumn("side", F.lit("worst")))


def monthly_trend(df: DataFrame) -> DataFrame:
    return (
        df.where(F.col("review_year_month").isNotNull())
        .groupBy("review_year_month")
        .agg(F.count("rating").alias("review_count"), F.avg("rating").alias("avg_rating"))
        .orderBy("review_year_month")
    )


def top_rows(df: DataFrame, by: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    """The ``n`` rows with the greatest ``by``; equal ones in the order of ``ties``.  NULL is never among them."""
    return df.where(F.col(by).isNotNull()).orderBy(F.desc(by), *ties).limit(n)
