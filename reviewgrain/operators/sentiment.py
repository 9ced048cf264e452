"""Sentiment scores, their roll-ups and the words behind them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewgrain import lexicons as lx
from reviewgrain.functions import text
from reviewgrain.functions.dates import year_month
from reviewgrain.functions.numeric import percent, round_to
from reviewgrain.operators.scaling import first_per_group


def score_reviews(df: DataFrame, review: str = "review") -> DataFrame:
    """Adds ``sentiment_score`` and ``sentiment``; a missing review scores 0."""
    scored = df.withColumn("sentiment_score", text.sentiment_score(F.col(review)))
    return scored.withColumn("sentiment", text.sentiment_label(F.col("sentiment_score")))


def by_category(df: DataFrame, name: str = "product_category") -> DataFrame:
    """Mean and sample deviation of the score, mean rating and size; one row has no deviation."""
    return (
        df.where(F.col(name).isNotNull())
        .groupBy(name)
        .agg(
            round_to(F.avg("sentiment_score"), 3).alias("avg_sentiment"),
            round_to(F.stddev_samp("sentiment_score"), 3).alias("sentiment_std"),
            round_to(F.avg("rating"), 3).alias("avg_rating"),
            F.count("uniq_id").alias("review_count"),
        )
        .orderBy(F.desc("review_count"), name)
    )


def by_month(df: DataFrame, date_column: str = "review_date") -> DataFrame:
    """Monthly mean score, mean rating and size; rows without a date are left out."""
    return (
        df.where(F.col(date_column).isNotNull())
        .groupBy(year_month(F.col(date_column)).alias("year_month"))
        .agg(
            round_to(F.avg("sentiment_score"), 3).alias("avg_sentiment"),
            round_to(F.avg("rating"), 3).alias("avg_rating"),
            F.count("uniq_id").alias("review_count"),
        )
        .orderBy("year_month")
    )


def word_rows(df: DataFrame, keys: Sequence[str], review: str = "review") -> DataFrame:
    """One row per lower-cased token, with the key columns.

    The outer form keeps Spark from splitting every text a second time just to
    see whether it has any token.
    """
    words = F.explode_outer(F.split(F.lower(F.col(review)), text.SPACE + "+")).alias("word")
    return df.select(*keys, words).where(F.col("word") != "")


def drivers(
    df: DataFrame,
    sentiment: str = "negative",
    category: str | None = None,
    top_n: int = 10,
    stop_words: Sequence[str] = lx.DRIVER_STOP_WORDS,
) -> DataFrame:
    """Most frequent words in reviews of one sentiment.

    ``percentage`` is occurrences per filtered row, so it may pass 100; rows
    without a review count in the denominator.  Ties go by word.
    """
    rows = df.where(F.col("sentiment") == sentiment)
    if category is not None:
        rows = rows.where(F.col("product_category") == category)
    # one unnamed entry per row counts the rows in the same pass as the words
    words = F.coalesce(text.tokens(F.lower(F.col("review"))), F.array().cast("array<string>"))
    entries = rows.select(F.explode_outer(F.concat(F.array(F.lit("")), words)).alias("theme"))
    theme = F.col("theme")
    useful = (theme == "") | (~theme.isin(*stop_words) & (F.length(theme) > 2))
    counts = entries.where(useful).groupBy("theme").agg(F.count(F.lit(1)).alias("count"))
    top = counts.orderBy(theme != "", F.desc("count"), "theme").limit(top_n + 1)
    size = F.max(F.when(theme == "", F.col("count"))).over(Window.partitionBy())
    shared = top.withColumn("percentage", percent(F.col("count"), size, 2))
    return shared.where(theme != "").orderBy(F.desc("count"), "theme")


def sample_reviews(
    df: DataFrame,
    keys: Sequence[str],
    n: int,
    row_id: str = "row_id",
    review: str = "review",
) -> DataFrame:
    """The first ``n`` reviews of every cluster as an ordered array."""
    first = first_per_group(df, keys, [row_id], n)
    ordered = F.array_sort(F.collect_list(F.struct("place", F.col(review).alias("review"))))
    return first.groupBy(*keys).agg(F.transform(ordered, lambda s: s["review"]).alias("samples"))


def cluster_names(
    df: DataFrame,
    keys: Sequence[str],
    row_id: str = "row_id",
    reviews: int | None = None,
    words: int = 3,
) -> DataFrame:
    """Name a cluster by the top words of its reviews (the first ``reviews`` if given), short words dropped afterwards."""
    rows = df if reviews is None else first_per_group(df, keys, [row_id], reviews)
    counts = word_rows(rows, keys).groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("n"))
    top = first_per_group(counts, keys, [F.desc("n"), "word"], words)
    entry = F.when(F.length("word") > 3, F.struct("place", "word"))
    named = top.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("words"))
    return named.select(
        *keys, F.array_join(F.transform("words", lambda s: s["word"]), " / ").alias("aspect_name")
    )


def cluster_top_words(
    df: DataFrame,
    keys: Sequence[str],
    row_id: str = "row_id",
    reviews: int | None = None,
    candidates: int = 30,
    keep: int = 10,
    stop_words: Sequence[str] = lx.CLUSTER_STOP_WORDS,
) -> DataFrame:
    """Top words per cluster; stop words and short words leave only after the candidates are picked."""
    rows = df if reviews is None else first_per_group(df, keys, [row_id], reviews)
    counts = word_rows(rows, keys).groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("n"))
    top = first_per_group(counts, keys, [F.desc("n"), "word"], candidates)
    good = ~F.col("word").isin(*stop_words) & (F.length("word") > 2)
    ordered = F.array_sort(F.collect_list(F.when(good, F.struct("place", "word"))))
    return top.groupBy(*keys).agg(
        F.slice(F.transform(ordered, lambda s: s["word"]), 1, keep).alias("top_words")
    )


def cluster_polarity(df: DataFrame, keys: Sequence[str], review: str = "review") -> DataFrame:
    """Positive, negative and neutral shares per cluster and the overall verdict.

    A review with words of both kinds is neutral.  The verdict compares the
    rounded percentages.
    """
    positive, negative = text.polarity_flags(F.col(review))
    flagged = df.withColumns({"_pos": positive, "_neg": negative})
    counts = flagged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("review_count"),
        F.count_if(F.col("_pos") & ~F.col("_neg")).alias("positive_count"),
        F.count_if(F.col("_neg") & ~F.col("_pos")).alias("negative_count"),
        F.count_if(F.col("_pos") == F.col("_neg")).alias("neutral_count"),
    )
    shares = counts.withColumns(
        {
            f"{kind}_pct": percent(F.col(f"{kind}_count"), F.col("review_count"), 1)
            for kind in ("positive", "negative", "neutral")
        }
    )
    return shares.withColumn("overall", overall_polarity(F.col("positive_pct"), F.col("negative_pct")))


def overall_polarity(pos: Column, neg: Column) -> Column:
    return (
        F.when(pos >= 60, "positive")
        .when(neg >= 40, "negative")
        .when(pos > neg, "mixed_positive")
        .when(neg > pos, "mixed_negative")
        .otherwise("neutral")
    )


def aspect_name_sentiment(
    df: DataFrame, keys: Sequence[str] = (), review: str = "review", extra: Sequence[Column] = ()
) -> DataFrame:
    """Positive and negative shares counted independently.

    A review may be both, so ``neutral_pct`` can fall below zero;
    ``mixed_count`` says how many are both.  ``extra`` aggregates ride along.
    """
    pos, neg = text.polarity_flags(
        F.col(review), lx.ASPECT_NAME_POSITIVE_WORDS, lx.ASPECT_NAME_NEGATIVE_WORDS
    )
    flagged = df.withColumns({"_pos": pos, "_neg": neg})
    counts = flagged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("review_count"),
        F.count_if("_pos").alias("positive_count"),
        F.count_if("_neg").alias("negative_count"),
        F.count_if(F.col("_pos") & F.col("_neg")).alias("mixed_count"),
        *extra,
    )
    n, p, q = (F.col(c) for c in ("review_count", "positive_count", "negative_count"))
    return counts.withColumns(
        {
            "positive_pct": percent(p, n, 1),
            "negative_pct": percent(q, n, 1),
            "neutral_pct": percent(n - p - q, n, 1),
        }
    )


def aspect_name_label(positive_pct: Column, negative_pct: Column) -> Column:
    return (
        F.when(positive_pct > 50, "positive").when(negative_pct > 30, "negative").otherwise("neutral")
    )


def summary_sentence(count: Column, aspect: Column) -> Column:
    """Stand-in summary used when no text model is at hand."""
    return F.format_string("%d reviews about %s.", count.cast("long"), aspect)
