"""Recommendations and the review report as tables of lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewgrain.operators import insights
from reviewgrain.operators.scaling import cut_lineage


# the columns of the analysed reviews that the report reads
FACTS = ["uniq_id", "product_id", "product_category", "review_date", "rating", "sentiment", "sentiment_score", "aspects"]


def recommendations(
    df: DataFrame,
    top_categories: int = 3,
    by_category: DataFrame | None = None,
    by_aspect: DataFrame | None = None,
    by_month: DataFrame | None = None,
) -> DataFrame:
    """(position, priority, area, recommendation, action).

    The aspect with the highest negative rate, the worst pain point of the
    biggest categories, and a warning when monthly ratings only fall.  Tables
    that a caller already has are not computed again.
    """
    by_category = insights.category_sentiment(df) if by_category is None else by_category
    by_aspect = insights.aspect_stats(df) if by_aspect is None else by_aspect
    by_month = insights.time_insights(df) if by_month is None else by_month
    worst = insights.aspect_highlights(by_aspect).where(F.col("highest_negative").isNotNull())
    aspect, category = F.col("highest_negative"), F.col("product_category")
    overall = worst.select(
        F.lit(0).alias("position"),
        F.lit("high").alias("priority"),
        aspect.alias("area"),
        F.format_string("No aspect is blamed as often as %s.", aspect).alias("recommendation"),
        F.format_string("Sort complaints about %s by cause.", aspect).alias("action"),
    )
    biggest = by_category.orderBy(F.desc("review_count"), "product_category").limit(top_categories)
    pain = insights.category_pain_points(df).where("place = 1")
    # at most ``top_categories`` rows on one side
    each = pain.join(F.broadcast(biggest.select("product_category", "review_count")), "product_category").select(
        F.row_number().over(_by_size()).alias("position"),
        F.lit("medium").alias("priority"),
        F.concat(category, F.lit(": "), F.col("aspect")).alias("area"),
        F.format_string("Within %s, most trouble comes from %s.", category, F.col("aspect")).alias("recommendation"),
        F.format_string("Look into the %s%% of its mentions that are negative.", F.col("negative_rate").cast("string")).alias("action"),
    )
    falling = by_month.where("trend_direction = 'declining'").select(
        F.lit(99).alias("position"),
        F.lit("high").alias("priority"),
        F.lit("all reviews").alias("area"),
        F.lit("No month was rated better than the one before it.").alias("recommendation"),
        F.lit("Find out what changed after the best month.").alias("action"),
    )
    return overall.unionByName(each).unionByName(falling).orderBy("position")


def _by_size():
    from pyspark.sql import Window

    return Window.orderBy(F.desc("review_count"), "product_category")


def _lines(df: DataFrame, section: int, order: Column, texts: Sequence[Column]) -> DataFrame:
    """(section, ord, line): every row of ``df`` gives the ``texts`` in turn."""
    rows = df.select(order.alias("_row"), F.posexplode(F.array(*texts)).alias("_at", "line"))
    return rows.select(
        F.lit(section).alias("section"),
        (F.col("_row") * len(texts) + F.col("_at")).cast("long").alias("ord"),
        "line",
    )


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("unknown"))


def report_lines(df: DataFrame, top_n: int = 10) -> DataFrame:
    """The Markdown report as ordered lines; write it with one small final job.

    Figures, then one table each for categories and aspects, the months, and what to do.  The tables per
    category, aspect and month are small; each is computed once and stored.
    """
    by_category, by_aspect, by_month = (
        cut_lineage(t) for t in (insights.category_sentiment(df), insights.aspect_stats(df), insights.time_insights(df))
    )
    day = lambda c: F.coalesce(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit("unknown"))
    row = lambda *cells: F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    figures = _lines(
        insights.data_summary(df),
        0,
        F.lit(0),
        [
            F.lit("# What the reviews say"),
            F.concat(_text("total_reviews"), F.lit(" reviews of "), _text("unique_products"), F.lit(" products in "),
                     _text("categories_count"), F.lit(" categories")),
            F.concat(F.lit("Rated "), _text("avg_rating"), F.lit(" on average")),
            F.concat(F.lit("Written between "), day("first_date"), F.lit(" and "), day("last_date")),
        ],
    )
    biggest = by_category.orderBy(F.desc("review_count"), "product_category").limit(top_n)
    categories = _lines(
        biggest.withColumn("_place", F.row_number().over(_by_size())),
        1,
        F.col("_place"),
        [row(F.col("product_category"), *map(_text, ("review_count", "positive_pct", "negative_pct", "avg_rating")))],
    )
    aspects = _lines(
        _ranked_aspects(by_aspect, top_n),
        2,
        F.col("_place"),
        [row(F.col("aspect"), *map(_text, ("mention_count", "positive_rate", "negative_rate", "mention_rate")))],
    )
    months = _lines(
        by_month,
        3,
        F.lit(0),
        [
            F.lit("# Over time"),
            F.concat(_text("months_analyzed"), F.lit(" months, ratings "), _text("trend_direction")),
            F.concat(F.lit("Busiest: "), _text("peak_month")),
            F.concat(F.lit("Best and worst rated: "), _text("highest_rating_month"), F.lit(", "), _text("lowest_rating_month")),
        ],
    )
    advice = _lines(
        recommendations(df, by_category=by_category, by_aspect=by_aspect, by_month=by_month),
        4,
        F.col("position"),
        [F.concat(F.lit("* "), F.col("area"), F.lit(" ("), F.col("priority"), F.lit("): "), F.col("recommendation"), F.lit(" "), F.col("action"))],
    )
    parts = [
        figures,
        _titled(df, 1, ["# Categories", "| category | reviews | % positive | % negative | rating |", "|:--|--:|--:|--:|--:|"]),
        categories,
        _titled(df, 2, ["# Aspects", "| aspect | mentions | % positive | % negative | % of reviews |", "|:--|--:|--:|--:|--:|"]),
        aspects,
        months,
        _titled(df, 4, ["# What to do"]),
        advice,
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.orderBy("section", "ord")


def _titled(df: DataFrame, section: int, lines: Sequence[str]) -> DataFrame:
    """Fixed lines in front of a section, numbered below zero."""
    rows = [(section, i - len(lines), line) for i, line in enumerate(lines)]
    return df.sparkSession.createDataFrame(rows, "section int, ord long, line string")


def _ranked_aspects(stats: DataFrame, top_n: int) -> DataFrame:
    from pyspark.sql import Window

    place = F.row_number().over(Window.orderBy(F.desc("mention_count"), "aspect"))
    return stats.withColumn("_place", place).where(F.col("_place") <= top_n)


def evaluation_lines(evaluation: DataFrame) -> DataFrame:
    """Markdown lines of one evaluation row: the grade, then one table line per measure with its reading."""

    def measure(name: str, value: Column, reading: Column | None = None) -> Column:
        return F.concat(F.lit(f"| {name} | "), value, F.lit(" | "), F.coalesce(reading, F.lit("")) if reading is not None else F.lit(""), F.lit(" |"))

    number = lambda c, digits: F.format_string(f"%.{digits}f", c)
    return _lines(
        evaluation,
        0,
        F.lit(0),
        [
            F.concat(F.lit("# Clusters graded "), F.col("grade"), F.lit(", score "), number("overall_score", 4)),
            F.lit("| measure | value | reading |"),
            F.lit("|:--|--:|:--|"),
            measure("squared silhouette", number("squared_silhouette", 4), F.col("silhouette_band")),
            measure("dispersion between over within", number("calinski_harabasz", 2)),
            measure("closeness of the nearest clusters", number("davies_bouldin", 4), F.col("davies_bouldin_band")),
            measure("similarity inside clusters", number("coherence", 4), F.col("coherence_band")),
            measure("clusters", _text("n_clusters")),
            measure("reviews in clusters", F.concat(_text("reviews_with_aspects"), F.lit(" of "), _text("total_reviews"))),
            measure("share in percent", number("coverage_rate", 1)),
        ],
    )
