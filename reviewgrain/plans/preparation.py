"""Cleaning, imputing and categorising whole review tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewgrain import lexicons as lx
from reviewgrain.operators import aspects, categories, cleaning, enrichment, sentiment


def preprocess(df: DataFrame, row_id: str = "row_id") -> DataFrame:
    """All five quality dimensions, then the derived columns.

    Which rows survive de-duplication depends only on URL, reviewer, text and
    uniq_id, none of which the URL merge touches; so the surviving ids are
    worked out beside the merge, not behind it, and neither the merge nor the
    median is computed twice.
    """
    typed = cleaning.coerce_types(cleaning.clean_text_columns(df))
    merged = cleaning.merge_by_url(cleaning.fill_rating_median(typed), row_id=row_id)
    fixed = (
        merged.transform(cleaning.fill_constants)
        .transform(cleaning.fix_values)
        .transform(cleaning.standardise_columns)
        .transform(cleaning.clip_ratings)
        .transform(cleaning.shift_dates)
        .transform(cleaning.validate_dates)
    )
    if cleaning.same_review_keys(typed):
        named = cleaning.apply_to(typed, ["reviewer_name"], lambda c: F.coalesce(c, F.lit(lx.ANONYMOUS)))
        unique = fixed.join(cleaning.surviving_ids(named, row_id), row_id, "left_semi")
    else:
        unique = cleaning.drop_duplicates(fixed, row_id)
    return cleaning.add_derived(unique)


def impute(
    df: DataFrame,
    url_status: DataFrame | None = None,
    scraped: DataFrame | None = None,
    inferred: DataFrame | None = None,
    row_id: str = "row_id",
) -> DataFrame:
    """Drop rows with bad URLs, fill from scraped and inferred tables, then defaults."""
    if url_status is not None:
        validity = enrichment.url_validity(df, url_status)
        df = enrichment.drop_invalid_urls(df, validity.where(~F.col("valid")), row_id=row_id)
    if scraped is not None:
        df = enrichment.fill_from_scraped(df, scraped, row_id)
    if inferred is not None:
        df = enrichment.apply_inferred(df, inferred, row_id=row_id)
    return cleaning.fill_defaults(df)


def categorise(
    df: DataFrame,
    lexicon: Mapping[str, Sequence[str]] = lx.CATEGORY_KEYWORDS,
    min_count: int = 10,
    row_id: str = "row_id",
) -> DataFrame:
    return categories.consolidate(categories.assign_by_keyword(df, lexicon), min_count, row_id)


def analyse(df: DataFrame, keywords: Mapping[str, Sequence[str]] = lx.ASPECT_KEYWORDS) -> DataFrame:
    """Adds the ``aspects`` array and the sentiment columns; no shuffle."""
    return sentiment.score_reviews(aspects.find_aspects(df, keywords))
