"""Filling gaps from side tables, work lists and URL validity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewgrain import lexicons as lx
from reviewgrain.functions.text import product_id
from reviewgrain.operators.cleaning import present
from reviewgrain.operators.scaling import spread_join


# --- URL validity -----------------------------------------------------------
def url_validity(df: DataFrame, status: DataFrame, url: str = "pageurl") -> DataFrame:
    """Every distinct URL with ``valid``: its status is known and below 400.

    ``status(url, status)`` holds the checks, of several of one URL the highest status counts; unchecked URLs get NULL.
    """
    urls = df.where(F.col(url).isNotNull()).select(url).distinct()
    checked = status.groupBy(F.col("url").alias(url)).agg(F.max("status").alias("status"))
    return urls.join(checked, url, "left").select(
        url, (F.col("status") < 400).alias("valid")
    )


def url_summary(validity: DataFrame) -> DataFrame:
    return validity.agg(
        F.count("valid").alias("checked"),
        F.count_if(F.col("valid")).alias("valid"),
        F.count_if(~F.col("valid")).alias("invalid"),
    )


def is_product_url(url: Column) -> Column:
    """Syntactic stand-in for a live check: an http(s) URL that carries a product id."""
    return url.rlike("^https?://[^/]+/") & product_id(url).isNotNull()


def drop_invalid_urls(
    df: DataFrame, invalid: DataFrame, url: str = "pageurl", row_id: str = "row_id"
) -> DataFrame:
    """Remove rows whose URL is in ``invalid``; rows without a URL stay."""
    return spread_join(df, invalid.select(url).distinct(), [url], row_id, "left_anti")


# --- filling ----------------------------------------------------------------
def last_per_key(side: DataFrame, key: str, columns: Sequence[str], order: str | None = None) -> DataFrame:
    """One row per key: the one that is last by ``order``, without it the one with the greatest values."""
    values = F.struct(*columns)
    last = F.max_by(values, F.struct(F.col(order), values)) if order else F.max(values)
    return side.groupBy(key).agg(last.alias("_last")).select(key, "_last.*")


def _beside(
    df: DataFrame, side: DataFrame, key: str, columns: Sequence[str], row_id: str, order: str | None = None
) -> DataFrame:
    """``df`` with the columns of ``side``, the last row of each key, attached as ``_new_*``; no row is repeated."""
    one = last_per_key(side, key, columns, order)
    renamed = one.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns])
    return spread_join(df, renamed, [key], row_id)


def fill_missing(
    df: DataFrame, side: DataFrame, key: str, columns: Sequence[str], row_id: str = "row_id", order: str | None = None
) -> DataFrame:
    """Fill NULLs of ``columns`` from the side table with the same key; of several rows the last by ``order`` counts."""
    columns = [c for c in present(df, columns) if c in side.columns]
    if not columns:
        return df
    joined = _beside(df, side, key, columns, row_id, order)
    return joined.withColumns({c: F.coalesce(F.col(c), F.col(f"_new_{c}")) for c in columns}).select(*df.columns)


def fill_from_scraped(
    df: DataFrame, scraped: DataFrame, row_id: str = "row_id", order: str | None = None
) -> DataFrame:
    """Title and rating from successfully scraped pages, only where they are NULL.

    Of several records of a URL the last by ``order`` counts.
    """
    good = scraped.where("success").withColumnRenamed("url", "pageurl")
    return fill_missing(df, good, "pageurl", ["title", "rating"], row_id, order)


def blank(c: Column, kind: str) -> Column:
    """NULL, empty text or empty list."""
    if kind.startswith("array"):
        return c.isNull() | (F.size(c) == 0)
    return c.isNull() | (c == "") if kind == "string" else c.isNull()


def fill_record(
    df: DataFrame,
    side: DataFrame,
    key: str,
    columns: Sequence[str],
    overwrite: bool = False,
    row_id: str = "row_id",
) -> DataFrame:
    """Take non-blank new values; without ``overwrite`` only where the old one is blank."""
    old, new = dict(df.dtypes), dict(side.dtypes)
    joined = _beside(df, side, key, columns, row_id)

    def pick(c: str) -> Column:
        fresh = F.col(f"_new_{c}")
        take = ~blank(fresh, new[c])
        if not overwrite:
            take = take & blank(F.col(c), old[c])
        return F.when(take, fresh).otherwise(F.col(c))

    return joined.withColumns({c: pick(c) for c in columns}).select(*df.columns)


def is_complete(df: DataFrame, required: Sequence[str]) -> Column:
    """True when every required column is filled."""
    kinds = dict(df.dtypes)
    out = F.lit(True)
    for c in required:
        out = out & ~blank(F.col(c), kinds[c])
    return out


# --- inference --------------------------------------------------------------
def _needs_title() -> Column:
    return F.col("title").isNull() | (F.col("title") == lx.UNKNOWN_TITLE)


def _needs_rating() -> Column:
    return F.col("rating").isNull() | (F.col("rating") == 0)


def needs_inference(df: DataFrame, min_length: int = 10) -> DataFrame:
    """Rows that lack a title or rating and have more than ``min_length`` characters of review."""
    return df.where((_needs_title() | _needs_rating()) & (F.length("review") > min_length))


def apply_inferred(
    df: DataFrame, inferred: DataFrame, key: str = "uniq_id", row_id: str = "row_id"
) -> DataFrame:
    """Inferred title over NULL/Unknown Product, inferred rating over NULL/0.

    An inferred empty title or rating 0 counts as no answer.
    """
    joined = _beside(df, inferred, key, ["title", "rating"], row_id)
    title, rating = F.col("_new_title"), F.col("_new_rating").cast("double")
    return joined.withColumns(
        {
            "title": F.when(_needs_title() & (title != ""), title).otherwise(F.col("title")),
            "rating": F.when(_needs_rating() & (rating != 0), rating).otherwise(F.col("rating")),
        }
    ).select(*df.columns)


# --- work lists -------------------------------------------------------------
def _worklist(df: DataFrame, gap: Column, known_bad: DataFrame, first: int | None) -> DataFrame:
    urls = df.where(gap & F.col("pageurl").isNotNull()).select("pageurl").distinct()
    todo = urls.join(known_bad.select("pageurl").distinct(), "pageurl", "left_anti")
    return todo if first is None else todo.orderBy("pageurl").limit(first)


def review_worklist(df: DataFrame, known_bad: DataFrame, first: int | None = None) -> DataFrame:
    """Distinct URLs with a missing review, without the known bad ones."""
    return _worklist(df, F.col("review").isNull(), known_bad, first)


def title_worklist(
    df: DataFrame,
    known_bad: DataFrame,
    columns: Sequence[str] = ("title", *lx.STAR_COLUMNS),
    first: int | None = None,
) -> DataFrame:
    """Distinct URLs with a missing title, or a missing first star column when titles are not wanted."""
    stars = [c for c in present(df, columns) if "star" in c]
    wanted = ["title"] if "title" in columns and "title" in df.columns else stars[:1]
    gap = F.col(wanted[0]).isNull() if wanted else F.lit(False)
    return _worklist(df, gap, known_bad, first)


def not_in(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """The different known keys of ``df`` that ``other`` lacks."""
    return df.select(key).where(F.col(key).isNotNull()).distinct().join(other.select(key).distinct(), key, "left_anti")
