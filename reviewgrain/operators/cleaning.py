"""The five quality dimensions: completeness, accuracy, validity, timeliness, uniqueness.

Every step skips columns the table does not have.  ``row_id`` orders the rows
wherever a rule says "first".
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewgrain import lexicons as lx
from reviewgrain.functions import dates, numeric, text
from reviewgrain.operators.scaling import importable, spread_join, store


def present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def apply_to(df: DataFrame, columns: Sequence[str], rule: Callable[[Column], Column]) -> DataFrame:
    """Replace each existing column by ``rule(column)`` in one projection."""
    return df.withColumns({c: rule(F.col(c)) for c in present(df, columns)})


# --- completeness -----------------------------------------------------------
def clean_text_columns(df: DataFrame, columns: Sequence[str] = lx.TEXT_COLUMNS) -> DataFrame:
    return apply_to(df, columns, lambda c: text.null_tokens(text.clean_text(c.cast("string"))))


def coerce_types(
    df: DataFrame,
    numbers: Sequence[str] = lx.NUMERIC_COLUMNS,
    dated: Sequence[str] = lx.DATE_COLUMNS,
) -> DataFrame:
    """Numbers to double, dates to zone-less timestamps; unreadable values become NULL."""
    kinds = dict(df.dtypes)
    df = apply_to(df, numbers, numeric.to_double)
    texts = [c for c in present(df, dated) if kinds[c] == "string"]
    stamps = [c for c in present(df, dated) if kinds[c] in ("date", "timestamp")]
    df = apply_to(df, texts, dates.to_ntz)
    return apply_to(df, stamps, lambda c: c.cast("timestamp_ntz"))


def merge_by_url(
    df: DataFrame,
    columns: Sequence[str] = ("title", *lx.STAR_COLUMNS),
    url: str = "pageurl",
    row_id: str = "row_id",
) -> DataFrame:
    """Fill gaps from the first row (by ``row_id``) of the same URL that has a value.

    Rows without a URL are left alone.  One grouped pass with map-side
    combining serves all columns; the join back spreads hot URLs.
    """
    columns = present(df, columns)
    if url not in df.columns or not columns:
        return df
    first = [
        F.min_by(c, F.when(F.col(c).isNotNull(), F.col(row_id))).alias(f"_{c}") for c in columns
    ]
    per_url = df.where(F.col(url).isNotNull()).groupBy(url).agg(*first)
    joined = spread_join(df, per_url, [url], row_id)
    filled = joined.withColumns({c: F.coalesce(F.col(c), F.col(f"_{c}")) for c in columns})
    return filled.select(*df.columns)


#: Bits of a value that one round of the selection counts.
RADIX = 16


def _ordered_keys(df: DataFrame, column: str) -> DataFrame:
    """The known values as longs in the same order (``key``); -0 counts as 0, NaN as the greatest value."""
    importable(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = batch.column("v").to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
            bits = np.where(np.isnan(value), np.nan, value).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bits ^ ((bits >> 63) & np.iinfo(np.int64).max))], ["key"])

    known = df.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL")
    return known.mapInArrow(run, "key long")


def _value_of(key: int) -> float:
    bits = np.array([key], np.int64)
    return float((bits ^ ((bits >> 63) & np.iinfo(np.int64).max)).view(np.float64)[0])


def exact_median(df: DataFrame, column: str) -> Column:
    """Exact, interpolated median as a literal (NULL without a known value), for columns with any number of values.

    Radix selection on the bits of the values: every round counts the next RADIX bits of the values that share the bits found so far.  So there are
    64 / RADIX rounds over the stored keys with at most 2 * 2**RADIX counters each, however the values lie, and no order of rows.
    """
    keys = store(_ordered_keys(df, column), "median-keys")
    left: dict[int, int] = {}  # rank among all rows: rank among the values with its bits so far
    prefix: dict[int, int] = {}
    for shift in range(64 - RADIX, -1, -RADIX):
        digit = F.shiftright("key", shift)
        rows = keys
        if prefix:
            digit = digit.bitwiseAND(F.lit((1 << RADIX) - 1))
            rows = keys.where(F.shiftright("key", shift + RADIX).isin(sorted(set(prefix.values()))))
        above = F.shiftright("key", shift + RADIX) if prefix else F.lit(0).cast("long")
        counts: dict[int, list] = {}
        for r in rows.groupBy(above.alias("above"), digit.alias("digit")).agg(F.count(F.lit(1)).alias("n")).collect():
            counts.setdefault(r["above"], []).append((r["digit"], r["n"]))
        if not counts:
            return F.lit(None).cast("double")
        if not prefix:
            total = sum(n for _, n in counts[0])
            left = {rank: rank for rank in ((total - 1) // 2, total // 2)}
        for rank in left:
            for value, n in sorted(counts[prefix.get(rank, 0)]):
                if left[rank] < n:
                    prefix[rank] = (prefix[rank] << RADIX) | value if rank in prefix else value
                    break
                left[rank] -= n
    ends = [_value_of(key) for key in prefix.values()]
    lower, upper = min(ends), max(ends)
    return F.lit(lower if lower == upper else lower + (upper - lower) * 0.5)


def fill_rating_median(df: DataFrame, column: str = "rating", many_values: bool = False) -> DataFrame:
    """NULL ratings take the exact, interpolated median of the known ones.

    The plain form holds one counter per distinct rating, which suits ratings;
    ``many_values`` is for columns such as prices.
    """
    if column not in df.columns:
        return df
    median = exact_median(df, column) if many_values else df.agg(F.percentile(column, 0.5)).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), median))


def fill_constants(df: DataFrame) -> DataFrame:
    zeros = {c: 0 for c in present(df, [*lx.VOTE_COLUMNS, *lx.STAR_COLUMNS])}
    words = {
        "title": lx.UNKNOWN_TITLE,
        "reviewer_name": lx.ANONYMOUS,
        "verified_purchaser": lx.UNKNOWN,
        "recommended_purchase": lx.UNKNOWN,
    }
    known = {c: word for c, word in words.items() if c in df.columns}
    return df.fillna({**zeros, **known}) if zeros or known else df


def fill_defaults(df: DataFrame) -> DataFrame:
    return fill_constants(fill_rating_median(df))


# --- accuracy ---------------------------------------------------------------
def fix_values(df: DataFrame) -> DataFrame:
    """Negative votes to 0; star counts to whole, non-negative numbers."""
    df = apply_to(df, lx.VOTE_COLUMNS, numeric.no_negative)
    return apply_to(df, lx.STAR_COLUMNS, numeric.star_count)


# --- validity ---------------------------------------------------------------
def standardise_columns(df: DataFrame) -> DataFrame:
    df = apply_to(df, ["verified_purchaser"], lambda c: text.standardise(c, lx.VERIFIED_MAP))
    df = apply_to(df, ["recommended_purchase"], lambda c: text.standardise(c, lx.RECOMMENDED_MAP))
    return apply_to(df, ["website"], text.strip_lower)


def clip_ratings(df: DataFrame) -> DataFrame:
    return apply_to(df, ["rating"], numeric.clip_rating)


# --- timeliness -------------------------------------------------------------
def shift_dates(df: DataFrame, years: int | None = None) -> DataFrame:
    """Shift the date columns back; ``years=0`` really means no shift."""
    span = lx.YEARS_TO_SHIFT if years is None else years
    return apply_to(df, lx.DATE_COLUMNS, lambda c: dates.shift_years(c, span))


def validate_dates(df: DataFrame) -> DataFrame:
    return apply_to(df, lx.DATE_COLUMNS, dates.within)


# --- uniqueness -------------------------------------------------------------
#: JSON that differs whenever two values do.
LOSSLESS = {
    "ignoreNullFields": "false",
    "timeZone": "UTC",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _row_digest(df: DataFrame, row_id: str) -> Column:
    """Digest of all columns but the row id; NULL and empty text differ, times count to the microsecond."""
    return F.sha2(F.to_json(F.struct(*[c for c in df.columns if c != row_id]), LOSSLESS), 256)


def same_review_keys(df: DataFrame) -> list[Column]:
    """Grouping keys for "same reviewer, product and text"; long text enters as a digest."""
    keys = {
        "pageurl": F.col("pageurl"),
        "reviewer_name": F.col("reviewer_name"),
        "review": F.sha2(F.col("review"), 256),
    }
    names = present(df, list(keys))
    return [keys[n].alias(f"_{n}") for n in names] if len(names) >= 2 else []


def surviving_ids(df: DataFrame, row_id: str) -> DataFrame:
    """Row ids that survive all passes, worked out on digests only.

    Equal rows also agree on reviewer, product and text, so the first row of a
    "same review" group is the survivor of the exact pass and of this one.
    NULLs compare equal in every pass.
    """
    keys = same_review_keys(df) or [_row_digest(df, row_id).alias("_row")]
    unique = F.col("uniq_id") if "uniq_id" in df.columns else F.lit(None).cast("string")
    slim = df.select(*keys, F.struct(F.col(row_id).alias("id"), unique.alias("unique")).alias("_first"))
    names = [c for c in slim.columns if c != "_first"]
    firsts = slim.groupBy(*names).agg(F.min("_first").alias("_first"))
    if "uniq_id" not in df.columns:
        return firsts.select(F.col("_first.id").alias(row_id))
    return (
        firsts.select("_first.*")
        .groupBy("unique")
        .agg(F.min("id").alias(row_id))
        .select(row_id)
    )


def drop_duplicates(df: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Exact copies, then same (pageurl, reviewer_name, review), then same uniq_id.

    The first row by ``row_id`` stays.  Groups are reduced map-side, so a third
    of the table being copies of one row costs nothing extra; whole rows are
    shuffled once, on the unique row id.
    """
    return df.join(surviving_ids(df, row_id), row_id, "left_semi")


def duplicate_counts(df: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Rows removed by each of the three passes, in long form."""
    same = same_review_keys(df)
    unique = ["uniq_id"] if "uniq_id" in df.columns else []
    digests = df.select(
        _row_digest(df, row_id).alias("_row"),
        *same,
        F.struct(F.col(row_id).alias("id"), *unique).alias("_first"),
    )
    names = [c for c in digests.columns if c not in ("_row", "_first")]
    exact = digests.groupBy("_row", *names).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_first").alias("_first")
    )
    if same:
        review = exact.groupBy(*names).agg(
            F.sum("_rows").alias("_rows"),
            F.count(F.lit(1)).alias("_exact"),
            F.min("_first").alias("_first"),
        )
    else:
        review = exact.withColumn("_exact", F.lit(1))
    if unique:
        last = review.groupBy("_first.uniq_id").agg(
            F.sum("_rows").alias("_rows"),
            F.sum("_exact").alias("_exact"),
            F.count(F.lit(1)).alias("_review"),
        )
    else:
        last = review.withColumn("_review", F.lit(1))
    totals = last.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("_exact"), F.lit(0)).alias("exact"),
        F.coalesce(F.sum("_review"), F.lit(0)).alias("review"),
        F.count(F.lit(1)).alias("kept"),
    )
    rows = [
        F.struct(F.lit("exact").alias("strategy"), (F.col("rows") - F.col("exact")).alias("removed")),
        F.struct(F.lit("same_review").alias("strategy"), (F.col("exact") - F.col("review")).alias("removed")),
        F.struct(F.lit("uniq_id").alias("strategy"), (F.col("review") - F.col("kept")).alias("removed")),
        F.struct(F.lit("total").alias("strategy"), (F.col("rows") - F.col("kept")).alias("removed")),
    ]
    share = F.coalesce(F.col("removed") / F.nullif(F.col("rows"), F.lit(0)) * 100, F.lit(0.0))
    return totals.select("rows", F.inline(F.array(*rows))).select(
        "strategy", "removed", numeric.round_to(share, 2).alias("removed_pct")
    )


# --- derived columns --------------------------------------------------------
def add_derived(df: DataFrame) -> DataFrame:
    has = set(df.columns)
    out: dict[str, Column] = {}
    if "pageurl" in has:
        out["product_id"] = text.product_id(F.col("pageurl"))
    if {"review_upvotes", "review_downvotes"} <= has:
        up = F.col("review_upvotes")
        total = numeric.total_votes(up, F.col("review_downvotes"))
        out["total_votes"] = total
        out["vote_ratio"] = numeric.vote_ratio(up, total)
        out["helpfulness_score"] = numeric.wilson_lower_bound(up, total)
    if "review" in has:
        out["review_length"] = text.text_length(F.col("review"))
        out["word_count"] = text.word_count(F.col("review"))
    if "rating" in has:
        out["rating_category"] = numeric.rating_category(F.col("rating"))
        out["rating_sentiment"] = numeric.rating_sentiment(F.col("rating"))
    if "review_date" in has:
        out["review_year"] = F.year("review_date")
        out["review_month"] = F.month("review_date")
        out["review_year_month"] = dates.year_month(F.col("review_date"))
    return df.withColumns(out) if out else df
