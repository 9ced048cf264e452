"""Missing values, distinct counts and quality reports, one scan of the table each."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewgrain import lexicons as lx
from reviewgrain.functions.numeric import completeness_band, percent, round_to
from reviewgrain.operators.cleaning import LOSSLESS, present
from reviewgrain.operators.scaling import store


def _null_counts(df: DataFrame) -> DataFrame:
    """One row per column: column, dtype, position, rows, non_null."""
    totals = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(f"_{i}") for i, c in enumerate(df.columns)]
    )
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(kind).alias("dtype"),
            F.col("_rows").alias("rows"),
            F.col(f"_{i}").alias("non_null"),
        )
        for i, (c, kind) in enumerate(df.dtypes)
    ]
    return totals.select(F.inline(F.array(*entries)))


def missing_required(df: DataFrame, required: Sequence[str] = lx.REQUIRED_COLUMNS) -> DataFrame:
    """Required columns the table lacks, with the number of rows concerned."""
    absent = sorted(set(required) - set(df.columns))
    names = F.array(*[F.lit(c) for c in absent]) if absent else F.array().cast("array<string>")
    return df.agg(F.count(F.lit(1)).alias("rows")).select(F.explode(names).alias("column"), "rows")


def column_info(df: DataFrame, exact: bool = True) -> DataFrame:
    """column, dtype, non_null_count, null_count, null_percent, unique_count.

    One scan.  For exact distinct counts the columns are stored, long values as digests, and each is counted by itself: combined map-side and shuffled
    without the other columns.  ``exact=False`` uses a sketch per column instead.
    """
    kinds = [kind for _, kind in df.dtypes]
    if exact:
        df = store(df.select(*[_compact(c, kind).alias(f"{i}") for i, (c, kind) in enumerate(df.dtypes)]), "column-values").toDF(*df.columns)
    one_row = [
        df.agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.count(c).alias(f"_known{i}") for i, c in enumerate(df.columns)],
            *([] if exact else [F.approx_count_distinct(c).alias(f"_unique{i}") for i, c in enumerate(df.columns)]),
        ),
        *[df.agg(F.count_distinct(c).alias(f"_unique{i}")) for i, c in enumerate(df.columns) if exact],
    ]
    totals = reduce(DataFrame.crossJoin, one_row)
    rows = F.col("_rows")
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(kind).alias("dtype"),
            F.col(f"_known{i}").alias("non_null_count"),
            (rows - F.col(f"_known{i}")).alias("null_count"),
            percent(rows - F.col(f"_known{i}"), rows, 2).alias("null_percent"),
            F.col(f"_unique{i}").alias("unique_count"),
        )
        for i, (c, kind) in enumerate(zip(df.columns, kinds, strict=True))
    ]
    return totals.select(F.inline(F.array(*entries)))


def _compact(name: str, kind: str) -> Column:
    """Something short that is equal exactly when the values are."""
    c = F.col(name)
    if kind.startswith(("array", "map", "struct")):
        return F.sha2(F.to_json(c, LOSSLESS), 256)
    if kind == "string":
        return F.when(F.octet_length(c) >= 64, F.sha2(c, 256)).otherwise(c)  # a digest has 64 characters
    return c.cast("string") if kind == "void" else c


def missing_info(df: DataFrame) -> DataFrame:
    """column, missing_count, missing_percent, completeness, dtype; most missing first."""
    missing = F.col("rows") - F.col("non_null")
    return (
        _null_counts(df)
        .select(
            "column",
            missing.alias("missing_count"),
            percent(missing, F.col("rows"), 2).alias("missing_percent"),
            round_to((1 - missing / F.col("rows")) * 100, 2).alias("completeness"),
            "dtype",
        )
        .orderBy(F.desc("missing_count"), "column")
    )


def completeness_status(df: DataFrame) -> DataFrame:
    """Completeness per column with its band, least complete first."""
    return (
        missing_info(df)
        .select("column", "completeness", completeness_band(F.col("completeness")).alias("status"))
        .orderBy("completeness", "column")
    )


def missing_cells(df: DataFrame) -> DataFrame:
    """Number of NULL cells in the whole table."""
    return _null_counts(df).agg(F.sum(F.col("rows") - F.col("non_null")).alias("missing_cells"))


def quality_report(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """(metric, value) rows: sizes before and after, completeness, products, date range."""
    before = raw.agg(F.count(F.lit(1)).alias("n")).scalar()
    aggregates = [F.count(F.lit(1)).alias("_rows")]
    aggregates += [F.count(c).alias(f"_{i}") for i, c in enumerate(cleaned.columns)]
    extras = []
    if "product_id" in cleaned.columns:
        aggregates.append(F.count_distinct("product_id").alias("_products"))
        extras.append(_metric("unique_products", F.col("_products")))
    if "review_date" in cleaned.columns:
        stamp = "yyyy-MM-dd HH:mm:ss"
        aggregates += [F.min("review_date").alias("_from"), F.max("review_date").alias("_to")]
        extras += [
            _metric("first_review_date", F.date_format("_from", stamp)),
            _metric("last_review_date", F.date_format("_to", stamp)),
        ]
    totals = cleaned.agg(*aggregates).withColumn("_before", before)
    rows = [
        _metric("initial_rows", F.col("_before")),
        _metric("final_rows", F.col("_rows")),
        _metric("rows_removed", F.col("_before") - F.col("_rows")),
        _metric("initial_columns", F.lit(len(raw.columns))),
        _metric("final_columns", F.lit(len(cleaned.columns))),
        *extras,
        *[
            _metric(
                f"completeness.{c}",
                round_to(F.col(f"_{i}") / F.nullif(F.col("_rows"), F.lit(0)) * 100, 2).cast("decimal(5,2)"),
            )
            for i, c in enumerate(cleaned.columns)
        ],
    ]
    return totals.select(F.inline(F.array(*rows)))


def _metric(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("metric"), value.cast("string").alias("value"))


def urls_with_missing(df: DataFrame, columns: Sequence[str] = lx.SCRAPABLE_COLUMNS) -> DataFrame:
    """Distinct URLs with a gap in any of ``columns``."""
    gap = F.lit(False)
    for c in present(df, columns):
        gap = gap | F.col(c).isNull()
    return df.where(gap & F.col("pageurl").isNotNull()).select("pageurl").distinct()


def imputation_report(df: DataFrame, scraped: DataFrame, invalid_urls: DataFrame) -> DataFrame:
    """(metric, value, percent): sizes of the side tables, then NULLs per column."""
    side = scraped.agg(
        F.count(F.lit(1)).alias("scraped_urls"), F.count_if(F.col("success")).alias("scraped_success")
    )
    nulls = _null_counts(df)
    per_column = nulls.select(
        F.concat(F.lit("nulls."), F.col("column")).alias("metric"),
        (F.col("rows") - F.col("non_null")).alias("value"),
        percent(F.col("rows") - F.col("non_null"), F.col("rows"), 2).alias("percent"),
    )
    none = F.lit(None).cast("double").alias("percent")
    pairs = [F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in side.columns]
    return (
        df.agg(F.count(F.lit(1)).alias("value"))
        .select(F.lit("total_rows").alias("metric"), "value", none)
        .unionByName(side.select(F.inline(F.array(*pairs))).select("metric", "value", none))
        .unionByName(
            invalid_urls.agg(F.count(F.lit(1)).alias("value")).select(
                F.lit("invalid_urls").alias("metric"), "value", none
            )
        )
        .unionByName(per_column)
    )
