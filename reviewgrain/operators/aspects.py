"""Aspect mentions with a polarity taken from the text around the keyword.

The canonical form is an array column ``aspects`` of (aspect, keyword, context);
roll-ups explode it, the wide boolean form is derived from it.  No shuffle is
needed to find the mentions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewgrain import lexicons as lx
from reviewgrain.functions import text
from reviewgrain.functions.numeric import percent

Keywords = Mapping[str, Sequence[str]]


def find_aspects(df: DataFrame, keywords: Keywords = lx.ASPECT_KEYWORDS, review: str = "review") -> DataFrame:
    """Adds ``aspects``: one entry per aspect with a keyword in the lower-cased review.

    The first *listed* keyword decides; its surroundings become the context.
    A missing review has no aspects.
    """
    names = list(keywords)
    low = df.withColumn("_low", F.lower(F.col(review)))
    hits = low.withColumns(
        {f"_kw{i}": text.first_contained(F.col("_low"), keywords[a]) for i, a in enumerate(names)}
    )
    entries = [
        F.when(
            F.col(f"_kw{i}").isNotNull(),
            F.struct(
                F.lit(a).alias("aspect"),
                F.col(f"_kw{i}").alias("keyword"),
                text.window_around(F.col("_low"), F.col(f"_kw{i}")).alias("context"),
            ),
        )
        for i, a in enumerate(names)
    ]
    found = F.array_compact(F.array(*entries))
    return hits.withColumn("aspects", found).drop("_low", *[f"_kw{i}" for i in range(len(names))])


def mentions(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Long form of ``find_aspects``: ``keep`` columns, aspect, keyword, sentiment."""
    return long_form(df, keep).select(
        *keep, "aspect", "keyword", text.window_sentiment(F.col("context")).alias("sentiment")
    )


def long_form(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per entry of ``aspects``: ``keep`` columns, aspect, keyword, context.

    The outer form keeps Spark from searching every text a second time just to
    see whether the array is empty.
    """
    return df.select(*keep, F.inline_outer("aspects")).where(F.col("aspect").isNotNull())


def widen(df: DataFrame, names: Sequence[str] = tuple(lx.ASPECT_KEYWORDS)) -> DataFrame:
    """``has_<aspect>`` and ``<aspect>_sentiment`` columns instead of ``aspects``."""
    pairs = F.transform(
        "aspects", lambda a: F.struct(a["aspect"], text.window_sentiment(a["context"]))
    )
    mapped = df.withColumn("_by_aspect", F.map_from_entries(pairs))
    out: dict[str, Column] = {}
    for a in names:
        out[f"has_{a}"] = F.map_contains_key("_by_aspect", a)
        out[f"{a}_sentiment"] = F.try_element_at(F.col("_by_aspect"), F.lit(a))
    return mapped.withColumns(out).drop("_by_aspect", "aspects")


def aspect_grid(
    df: DataFrame, keys: Sequence[str] = (), names: Sequence[str] = tuple(lx.ASPECT_KEYWORDS)
) -> DataFrame:
    """Every (keys, aspect) pair with its counts, zeros included, and the group ``total``.

    One scan: each review contributes its mentions plus one unnamed entry that
    counts the review itself, and all of it is combined map-side.  The second
    grouping sees at most one row per group and aspect.  Groups with a NULL key
    are left out.
    """
    kinds = ("positive", "negative", "neutral")
    marker = F.struct(*[F.lit("").alias(c) for c in ("aspect", "keyword", "context")])
    rows = df.select(*keys, F.concat(F.array(marker), "aspects").alias("aspects"))
    for key in keys:
        rows = rows.where(F.col(key).isNotNull())
    counts = (
        mentions(rows, keys)
        .groupBy(*keys, "aspect")
        .agg(
            F.count(F.lit(1)).alias("mentions"),
            *[F.count_if(F.col("sentiment") == s).alias(s) for s in kinds],
        )
    )
    per_group = counts.groupBy(*keys).agg(
        F.coalesce(F.max(F.when(F.col("aspect") == "", F.col("mentions"))), F.lit(0)).alias("total"),
        F.map_from_entries(F.collect_list(F.struct("aspect", F.struct("mentions", *kinds)))).alias("_by"),
    )
    listed = F.posexplode(F.array(*[F.lit(a) for a in names])).alias("position", "aspect")
    grid = per_group.select(*keys, "total", "_by", listed)
    found = F.try_element_at(F.col("_by"), F.col("aspect"))
    return grid.select(
        *keys,
        "total",
        "position",
        "aspect",
        *[F.coalesce(found[c], F.lit(0)).alias(c) for c in ("mentions", *kinds)],
    )


def aspect_summary(df: DataFrame, group_by: str | None = None) -> DataFrame:
    """Mention rate and net sentiment per aspect, overall (most mentioned first) or per group."""
    keys = [] if group_by is None else [group_by]
    grid = aspect_grid(df, keys)
    m = F.col("mentions")
    out = grid.select(
        *[F.col(k).alias("group") for k in keys],
        "aspect",
        "mentions",
        percent(m, F.col("total"), 2).alias("mention_rate"),
        "positive",
        "negative",
        "neutral",
        percent(F.col("positive") - F.col("negative"), m, 2).alias("sentiment_score"),
    )
    return out if keys else out.orderBy(F.desc("mentions"), "aspect")


def aspect_map(df: DataFrame) -> DataFrame:
    """Unrounded mention, positive and negative rates per aspect, most mentioned first."""
    m = F.col("mentions")
    return (
        aspect_grid(df)
        .select(
            "aspect",
            "mentions",
            percent(m, F.col("total")).alias("mention_rate"),
            percent(F.col("positive"), m).alias("positive_rate"),
            percent(F.col("negative"), m).alias("negative_rate"),
        )
        .orderBy(F.desc("mentions"), "aspect")
    )
