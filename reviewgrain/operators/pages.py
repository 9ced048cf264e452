"""Product facts out of page HTML."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewgrain.functions.text import clean_text

# --- fixed values: classes of the title and the rating element ---------------
TITLE_CLASSES = ["normal", "dark-gray", "mb0", "lh-title", "lh-copy-m", "f3-m", "f6"]
RATING_CLASSES = ["w-30"]

_ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}


def element_with_classes(html: Column, classes: Sequence[str]) -> Column:
    """The inside of the first element that carries all the classes, whatever lies in it; NULL without one.

    It ends at its own end tag, or with the page if there is none: start tags of the same name add one to a running depth, end tags take one away, and the
    tag at which the depth is 0 is the end.
    """
    wanted = "".join(rf"(?=[^\"']*(?<![\w-]){c}(?![\w-]))" for c in classes)
    start = F.regexp_substr(html, F.lit(rf"(?s)<\w[\w-]*+\b[^>]*\bclass\s*=\s*[\"']{wanted}[^>]*>"))
    rest = F.substr(html, F.instr(html, start) + F.length(start))
    tag = F.concat(F.lit("(?i)</?"), F.regexp_extract(start, r"<(\w[\w-]*)", 1), F.lit(r"(?![\w-])[^>]*+>"))
    tags = F.regexp_extract_all(rest, tag, F.lit(0))

    def count(s: Column, t: Column) -> Column:
        step = F.when(t.startswith("</"), -1).otherwise(1)
        return F.when(s["depth"] == 0, s).otherwise(F.struct((s["depth"] + step).alias("depth"), (s["read"] + 1).alias("read")))

    seen = F.aggregate(tags, F.struct(F.lit(1).alias("depth"), F.lit(0).alias("read")), count)
    parts = F.zip_with(F.split(rest, tag), tags, lambda part, after: F.concat(part, F.coalesce(after, F.lit(""))))
    # the part before every tag read, with that tag; all parts if no end tag fits
    n = F.when(seen["depth"] == 0, seen["read"]).otherwise(F.size(tags) + 1)
    return F.array_join(F.slice(parts, F.lit(1), n), "")


def inner_text(markup: Column) -> Column:
    """Text of an element: tags dropped, common entities resolved."""
    out = F.regexp_replace(markup, "<[^>]*>", "")
    for entity, char in _ENTITIES.items():
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def extract_pages(
    pages: DataFrame,
    title: str | Sequence[str] = tuple(TITLE_CLASSES),
    rating: str | Sequence[str] = tuple(RATING_CLASSES),
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """(url, success, title, rating, error): one row per page, failures included.

    title and rating say where they are: the classes of an element, or a pattern whose last group holds the markup.  The rating
    is the first number in its text.
    """

    def inside(place: str | Sequence[str]) -> Column:
        if not isinstance(place, str):
            return inner_text(element_with_classes(F.col(html), place))
        last = len(re.findall(r"(?<!\\)\((?!\?)", place))
        return F.when(F.col(html).rlike(place), inner_text(F.regexp_extract(html, place, last)))

    number = F.regexp_extract(inside(rating), r"(\d+\.?\d*)", 1)
    out = pages.select(
        url,
        clean_text(inside(title)).alias("title"),
        F.nullif(number, F.lit("")).try_cast("double").alias("rating"),
    )
    success = F.col("title").isNotNull() | F.col("rating").isNotNull()
    return out.select(
        url,
        success.alias("success"),
        "title",
        "rating",
        F.when(~success, "no product data").alias("error"),
    )


def batch_counts(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if("success").alias("succeeded"),
        F.count_if(~F.col("success")).alias("failed"),
    )
