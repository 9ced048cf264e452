"""String expressions over review text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewgrain import lexicons as lx
from reviewgrain.functions.numeric import round_to

# Unicode white space plus the four ASCII separators, as one Java class.
SPACE = r"(?U)[\s\x1c-\x1f]"


def clean_text(c: Column) -> Column:
    """Collapse white space, then drop tags, then trim.

    The order matters: removing a tag can leave two blanks side by side, and
    they stay.  NULL stays NULL.
    """
    collapsed = F.regexp_replace(c, SPACE + "+", " ")
    return F.trim(F.regexp_replace(collapsed, "<[^>]+>", ""))


def null_tokens(c: Column, tokens: Sequence[str] = lx.NULL_TOKENS) -> Column:
    """NULL for the exact spellings in ``tokens`` (case-sensitive)."""
    return F.when(~c.isin(*tokens), c)


def strip_lower(c: Column) -> Column:
    """Lower case with white space of any kind removed at both ends."""
    return F.regexp_replace(F.lower(c), rf"{SPACE}+$|^[\s\x1c-\x1f]+", "")


def standardise(c: Column, mapping: Mapping[str, str], default: str = lx.UNKNOWN) -> Column:
    """Map known spellings, keep unknown ones, ``default`` for NULL."""
    text = c.cast("string")
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(table, text), text, F.lit(default))


def non_empty(c: Column) -> Column:
    """True for text that is neither NULL nor empty."""
    return c.isNotNull() & (c != "")


def tokens(c: Column) -> Column:
    """White-space tokens, without empty ones; NULL for NULL."""
    return F.filter(F.split(c, SPACE + "+"), lambda t: t != "")


def word_count(c: Column) -> Column:
    return F.coalesce(F.size(F.when(c.isNotNull(), tokens(c))), F.lit(0))


def text_length(c: Column) -> Column:
    """Code points; 0 for NULL."""
    return F.coalesce(F.length(c), F.lit(0))


def truncate(c: Column, n: int) -> Column:
    """First ``n`` code points, as used for prompt contexts."""
    return F.substring(c, 1, n)


def contains_any(c: Column, words: Sequence[str]) -> Column:
    """Literal substring test against every word; NULL text gives NULL."""
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(w)) for w in words])


def count_contained(c: Column, words: Sequence[str]) -> Column:
    """How many distinct listed words occur somewhere in the text."""
    return reduce(lambda a, b: a + b, [F.contains(c, F.lit(w)).cast("int") for w in words])


def first_contained(c: Column, words: Sequence[str]) -> Column:
    """The first *listed* word that occurs in the text, NULL when none does."""
    return F.coalesce(*[F.when(F.contains(c, F.lit(w)), F.lit(w)) for w in words])


def matches(c: Column, pattern: str, regex: bool = True) -> Column:
    """Case-insensitive search; NULL text never matches.

    ``regex=False`` looks for the literal text.
    """
    hit = c.rlike("(?i)" + pattern) if regex else F.contains(F.lower(c), F.lit(pattern.lower()))
    return F.coalesce(hit, F.lit(False))


def product_id(url: Column, patterns: Sequence[str] = lx.PRODUCT_ID_PATTERNS) -> Column:
    """Digits captured by the first pattern that matches the URL; NULL when none does."""
    return F.coalesce(*[F.nullif(F.regexp_extract(url, p, 1), F.lit("")) for p in patterns])


def sentiment_score(
    c: Column,
    positive: Sequence[str] = lx.POSITIVE_WORDS,
    negative: Sequence[str] = lx.NEGATIVE_WORDS,
) -> Column:
    """(p - n) / (p + n) over whole tokens, rounded to 3 places; 0 when no token hits.

    Tokens keep their punctuation, so ``great!`` is not a hit.
    """
    hits = F.filter(
        F.split(F.lower(c), SPACE + "+"), lambda t: t.isin(*positive, *negative)
    )

    def count(acc: Column, t: Column) -> Column:
        return F.struct(
            (acc["p"] + t.isin(*positive).cast("int")).alias("p"),
            (acc["n"] + t.isin(*negative).cast("int")).alias("n"),
        )

    def finish(acc: Column) -> Column:
        p, n = acc["p"], acc["n"]
        return F.when(p + n > 0, round_to((p - n) / (p + n), 3)).otherwise(0.0)

    zero = F.struct(F.lit(0).alias("p"), F.lit(0).alias("n"))
    return F.coalesce(F.aggregate(hits, zero, count, finish), F.lit(0.0))


def sentiment_label(score: Column) -> Column:
    return (
        F.when(score > 0.1, "positive").when(score < -0.1, "negative").otherwise("neutral")
    )


def window_around(text: Column, keyword: Column, reach: int = 50) -> Column:
    """Up to ``reach`` characters on both sides of the first occurrence of ``keyword``."""
    at = F.instr(text, keyword)
    start = F.greatest(at - reach, F.lit(1))
    stop = at + F.length(keyword) + reach
    return F.substring(text, start, stop - start)


def window_sentiment(
    context: Column,
    positive: Sequence[str] = lx.POSITIVE_WORDS,
    negative: Sequence[str] = lx.NEGATIVE_WORDS,
    negations: Sequence[str] = lx.NEGATION_WORDS,
) -> Column:
    """Polarity of a text window; any negation substring flips it, a tie is neutral."""
    balance = count_contained(context, positive) - count_contained(context, negative)
    negated = contains_any(context, negations)
    return (
        F.when(balance == 0, "neutral")
        .when((balance > 0) != negated, "positive")
        .otherwise("negative")
    )


def keyword_category(
    title: Column,
    categories: Mapping[str, Sequence[str]] = lx.CATEGORY_KEYWORDS,
    default: str = lx.OTHER,
) -> Column:
    """First category, in listed order, with a keyword inside the lower-cased title."""
    low = F.lower(title)
    return F.coalesce(
        *[F.when(contains_any(low, words), F.lit(name)) for name, words in categories.items()],
        F.lit(default),
    )


def polarity_flags(
    c: Column,
    positive: Sequence[str] = lx.CLUSTER_POSITIVE_WORDS,
    negative: Sequence[str] = lx.CLUSTER_NEGATIVE_WORDS,
) -> tuple[Column, Column]:
    """(has a positive word, has a negative word) by substring on lower-cased text."""
    low = F.lower(c)
    return (
        F.coalesce(contains_any(low, positive), F.lit(False)),
        F.coalesce(contains_any(low, negative), F.lit(False)),
    )
