"""Number, vote, rating and banding expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewgrain import lexicons as lx


def to_double(c: Column) -> Column:
    """Text or number to double; anything unreadable, and NaN, becomes NULL."""
    return F.nullif(c.try_cast("double"), F.lit(float("nan")))


def round_to(c: Column, places: int) -> Column:
    """Scale, round half to even, scale back: the rounding of numeric arrays.

    Unlike ``round`` it works on the binary value, so 2.125 -> 2.12.
    """
    scale = float(10**places)
    return F.rint(c * scale) / scale


def no_negative(c: Column) -> Column:
    return F.when(c < 0, F.lit(0.0)).otherwise(c)


def star_count(c: Column) -> Column:
    """Negatives to 0, then half-even rounding to a whole number."""
    return F.bround(no_negative(c), 0).cast("long")


def clip_rating(c: Column, low: float = 1.0, high: float = 5.0) -> Column:
    """Clip into [low, high]; NULL stays NULL."""
    return F.when(c < low, F.lit(low)).when(c > high, F.lit(high)).otherwise(c)


def total_votes(up: Column, down: Column) -> Column:
    return up + down


def vote_ratio(up: Column, total: Column) -> Column:
    """up / total, 0.5 when there are no (known) votes."""
    return F.when(total > 0, up / total).otherwise(0.5)


def wilson_lower_bound(up: Column, total: Column, z: float = lx.WILSON_Z) -> Column:
    """Lower end of the Wilson interval of the upvote share, at least 0, 4 places."""
    zz = F.lit(z * z)
    share = up / total
    spread = F.sqrt((share * (1 - share) + zz / (4 * total)) / total)
    low = (share + zz / (2 * total) - z * spread) / (1 + zz / total)
    bound = F.when(total > 0, round_to(F.greatest(F.lit(0.0), low), 4))
    return F.coalesce(bound, F.lit(0.0))


def binned(c: Column, bins: Sequence[tuple[float, str]], lowest: float = 0.0) -> Column:
    """Right-closed bins ``(upper, label)``; the first also includes ``lowest``."""
    out = F.when(c < lowest, F.lit(None).cast("string"))
    for upper, label in bins:
        out = out.when(c <= upper, F.lit(label))
    return out


def rating_category(c: Column) -> Column:
    return binned(c, [(2.0, "Low"), (3.5, "Medium"), (5.0, "High")])


def rating_sentiment(c: Column) -> Column:
    return binned(c, [(2.5, "Negative"), (3.5, "Neutral"), (5.0, "Positive")])


def format_number(c: Column, places: int = 2) -> Column:
    """1234567 -> 1.23M, 1234 -> 1.23K, otherwise the number with ``places`` decimals.

    Digits come from the binary value, half to even.
    """

    def shown(x: Column) -> Column:
        return F.replace(F.format_number(x, places), F.lit(","), F.lit(""))

    number = c.cast("double")
    return (
        F.when(number >= 1e6, F.concat(shown(number / 1e6), F.lit("M")))
        .when(number >= 1e3, F.concat(shown(number / 1e3), F.lit("K")))
        .otherwise(shown(number))
    )


def percent(part: Column, whole: Column, places: int | None = None) -> Column:
    """100 * part / whole; 0 when ``whole`` is 0."""
    value = F.when(whole > 0, part / whole * 100).otherwise(0.0)
    return value if places is None else round_to(value, places)


def banded(c: Column, cuts: Sequence[tuple[float, str]], lowest: str) -> Column:
    """Label of the first cut the value reaches, cuts listed from high to low."""
    out = F.when(c.isNull(), F.lit(None).cast("string"))
    for cut, label in cuts:
        out = out.when(c >= cut, F.lit(label))
    return out.otherwise(lowest)


def completeness_band(pct: Column) -> Column:
    return banded(pct, [(95, "complete"), (80, "partial")], "sparse")


# --- fixed values: quality thresholds ---------------------------------------
def silhouette_band(c: Column) -> Column:
    return banded(c, [(0.5, "good"), (0.25, "fair")], "weak")


def coherence_band(c: Column) -> Column:
    return banded(c, [(0.6, "very_good"), (0.4, "good"), (0.25, "fair")], "weak")


def coverage_band(c: Column) -> Column:
    return banded(c, [(70, "good"), (40, "fair")], "weak")


def relevance_band(c: Column) -> Column:
    return banded(c, [(0.7, "very_good"), (0.5, "good"), (0.3, "fair")], "weak")


def focus_band(c: Column) -> Column:
    return banded(c, [(0.4, "good"), (0.2, "fair")], "weak")


def balance_band(cv: Column) -> Column:
    return F.when(cv < 0.5, "good").when(cv < 1.0, "fair").when(cv.isNotNull(), "weak")


def davies_bouldin_band(c: Column) -> Column:
    """Lower is better; NULL (fewer than two clusters) counts as unbounded."""
    return F.when(c < 1.0, "good").when(c < 2.0, "fair").otherwise("weak")


def grade(c: Column) -> Column:
    return banded(c, [(0.7, "A"), (0.55, "B"), (0.4, "C"), (0.25, "D")], "F")
