"""Date expressions; all dates are zone-less timestamps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewgrain import lexicons as lx

DATE_FORMATS = ["yyyy-MM-dd HH:mm:ss Z", "MM/dd/yyyy", "dd MMM yyyy"]


def to_ntz(c: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Parse text in ISO form or one of ``formats``; unreadable text becomes NULL."""
    parsed = [c.try_cast("timestamp_ntz")]
    parsed += [F.try_to_timestamp(c, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*parsed)


def shift_years(c: Column, years: int = lx.YEARS_TO_SHIFT) -> Column:
    """Calendar shift back; keeps the time of day, 29 Feb falls back to 28 Feb."""
    return c - F.make_ym_interval(F.lit(years), F.lit(0))


def within(c: Column, earliest: str = lx.EARLIEST_DATE, latest: str = lx.LATEST_DATE) -> Column:
    """Drop the zone and turn dates outside [earliest, latest] into NULL."""
    local = c.cast("timestamp_ntz")
    low, high = (F.lit(x).cast("timestamp_ntz") for x in (earliest, latest))
    return F.when(local.between(low, high), local)


def year_month(c: Column) -> Column:
    """``yyyy-MM`` text."""
    return F.date_format(c, "yyyy-MM")
