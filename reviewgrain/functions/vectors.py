"""Expressions over ``array<float>`` / ``array<double>`` vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def unit(v: Column) -> Column:
    """Vector scaled to length 1; a zero vector stays zero."""
    length = norm(v)
    return F.transform(v, lambda x: F.when(length > 0, x.cast("double") / length).otherwise(0.0))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 when either vector is all zero."""
    size = norm(a) * norm(b)
    return F.when(size > 0, dot(a, b) / size).otherwise(0.0)


def squared_distance(a: Column, b: Column) -> Column:
    return _sum(
        F.zip_with(
            a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))
        )
    )


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(squared_distance(a, b))
