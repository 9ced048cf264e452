"""Queries over the given tables and the SQL they are checked against."""

from registry import (  # noqa: F401
    aggregates,
    cleaning,
    clusters,
    exchanges,
    joins,
    plans,
    profiling,
    scalars,
    storage,
    textual,
    topics,
    web,
)
from registry.base import ORACLES, QUERIES  # noqa: F401
