"""Stored aspect documents: one row per document, vector included."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewgrain.operators.retrieval import in_category
from reviewgrain.sources import versioned

DOCUMENT_SCHEMA = (
    "doc_id string, category string, aspect_name string, summary string, "
    "sentiment struct<overall: string, positive_pct: double, negative_pct: double, neutral_pct: double>, "
    "review_count long, sample_reviews array<string>, embedding array<float>, created_at timestamp_ntz"
)


def document_text() -> Column:
    """The text a document is encoded from."""
    return F.concat_ws(" ", "category", "aspect_name", "summary")


class AspectStore:
    """A versioned table of aspect documents: saves, additions and updates are whole or not there, and old versions can be read."""

    def __init__(self, spark: SparkSession, path: str):
        self.table = versioned.VersionedTable(spark, path, ["doc_id"], DOCUMENT_SCHEMA)

    def save(self, documents: DataFrame) -> int:
        """Replace the stored documents; ``documents`` may come from this store."""
        return self.table.save(documents)

    def append(self, documents: DataFrame, token: str | None = None) -> int:
        """Add documents; a write tried again with the same token is only done once."""
        return self.table.append(documents, token)

    def upsert(self, documents: DataFrame, token: str | None = None) -> int:
        """Replace the documents with these ids, and add the new ones."""
        return self.table.upsert(documents, token)

    def clear(self) -> int:
        return self.table.save(self.table._spark.createDataFrame([], DOCUMENT_SCHEMA))

    def load(self, version: int | None = None) -> DataFrame:
        """The stored documents, none if nothing was saved yet."""
        return self.table.read(version)


def with_missing_vectors(documents: DataFrame, encode: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Encode only the documents without a vector; ``encode`` fills ``embedding`` from ``text``."""
    have = documents.where(F.col("embedding").isNotNull())
    todo = documents.where(F.col("embedding").isNull()).drop("embedding").withColumn("text", document_text())
    return have.unionByName(encode(todo).drop("text").select(*documents.columns))


def add_documents(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Stored and new documents; a column that one of them lacks is NULL."""
    return stored.unionByName(new, allowMissingColumns=True)


def without_vectors(documents: DataFrame) -> DataFrame:
    return documents.drop("embedding")


def of_category(documents: DataFrame, category: str) -> DataFrame:
    return in_category(documents, category)


def categories(documents: DataFrame) -> DataFrame:
    return documents.select("category").distinct()


def stats(documents: DataFrame) -> DataFrame:
    """Status, sizes, dimension and last change of a store, in one row.

    The category names themselves are the table given by ``categories``.
    """
    return documents.agg(
        F.when(F.count(F.lit(1)) > 0, "ready").otherwise("empty").alias("status"),
        F.count(F.lit(1)).alias("n_documents"),
        F.count_distinct("category").alias("n_categories"),
        F.coalesce(F.max(F.size("embedding")), F.lit(0)).cast("long").alias("embedding_dim"),
        F.max("created_at").alias("last_updated"),
    )
