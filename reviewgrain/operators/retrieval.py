"""Nearest aspect documents, aspect-by-name selection and summary quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewgrain.functions import text, vectors
from reviewgrain.functions.numeric import round_to


def with_similarity(df: DataFrame, query: Column, vector: str = "embedding") -> DataFrame:
    """Adds the cosine similarity to one query vector (a literal or a scalar sub-query)."""
    beside = df.withColumn("_query", query)
    return beside.withColumn("similarity", vectors.cosine(F.col(vector), F.col("_query"))).drop("_query")


def in_category(df: DataFrame, category: str, name: str = "category") -> DataFrame:
    """Case-insensitive equality on the category."""
    return df.where(F.lower(F.col(name)) == category.lower())


def search(
    documents: DataFrame,
    query: Column,
    top_k: int = 5,
    category: str | None = None,
    key: str = "doc_id",
    vector: str = "embedding",
) -> DataFrame:
    """The ``top_k`` documents nearest to the query vector; ties by key.

    One scan; every task keeps its own best ``top_k``.
    """
    rows = documents if category is None else in_category(documents, category)
    return with_similarity(rows, query, vector).orderBy(F.desc("similarity"), key).limit(top_k)


def relevant_rows(
    scored: DataFrame, threshold: float = 0.3, fallback: int = 20, key: str = "row_id"
) -> DataFrame:
    """Rows at or above ``threshold``; when there are none, the ``fallback`` nearest ones.

    ``position`` orders them: by key above the threshold, by similarity in the fallback.
    """
    passing = scored.where(F.col("similarity") >= threshold)
    any_passing = passing.limit(1).agg(F.count(F.lit(1)).alias("n")).scalar()
    nearest = scored.where(any_passing == 0).orderBy(F.desc("similarity"), key).limit(fallback)
    return passing.withColumn("by_threshold", F.lit(True)).unionByName(
        nearest.withColumn("by_threshold", F.lit(False))
    )


def relevance_samples(relevant: DataFrame, n: int = 5, key: str = "row_id") -> DataFrame:
    """Sample reviews with their similarity: in row order, by similarity in the fallback."""
    order = F.when(F.col("by_threshold"), F.lit(0.0)).otherwise(-F.col("similarity"))
    return relevant.orderBy(order, key).limit(n).select(
        key, "review", round_to(F.col("similarity"), 3).alias("similarity")
    )


# --- answers ----------------------------------------------------------------
def retrieved_context(hits: DataFrame, question: str) -> DataFrame:
    """One row: success, question, number of hits, context text and plain answer.

    ``hits`` is a top-k search result, so the lists are short.  Without hits
    ``success`` is false and the texts are NULL.
    """
    mood = F.concat(
        F.coalesce(F.col("sentiment.overall"), F.lit("unrated")), F.lit(", "),
        F.coalesce(F.col("sentiment.positive_pct").cast("string"), F.lit("?")), F.lit("% for and "),
        F.coalesce(F.col("sentiment.negative_pct").cast("string"), F.lit("?")), F.lit("% against"),
    )
    source = F.concat(F.lit("["), "category", F.lit(" / "), "aspect_name", F.lit("] "))
    block = F.concat(source, "summary", F.lit(" ("), F.col("review_count").cast("string"), F.lit(" reviews; "), mood, F.lit(")"))
    answer = F.concat("aspect_name", F.lit(" in "), "category", F.lit(": "), "summary", F.lit(" It is "), mood, F.lit("."))
    entry = F.struct(
        (-F.col("similarity")).alias("order"),
        "doc_id",
        block.alias("block"),
        answer.alias("answer"),
        round_to(F.col("similarity"), 4).alias("similarity"),
    )
    listed = hits.agg(F.array_sort(F.collect_list(entry)).alias("found"))
    found = F.size("found") > 0
    blocks = F.array_join(F.transform("found", lambda x: x["block"]), "\n")
    answers = F.transform("found", lambda x, i: F.concat((i + 1).cast("string"), F.lit(") "), x["answer"]))
    head = F.lit(f"{question}\n")
    return listed.select(
        found.alias("success"),
        F.lit(question).alias("query"),
        F.size("found").cast("long").alias("n_results"),
        F.when(found, blocks).alias("context"),
        F.when(found, F.concat(head, F.array_join(answers, "\n"))).alias("response"),
        F.transform("found", lambda x: x["similarity"]).alias("similarities"),
    )


def answer_prompt(context: Column, question: Column) -> Column:
    return F.format_string(
        "Answer the question from this review analysis only.\n\n%s\n\nQuestion: %s\nAnswer:", context, question
    )


# --- summaries against their sources ----------------------------------------
def compression(summaries: DataFrame, summary: str = "summary", samples: str = "samples") -> DataFrame:
    """Words in the summary over words in the sampled reviews; 0 without source words."""
    counted = F.transform(samples, lambda r: text.word_count(r).cast("long"))
    source = F.aggregate(counted, F.lit(0).cast("long"), lambda acc, n: acc + n)
    out = summaries.withColumns(
        {"summary_words": text.word_count(F.col(summary)).cast("long"), "source_words": source}
    )
    ratio = F.when(F.col("source_words") > 0, F.col("summary_words") / F.col("source_words")).otherwise(0.0)
    return out.withColumn("compression_ratio", round_to(ratio, 4))


def combined_source(samples: Column, limit: int | None = None) -> Column:
    """The sampled reviews as one context text, cut to ``limit`` characters if that is given."""
    joined = F.array_join(samples, " ")
    return joined if limit is None else text.truncate(joined, limit)
