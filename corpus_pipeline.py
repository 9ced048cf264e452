"""A pipeline over documents: language, repeated lines, near duplicates, benchmark leaks, tokens.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the docs of the next stage.  All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewgrain.llm import byte_bpe, decontaminate, language_id, line_dedup, simhash
from reviewgrain.llm.shared import importable, renamed, store

#: A document this far from every profile (score: 1 less the distance's share of the largest) is in no known language.
LEAST_SCORE = 0.25
VOCABULARY = "byte_bpe_50k.tiktoken"
#: The encoder's memory here, beside what executors hold from the stages before.
REMEMBERED = 40_000


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in one of the languages that the documents name; lang becomes the language found.

    Rejected: texts without a letter (NULL and empty ones too) and texts far from all profiles.
    """
    importable(spark)
    training = docs.where(~language_id.held_out("doc_id"))
    rows, names = renamed(docs)
    found = language_id.predict(rows, language_id.learn(training), text=names["text"], keep=rows.columns)
    known = found.where((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= LEAST_SCORE))
    return known.select(*[F.col("lang_pred" if c == "lang" else names[c]).alias(c) for c in docs.columns])


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete later copies of repeated runs of lines; a document of which nothing is left goes."""
    importable(spark)
    rows, names = renamed(docs)
    out = line_dedup.without_later_copies(rows, names["text"], names["doc_id"])
    emptied = (F.col("n_deleted_lines") > 0) & ~F.col(names["text"]).rlike(r"\S")
    chars = F.coalesce(F.length(names["text"]), F.lit(0)).cast("long")
    kept = out.where(~F.coalesce(emptied, F.lit(False)))
    return kept.select(*[(chars if c == "n_chars" else F.col(names[c])).alias(c) for c in docs.columns])


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near duplicates."""
    importable(spark)
    return simhash.without_near_duplicates(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove documents that contain a benchmark item, also with other values."""
    importable(spark)
    return decontaminate.without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers) and round_trip, whether the decoded ids are the text."""
    importable(spark)
    path, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    wanted = docs.select("doc_id", "text", F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("_wanted"))
    both = byte_bpe.round_trip(wanted, path, pattern, keep=["doc_id", "_wanted"], release=True, remembered=REMEMBERED)
    return both.select("doc_id", "n_tokens", "ids", (F.sha2("decoded", 256) == F.col("_wanted")).alias("round_trip"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", remove_repeated_lines),
    ("simhash_near_dedup", remove_near_duplicates),
    ("benchmark_decontamination", remove_benchmark),
    ("byte_level_bpe", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every stage's result is stored as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs


#: SQL can express neither suffix arrays nor SimHash groups nor BPE; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None
