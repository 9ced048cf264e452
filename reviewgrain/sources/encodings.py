"""Text vectors: stored ones, hashed ones, or those of a caller's encoder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, PCA, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewgrain.functions import vectors

Encoder = Callable[[pd.Series], pd.Series]


def join_stored(df: DataFrame, stored: DataFrame, key: str, vector: str = "embedding") -> DataFrame:
    """Rows with the vector stored under the same unique key."""
    return df.join(stored.select(key, vector), key)


def hashed_model(df: DataFrame, text: str = "review", size: int = 256) -> PipelineModel:
    """Token hashing with inverse document frequencies and unit length.

    These vectors compare words, not meanings; pass an encoder for the latter.
    """
    stages = [
        RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=r"\W+"),
        HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=size),
        IDF(inputCol="_tf", outputCol="_idf"),
        Normalizer(inputCol="_idf", outputCol="_unit"),
    ]
    return Pipeline(stages=stages).fit(df.where(F.col(text).isNotNull()))


def encode_hashed(
    model: PipelineModel, df: DataFrame, text: str = "review", name: str = "embedding"
) -> DataFrame:
    source = model.stages[0].getInputCol()
    renamed = df.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    ready = renamed.drop(source).withColumnRenamed("_text", source)
    vector = vector_to_array("_unit", "float32").alias(name)
    encoded = model.transform(ready)
    kept = [F.col(c) for c in df.columns if c != source]
    original = [F.col(source)] if source in df.columns else []
    return encoded.select(*kept, *original, vector)


def encode_with(df: DataFrame, encoder: Encoder, text: str = "review", name: str = "embedding") -> DataFrame:
    """Vectors from a caller's model, one Arrow batch at a time inside the tasks."""
    schema = ", ".join(f"`{c}` {kind}" for c, kind in df.dtypes) + f", `{name}` array<float>"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(**{name: encoder(frame[text])})

    return df.mapInPandas(run, schema)


def text_key(text: str) -> F.Column:
    return F.sha2(F.col(text), 256)


def texts_to_encode(df: DataFrame, cache: DataFrame, model: str, text: str = "review") -> DataFrame:
    """(text_key, text) of the distinct texts that the cache of this model lacks.

    The cache is keyed (model, sha2 of the text), so equal texts are encoded once.
    """
    keyed = df.where(F.col(text).isNotNull()).select(text_key(text).alias("text_key"), F.col(text).alias("text"))
    distinct = keyed.groupBy("text_key").agg(F.min("text").alias("text"))
    known = cache.where(F.col("model") == model).select("text_key")
    return distinct.join(known, "text_key", "left_anti")


def with_cached(
    df: DataFrame, cache: DataFrame, model: str, text: str = "review", row_id: str = "row_id"
) -> DataFrame:
    """Rows with the cached vector of their text; much repeated texts are salted."""
    from reviewgrain.operators.scaling import spread_join

    keyed = df.withColumn("text_key", text_key(text))
    known = cache.where(F.col("model") == model).select("text_key", "embedding")
    return spread_join(keyed, known, ["text_key"], row_id).drop("text_key")


def reduce_dimensions(df: DataFrame, k: int, vector: str = "embedding", name: str = "reduced") -> DataFrame:
    """Principal components of the vectors; the projection is not centered."""
    ready = df.withColumn("_v", array_to_vector(vectors.doubles(F.col(vector))))
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(ready)
    return model.transform(ready).withColumn(name, vector_to_array("_p")).drop("_v", "_p")


def components(rows: int, dimensions: int, wanted: int = 10) -> int:
    """How many components a table of this shape allows."""
    return max(1, min(wanted, rows - 1, dimensions))
