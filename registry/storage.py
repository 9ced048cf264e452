"""Reading, writing, staging and caching; files go below the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import (
    CTE_REVIEWS,
    CTE_SCORED,
    query,
    raw_reviews,
    reviews,
    scored,
    sql_stamp,
    stamp,
    table,
)
from registry.exchanges import CTE_DOCUMENTS, aspect_documents
from registry.plans import CTE_PREPROCESSED
from reviewgrain.operators import cleaning, topics
from reviewgrain.operators.scaling import scratch_path, store
from reviewgrain.plans import preparation
from reviewgrain.sources import aspect_store, csv_records, encodings, files, stages

_PLAIN = ["uniq_id", "pageurl", "title", "rating", "review", "reviewer_name", "review_upvotes", "website"]


@query("io1_read_csv", f"{CTE_REVIEWS} SELECT row_id::VARCHAR AS row_id, {', '.join(_PLAIN[:3])}, rating, md5(review) AS review FROM reviews")
def read_csv(spark, sf):
    """A review file with odd header names, quotes and line breaks, read back."""
    path = scratch_path(spark, "reviews_csv")
    rows = reviews(spark, sf).select("row_id", *_PLAIN).withColumnRenamed("uniq_id", "uniq _id")
    files.save(rows, path, "csv")
    back = files.read_csv(spark, path)
    return cleaning.coerce_types(back).select("row_id", *_PLAIN[:3], "rating", F.md5("review").alias("review"))


@query("io1_one_large_file", f"{CTE_REVIEWS} SELECT row_id::VARCHAR AS row_id, {', '.join(_PLAIN[:3])}, rating, md5(review) AS review, true AS from_many_tasks FROM reviews")
def one_large_file(spark, sf):
    """A single review file with line breaks inside reviews, cut into as many ranges as fit its size."""
    path = scratch_path(spark, "one_csv")
    files.save_one_csv(reviews(spark, sf).select("row_id", *_PLAIN), path)
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, 256_000)
    try:
        rows = csv_records.records(spark, path, store)  # the plan keeps the ranges it was made with
        tasks = F.lit(rows.rdd.getNumPartitions() > 1)
        back = cleaning.coerce_types(files.read_csv(spark, path))
        return store(back.select("row_id", *_PLAIN[:3], "rating", F.md5("review").alias("review"), tasks.alias("from_many_tasks")))
    finally:
        spark.conf.set(size, before)


@query("io2_review_source", f"{CTE_REVIEWS} SELECT count(*) AS rows, count(DISTINCT pageurl) AS urls FROM reviews")
def review_source(spark, sf):
    path = scratch_path(spark, "landed")
    files.save(reviews(spark, sf).select("row_id", *_PLAIN), path, "csv")
    source = files.ReviewSource(spark, path)
    source.load()
    return source.load().agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("pageurl").alias("urls"))


@query("io3_save_parquet", f"{CTE_REVIEWS} SELECT row_id, uniq_id, rating, {sql_stamp('review_date')} AS review_date FROM reviews")
def save_parquet(spark, sf):
    path = scratch_path(spark, "reviews")
    files.save(raw_reviews(spark, sf), path)
    return spark.read.parquet(path).select("row_id", "uniq_id", "rating", stamp("review_date"))


def _stages(spark):
    return stages.StageStore(spark, scratch_path(spark, "stages"))


@query(
    "io4_stage_hand_off",
    f"{CTE_PREPROCESSED} SELECT rating_sentiment, count(*) AS reviews FROM processed GROUP BY 1",
)
def stage_hand_off(spark, sf):
    """Load and preprocess as stored stages, then resume from the last one."""
    stored = _stages(spark)
    steps = {
        "load": lambda _: raw_reviews(spark, sf),
        "preprocess": preparation.preprocess,
        "categorise": preparation.categorise,
        "report": lambda rows: rows.groupBy("rating_sentiment").agg(F.count(F.lit(1)).alias("reviews")),
    }
    stored.run(steps, only="load")
    stored.run(steps, only="preprocess")
    return stored.run(steps, start_from="impute")


@query("io5_best_available", f"{CTE_SCORED} SELECT row_id, sentiment FROM scored")
def best_available(spark, sf):
    """The analysed table wins over the preprocessed one."""
    stored = _stages(spark)
    files.save(raw_reviews(spark, sf), stored.path("preprocess"))
    files.save(scored(spark, sf), stored.path("analyse"))
    return stored.best_available().select("row_id", "sentiment")


@query(
    "io6_aspect_store",
    f"{CTE_DOCUMENTS} SELECT doc_id, category, summary, review_count, len(v)::INTEGER AS dimensions FROM aspect_documents",
)
def stored_documents(spark, sf):
    store = aspect_store.AspectStore(spark, scratch_path(spark, "aspect_store"))
    store.save(aspect_documents(spark, sf))
    return store.load().select("doc_id", "category", "summary", "review_count", F.size("embedding").alias("dimensions"))


@query(
    "io6_without_vectors",
    f"{CTE_DOCUMENTS} SELECT doc_id, category, aspect_name, summary, review_count FROM aspect_documents",
)
def without_vectors(spark, sf):
    return aspect_store.without_vectors(aspect_documents(spark, sf)).drop("sentiment")


@query("io7_topic_model")
def topic_model(spark, sf):
    """A saved and reloaded model gives the assignments of the original."""
    points = table(spark, sf, "embeddings").select(F.col("vec_id").alias("row_id"), "embedding")
    path = scratch_path(spark, "topic_model")
    topics.save_model(topics.fit_topics(points, 6), path)
    return topics.assign_topics(topics.load_model(spark, path), points, min_size=10).select("row_id", "topic_id")


def _cache(spark, sf):
    """Vectors of the labelled documents under model a, and of others under model b."""
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    model = F.when(F.col("quality") == 1, "a").otherwise("b")
    keyed = docs.groupBy(model.alias("model"), F.sha2("text", 256).alias("text_key"))
    return keyed.agg(F.array(F.avg("quality"), F.avg("toxic")).alias("embedding"))


@query(
    "io8_texts_to_encode",
    """SELECT sha256(text) AS text_key, md5(text) AS digest FROM (SELECT DISTINCT text FROM documents) WHERE text NOT IN
 (SELECT d.text FROM documents d JOIN labels l USING (doc_id) WHERE l.quality = 1)""",
)
def texts_to_encode(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("review"))
    todo = encodings.texts_to_encode(docs, _cache(spark, sf), "a")
    return todo.select("text_key", F.md5("text").alias("digest"))


@query(
    "io8_cached_vectors",
    """SELECT doc_id, text IN (SELECT d.text FROM documents d JOIN labels l USING (doc_id) WHERE l.quality = 1) AS cached FROM documents""",
)
def cached_vectors(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("review"))
    rows = encodings.with_cached(docs, _cache(spark, sf), "a", row_id="doc_id")
    return rows.select("doc_id", F.col("embedding").isNotNull().alias("cached"))


# --- stores ------------------------------------------------------------------------
@query(
    "ag18_store_stats",
    f"""{CTE_DOCUMENTS} SELECT 'ready' AS status, count(*) AS n_documents, count(DISTINCT category) AS n_categories,
 max(len(v)) AS embedding_dim, '2020-01-01 00:00:00' AS last_updated FROM aspect_documents""",
)
def store_stats(spark, sf):
    created = F.lit("2020-01-01 00:00:00").cast("timestamp_ntz").alias("created_at")
    docs = aspect_documents(spark, sf).select("*", created)
    return aspect_store.stats(docs).withColumn("last_updated", stamp("last_updated"))


@query("ag18_store_categories", f"{CTE_DOCUMENTS} SELECT DISTINCT category FROM aspect_documents")
def store_categories(spark, sf):
    return aspect_store.categories(aspect_documents(spark, sf))


@query("so3_missing_vectors", f"{CTE_DOCUMENTS} SELECT doc_id, 64 AS dimensions FROM aspect_documents")
def missing_vectors(spark, sf):
    """Documents without a vector get one from their text; the others keep theirs."""
    docs = aspect_documents(spark, sf)
    model = encodings.hashed_model(docs, "summary", 64)
    some = F.when(F.col("review_count") > 3, F.col("embedding"))
    filled = aspect_store.with_missing_vectors(
        docs.withColumn("embedding", some), lambda rows: encodings.encode_hashed(model, rows, "text")
    )
    return filled.select("doc_id", F.size("embedding").alias("dimensions"))


@query("so3_clear_store", f"{CTE_REVIEWS} SELECT 0::BIGINT AS left_over, (SELECT count(*) FROM reviews) AS reviews")
def clear_store(spark, sf):
    store = aspect_store.AspectStore(spark, scratch_path(spark, "aspect_store"))
    store.save(aspect_documents(spark, sf))
    store.clear()
    left = store.load().agg(F.count(F.lit(1)).alias("n")).scalar()
    return reviews(spark, sf).agg(left.alias("left_over"), F.count(F.lit(1)).alias("reviews"))


@query(
    "so3_update_store",
    f"""{CTE_DOCUMENTS} SELECT doc_id, category, review_count FROM aspect_documents
UNION ALL SELECT doc_id || '_again', category, review_count FROM aspect_documents""",
)
def update_store(spark, sf):
    """Load, add and save over the stored rows, then load again."""
    store = aspect_store.AspectStore(spark, scratch_path(spark, "aspect_store"))
    documents = aspect_documents(spark, sf)
    store.save(documents)
    again = documents.withColumn("doc_id", F.concat("doc_id", F.lit("_again")))
    store.save(aspect_store.add_documents(store.load(), again))
    return store.load().select("doc_id", "category", "review_count")


@query(
    "so3_upsert",
    f"""{CTE_DOCUMENTS} SELECT 1 AS version, doc_id, review_count FROM aspect_documents
UNION ALL SELECT 4, doc_id, CASE WHEN review_count % 2 = 0 THEN review_count * 10 ELSE review_count END FROM aspect_documents WHERE review_count % 3 <> 0
UNION ALL SELECT 4, doc_id || '_new', review_count FROM aspect_documents WHERE review_count % 2 = 0""",
)
def upsert_documents(spark, sf):
    """Changed and new documents are upserted, others deleted; both the first version and the last are read."""
    store = aspect_store.AspectStore(spark, scratch_path(spark, "aspect_store"))
    documents = aspect_documents(spark, sf)
    first = store.save(documents)
    even = documents.where("review_count % 2 = 0")
    changed = even.withColumn("review_count", F.col("review_count") * 10)
    new = even.withColumn("doc_id", F.concat("doc_id", F.lit("_new")))
    for _ in range(2):  # the second time nothing is done
        store.upsert(changed.unionByName(new), token="nightly")
    store.table.delete(documents.where("review_count % 3 = 0").select("doc_id"))
    last = store.table.compact()
    read = lambda v: store.load(v).select(F.lit(v).alias("version"), "doc_id", "review_count")
    return read(first).unionByName(read(last))
