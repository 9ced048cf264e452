import pytest
from pyspark.sql import functions as F

from reviewgrain.operators import enrichment, scaling


@pytest.fixture
def skewed(spark):
    """A third of the rows on one key, a sixth without a key."""
    rows = [(i, "hot" if i % 3 == 0 else None if i % 6 == 1 else f"k{i % 50}") for i in range(600)]
    return spark.createDataFrame(rows, "row_id long, k string")


@pytest.fixture
def lookup(spark):
    return spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("unused", 4)], "k string, v int")


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(skewed, lookup, how):
    plain = sorted(map(repr, skewed.join(lookup, "k", how).select(*sorted(skewed.join(lookup, "k", how).columns)).collect()))
    salted = scaling.salted_join(skewed, lookup, ["k"], "row_id", how, salts=4)
    assert sorted(map(repr, salted.select(*sorted(salted.columns)).collect())) == plain


def test_session_without_adaptive_skew_joins_is_salted(spark, skewed, lookup):
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        joined = scaling.spread_join(skewed, lookup, ["k"], "row_id")
        assert "_salt" in joined._jdf.queryExecution().toString()
        assert joined.where("v = 1").count() == 200
    finally:
        spark.conf.unset("spark.sql.adaptive.skewJoin.enabled")


def test_attach_does_not_broadcast_beyond_the_limit(skewed, lookup):
    small = scaling.attach(skewed, lookup, ["k"], "row_id", max_rows=10)
    large = scaling.attach(skewed, lookup, ["k"], "row_id", max_rows=2)
    assert "Broadcast" in small._jdf.queryExecution().toString()
    assert "_salt" in large._jdf.queryExecution().analyzed().toString()
    assert not scaling.is_small(lookup, max_bytes=10) and scaling.is_small(lookup)
    assert sorted(map(repr, small.collect())) == sorted(map(repr, large.collect()))


def test_hot_keys_are_bounded(skewed):
    counts = skewed.groupBy("k").agg(F.count(F.lit(1)).alias("_rows"))
    hot = scaling.hot_keys(counts, ["k"], "_rows", 3).collect()
    assert len(hot) == 3 and hot[0]["k"] == "hot" and all(r["k"] is not None for r in hot)


def test_ordinals_are_dense_and_repeatable(spark):
    rows = spark.range(1000).withColumn("key", F.concat(F.lit("t"), F.col("id").cast("string")))
    first = {r["key"]: r["ordinal"] for r in scaling.dense_ordinal(rows, "key").collect()}
    again = {r["key"]: r["ordinal"] for r in scaling.dense_ordinal(rows.repartition(7), "key").collect()}
    assert sorted(first.values()) == list(range(1000)) and first == again


def test_top_rows_of_a_hot_group_are_limited_in_the_map_tasks(skewed):
    top = scaling.first_per_group(skewed, ["k"], ["row_id"], 2)
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    assert top.where("k = 'hot'").count() == 2


def test_row_ids_stay_when_read_again(spark):
    rows = scaling.with_row_id(spark.range(50).repartition(3))
    assert sorted(rows.collect()) == sorted(rows.collect())
    assert rows.select("row_id").distinct().count() == 50


def test_urls_that_are_missing_are_kept(spark):
    rows = spark.createDataFrame([(0, "a"), (1, None), (2, "b")], "row_id long, pageurl string")
    bad = spark.createDataFrame([("a",)], "pageurl string")
    assert sorted(r[0] for r in enrichment.drop_invalid_urls(rows, bad).select("row_id").collect()) == [1, 2]


def test_fill_record_ignores_blank_values(spark):
    rows = spark.createDataFrame([(0, "u", "old", None), (1, "u", "", "n")], "row_id long, url string, title string, name string")
    side = spark.createDataFrame([("u", "new", "")], "url string, title string, name string")
    kept = enrichment.fill_record(rows, side, "url", ["title", "name"]).orderBy("row_id").collect()
    assert [(r["title"], r["name"]) for r in kept] == [("old", None), ("new", "n")]
    over = enrichment.fill_record(rows, side, "url", ["title", "name"], overwrite=True).orderBy("row_id").collect()
    assert [(r["title"], r["name"]) for r in over] == [("new", None), ("new", "n")]


def test_inferred_values_replace_placeholders_only(spark):
    rows = spark.createDataFrame(
        [(0, "a", "Unknown Product", 0.0), (1, "b", "Kept", 3.0), (2, "c", None, None)],
        "row_id long, uniq_id string, title string, rating double",
    )
    inferred = spark.createDataFrame([("a", "T", 4), ("b", "X", 1), ("c", "", 0)], "uniq_id string, title string, rating int")
    out = enrichment.apply_inferred(rows, inferred).orderBy("row_id").collect()
    assert [(r["title"], r["rating"]) for r in out] == [("T", 4.0), ("Kept", 3.0), (None, None)]
