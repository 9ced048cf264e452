import pytest
from pyspark.sql import functions as F

from reviewgrain.functions import text
from reviewgrain.operators import aspects, categories, insights, sentiment


def test_scores_need_whole_tokens(column_of):
    rule = lambda c: text.sentiment_score(F.col(c))
    values = ["great! great bad", "great good bad", "", None, "nothing here", "BAD"]
    assert column_of(rule, values) == [0.0, 0.333, 0.0, 0.0, 0.0, -1.0]


def test_labels(column_of):
    rule = lambda c: text.sentiment_label(F.col(c))
    assert column_of(rule, [0.1, 0.11, -0.1, -0.2], "double") == ["neutral", "positive", "neutral", "negative"]


def test_categories_in_listed_order(column_of):
    rule = lambda c: text.keyword_category(F.col(c))
    expected = ["Toys & Games", "Office & School", "Other", "Other"]
    assert column_of(rule, ["Dog Toy", "Open Plain", None, ""]) == expected


def test_small_categories(spark):
    rows = [(i, "A" if i < 9 else "B") for i in range(19)] + [(19, None)]
    table = spark.createDataFrame(rows, "row_id int, product_category string")
    out = categories.consolidate(table).groupBy("product_category").count().collect()
    assert {r[0]: r[1] for r in out} == {"Other": 9, "B": 10, None: 1}


@pytest.mark.parametrize(
    "review, aspect, expected",
    [
        ("quality is great", "quality", "positive"),
        ("now the price is great", "price", "negative"),
        ("the box", "packaging", "neutral"),
        ("great " + "x" * 60 + " price", "price", "neutral"),
        ("terrible size", "size", "negative"),
        ("never terrible size", "size", "positive"),
    ],
)
def test_aspect_polarity(spark, review, aspect, expected):
    rows = spark.createDataFrame([(review,)], "review string")
    found = {r["aspect"]: r["sentiment"] for r in aspects.mentions(aspects.find_aspects(rows)).collect()}
    assert found[aspect] == expected


def test_first_listed_keyword_decides(spark):
    rows = spark.createDataFrame([("material and QUALITY",)], "review string")
    found = aspects.mentions(aspects.find_aspects(rows)).where("aspect = 'quality'").first()
    assert found["keyword"] == "quality"


def test_wide_and_long_forms_agree(spark):
    rows = spark.createDataFrame([(1, "cheap price, slow delivery"), (2, None), (3, "")], "row_id int, review string")
    found = aspects.find_aspects(rows)
    wide = {r["row_id"]: r for r in aspects.widen(found).collect()}
    long = {(r["row_id"], r["aspect"]): r["sentiment"] for r in aspects.mentions(found, ["row_id"]).collect()}
    assert wide[1]["has_price"] and wide[1]["price_sentiment"] == long[1, "price"]
    assert not wide[2]["has_price"] and wide[2]["price_sentiment"] is None
    assert {k for k, _ in long} == {1}


def test_aspect_summary_keeps_unmentioned_aspects(spark):
    rows = spark.createDataFrame([("price",), (None,)], "review string")
    out = {r["aspect"]: r for r in aspects.aspect_summary(aspects.find_aspects(rows)).collect()}
    assert len(out) == 10 and out["price"]["mention_rate"] == 50.0 and out["size"]["mentions"] == 0


def test_cluster_polarity(spark):
    rows = spark.createDataFrame([(1, "good"), (1, "good bad"), (1, "x")], "cluster int, review string")
    out = sentiment.cluster_polarity(rows, ["cluster"]).first()
    assert (out["positive_pct"], out["negative_pct"], out["neutral_pct"]) == (33.3, 0.0, 66.7)
    assert out["overall"] == "mixed_positive"


def test_independent_counts_can_pass_one_hundred(spark):
    rows = spark.createDataFrame([("good bad",)], "review string")
    out = sentiment.aspect_name_sentiment(rows).first()
    assert out["neutral_pct"] == -100.0 and out["mixed_count"] == 1


def test_cluster_names_drop_short_words_last(spark):
    rows = spark.createDataFrame([(0, 1, "the the the shoes shoes fit fit laces")], "row_id int, cluster int, review string")
    assert sentiment.cluster_names(rows, ["cluster"]).first()["aspect_name"] == "shoes"


def test_drivers_count_rows_without_review(spark):
    rows = spark.createDataFrame([("neutral", "boxes boxes"), ("neutral", None)], "sentiment string, review string")
    out = sentiment.drivers(rows, "neutral").collect()
    assert [(r["theme"], r["count"], r["percentage"]) for r in out] == [("boxes", 2, 100.0)]


@pytest.mark.parametrize(
    "ratings, expected",
    [
        ([3.0], "improving"),
        ([3.0, 3.0, 4.0], "improving"),
        ([4.0, 3.0], "declining"),
        ([3.0, 4.0, 3.0], "fluctuating"),
    ],
)
def test_trend(spark, ratings, expected):
    rows = [(f"2012-{i + 1:02d}-01", r, 0.0, "x") for i, r in enumerate(ratings)]
    table = spark.createDataFrame(rows, "d string, rating double, sentiment_score double, uniq_id string")
    out = insights.time_insights(table.withColumn("review_date", F.col("d").cast("timestamp_ntz"))).first()
    assert out["trend_direction"] == expected and out["peak_month"] == "2012-01"


def test_no_dates_no_trend(spark):
    table = spark.createDataFrame([], "review_date timestamp_ntz, rating double, sentiment_score double, uniq_id string")
    assert insights.time_insights(table).count() == 0


def test_later_assignment_wins(spark):
    rows = spark.createDataFrame([("a", "X", 0), ("a", "Y", 1)], "title string, category string, n int")
    assert categories.category_map(rows, "n").first()["category"] == "Y"
