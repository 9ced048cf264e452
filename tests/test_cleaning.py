import datetime as dt
import math
import statistics

import pytest
from pyspark.sql import functions as F

from reviewgrain import lexicons as lx
from reviewgrain.functions import dates, numeric, text
from reviewgrain.operators import cleaning, profiling
from reviewgrain.plans import preparation


def test_types(sample):
    kinds = dict(cleaning.coerce_types(sample).dtypes)
    assert kinds["rating"] == "double"
    assert kinds["review_date"] == "timestamp_ntz"


def test_derived_columns_exist(sample):
    out = cleaning.add_derived(cleaning.coerce_types(sample))
    assert {"product_id", "total_votes", "review_length"} <= set(out.columns)


def test_title_comes_from_the_same_url(sample):
    out = cleaning.merge_by_url(sample).where("row_id = 2").first()
    assert out["title"] == "Garden chair"


def test_missing_info_shape(sample):
    out = profiling.missing_info(sample)
    assert {"column", "missing_count"} <= set(out.columns)
    assert {r["column"]: r["missing_count"] for r in out.collect()}["title"] == 1


def test_clean_text_keeps_blanks_left_by_tags(column_of):
    rule = lambda c: text.clean_text(F.col(c))
    assert column_of(rule, [" a <b> c ", "x \n y", None, "<i></i>"]) == ["a  c", "x y", None, ""]


def test_null_tokens_are_exact(column_of):
    rule = lambda c: text.null_tokens(F.col(c))
    assert column_of(rule, ["", "nan", "None", "none", "NaN", "x"]) == [None, None, None, "none", "NaN", "x"]


def test_numbers(column_of):
    assert column_of(lambda c: numeric.to_double(F.col(c)), ["1", "x", "NaN", None]) == [1.0, None, None, None]
    assert column_of(lambda c: numeric.star_count(F.col(c)), [2.5, 3.5, -1.0], "double") == [2, 4, 0]
    assert column_of(lambda c: numeric.clip_rating(F.col(c)), [0.0, 7.0, None], "double") == [1.0, 5.0, None]
    assert column_of(lambda c: numeric.round_to(F.col(c), 2), [2.125, 2.135, 1.005], "double") == [2.12, 2.13, 1.0]


def test_standard_spellings(column_of):
    verified = lambda c: text.standardise(F.col(c), lx.VERIFIED_MAP)
    recommended = lambda c: text.standardise(F.col(c), lx.RECOMMENDED_MAP)
    assert column_of(verified, ["1", "Y", None, "FALSE"]) == ["Yes", "Y", "Unknown", "No"]
    assert column_of(recommended, ["TRUE", "1", "true", None]) == ["TRUE", "1", "Yes", "Unknown"]


def test_website(column_of):
    assert column_of(lambda c: text.strip_lower(F.col(c)), ["\t Shop.COM \n", "a b"]) == ["shop.com", "a b"]


def test_dates(column_of):
    leap = dt.datetime(2020, 2, 29, 13)
    assert column_of(lambda c: dates.shift_years(F.col(c), 10), [leap], "timestamp_ntz") == [dt.datetime(2010, 2, 28, 13)]
    edge = [dt.datetime(2015, 12, 31), dt.datetime(2015, 12, 31, 0, 1), dt.datetime(1990, 1, 1), None]
    kept = column_of(lambda c: dates.within(F.col(c)), edge, "timestamp_ntz")
    assert kept == [edge[0], None, edge[2], None]
    parsed = column_of(lambda c: dates.to_ntz(F.col(c)), ["2020-04-15", "bad", "04/15/2020", "2020-04-15 01:02:03 +0000"])
    assert parsed == [dt.datetime(2020, 4, 15), None, dt.datetime(2020, 4, 15), dt.datetime(2020, 4, 15, 1, 2, 3)]


def test_zero_years_is_no_shift(spark):
    rows = spark.sql("SELECT timestamp_ntz '2020-01-01 00:00:00' AS review_date")
    assert cleaning.shift_dates(rows, 0).first()[0] == dt.datetime(2020, 1, 1)


def test_median_interpolates(spark):
    rows = spark.createDataFrame([(1, 1.0), (2, 4.0), (3, None)], "i int, rating double")
    assert cleaning.fill_rating_median(rows).where("i = 3").first()["rating"] == 2.5


@pytest.mark.parametrize(
    "values",
    [
        [3.0], [1.0, 4.0], [5.0] * 7 + [1.0], [float(x * 7 % 1001) for x in range(1001)], [0.5, 0.5, 2.5, 9.0],
        [-2.5, -1.0, 0.0, 3.0], [-0.0, 0.0, -0.0], [1.0, math.nextafter(1.0, 2.0), 1.0, math.nextafter(1.0, 0.0)], [7.25] * 999,
        [-1e308, -5e-324, 5e-324, 1e308, 2e-308], [2.0**-i for i in range(60)], [float("inf"), 1.0, float("-inf")],
    ],
)
def test_selected_median_is_exact(spark, values):
    rows = spark.createDataFrame([(v,) for v in values] + [(None,)], "rating double")
    got = spark.range(1).select(cleaning.exact_median(rows, "rating")).first()[0]
    assert got == statistics.median(values)


def test_median_of_nothing(spark):
    rows = spark.createDataFrame([(None,)], "rating double")
    assert cleaning.fill_rating_median(rows, many_values=True).first()["rating"] is None


def test_product_ids(column_of):
    urls = ["/ip/x/12", "/ip/34", "/p/123456789?x", "/p/12", None]
    assert column_of(lambda c: text.product_id(F.col(c)), urls) == ["12", "34", "123456789", None, None]


def test_votes(spark):
    rows = spark.createDataFrame([(0, 0.0, 0.0), (1, 10.0, 2.0), (2, None, 1.0)], "i int, review_upvotes double, review_downvotes double")
    out = cleaning.add_derived(rows).orderBy("i").collect()
    assert [r["vote_ratio"] for r in out] == [0.5, 10 / 12, 0.5]
    assert [r["helpfulness_score"] for r in out] == [0.0, 0.552, 0.0]


def test_rating_bins(column_of):
    values = [0.0, 2.0, 2.5, 3.5, 5.0, 5.1, -0.1, None]
    category = column_of(lambda c: numeric.rating_category(F.col(c)), values, "double")
    assert category == ["Low", "Low", "Medium", "Medium", "High", None, None, None]
    mood = column_of(lambda c: numeric.rating_sentiment(F.col(c)), values, "double")
    assert mood == ["Negative", "Negative", "Negative", "Neutral", "Positive", None, None, None]


def test_numbers_for_display(column_of):
    shown = column_of(lambda c: numeric.format_number(F.col(c)), [1234567.0, 1234.0, 5.0, 2e9, None], "double")
    assert shown == ["1.23M", "1.23K", "5.00", "2000.00M", None]


def test_lengths(column_of):
    values = ["a  b", "", None, "é ü"]
    assert column_of(lambda c: text.text_length(F.col(c)), values) == [4, 0, 0, 3]
    assert column_of(lambda c: text.word_count(F.col(c)), values) == [2, 0, 0, 2]


def _copies(spark):
    rows = [
        (0, "1", "u", "r", "t"),
        (1, "1", "u", "r", "t"),  # exact copy of 0
        (2, "2", "u", "r", "t"),  # same review as 0
        (3, "1", "v", "r", "t"),  # same uniq_id as 0
        (4, None, "w", None, None),
        (5, None, "x", None, None),  # NULL uniq_id like 4
        (6, "6", None, None, None),
        (7, "7", None, None, None),  # same (NULL) review keys as 6
    ]
    return spark.createDataFrame(rows, "row_id long, uniq_id string, pageurl string, reviewer_name string, review string")


def test_duplicates(spark):
    kept = cleaning.drop_duplicates(_copies(spark))
    assert sorted(r["row_id"] for r in kept.collect()) == [0, 4, 6]
    counts = {r["strategy"]: r["removed"] for r in cleaning.duplicate_counts(_copies(spark)).collect()}
    assert counts == {"exact": 1, "same_review": 2, "uniq_id": 2, "total": 5}


def test_duplicate_counts_of_nothing(spark):
    counts = cleaning.duplicate_counts(_copies(spark).where("false")).collect()
    assert {(r["removed"], r["removed_pct"]) for r in counts} == {(0, 0.0)}


def test_duplicates_without_review_keys(spark):
    rows = spark.createDataFrame([(0, "a"), (1, "a"), (2, None), (3, None)], "row_id long, review string")
    assert sorted(r[0] for r in cleaning.drop_duplicates(rows).select("row_id").collect()) == [0, 2]


def test_steps_skip_absent_columns(spark):
    rows = spark.createDataFrame([(0, "x")], "row_id long, other string")
    assert preparation.preprocess(rows).columns == ["row_id", "other"]


def test_preprocess_runs_the_dimensions_in_order(sample):
    out = preparation.preprocess(sample).orderBy("row_id").collect()
    assert [r["title"] for r in out] == ["Garden chair", "Desk lamp", "Garden chair"]
    assert out[0]["review_date"] == dt.datetime(2011, 1, 31)
    assert out[2]["review_upvotes"] == 0.0


def test_column_info_counts_distinct_values(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (2, None)], "n int, s string")
    info = {r["column"]: r for r in profiling.column_info(rows).collect()}
    assert info["n"]["unique_count"] == 2 and info["s"]["unique_count"] == 1
    assert info["s"]["null_percent"] == 33.33
