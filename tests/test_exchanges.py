from pyspark.sql import functions as F

from reviewgrain.operators import exchanges, pages, retrieval
from reviewgrain.functions.numeric import grade
from reviewgrain.operators.clusters import overall_score


def test_category_answers_by_place(spark):
    rows = spark.createDataFrame([(0, 3, "1. [A]\n2) B\nnoise"), (1, 1, "1. A\n2. B"), (2, 1, None)], "batch_id long, expected long, response string")
    out = exchanges.parse_categories(rows).orderBy("batch_id", "item").collect()
    assert [(r["batch_id"], r["category"]) for r in out] == [
        (0, "A"), (0, "B"), (0, "Unknown"), (1, "A"), (2, "Unknown"),
    ]


def test_last_aspect_line_wins(spark):
    rows = spark.createDataFrame([(1, "Quality: Positive\n quality : negative\nfoo bar: positive\nsize: big")], "id int, response string")
    out = exchanges.parse_aspects(rows, "id").collect()
    assert [(r["aspect"], r["sentiment"]) for r in out] == [("quality", "negative")]


def test_inferred_lists_are_padded_cut_or_missing(spark):
    rows = spark.createDataFrame(
        [
            (0, 2, 'ok [{"title": "A", "rating": 5}] end'),
            (1, 1, '[{"title": "A", "rating": 5}, {"title": "B", "rating": 1}]'),
            (2, 1, "no list"),
            (3, 1, "[not json]"),
        ],
        "batch_id long, expected long, response string",
    )
    out = exchanges.parse_inferred(rows).orderBy("batch_id", "item").collect()
    assert [(r["batch_id"], r["title"], r["rating"]) for r in out] == [
        (0, "A", 5), (0, "Unknown", 3), (1, "A", 5), (2, None, None), (3, None, None),
    ]


def test_insight_lines(column_of):
    responses = ["INSIGHT: a\nACTION: b\nINSIGHT:  c ", "insight: x", None]
    assert column_of(lambda c: exchanges.parse_insight(F.col(c))[0], responses) == ["c", "", ""]
    assert column_of(lambda c: exchanges.parse_insight(F.col(c))[1], responses) == ["b", "", ""]


def test_batches_have_the_asked_size(spark):
    titles = spark.range(45).select(F.concat(F.lit("t"), F.col("id").cast("string")).alias("title"))
    sizes = [r["expected"] for r in exchanges.category_prompts(titles, 20).orderBy("batch_id").collect()]
    assert sizes == [20, 20, 5]


def test_page_elements_by_class(spark):
    html = (
        '<p class="mb0 other">no</p><h1 class="f6 normal dark-gray mb0 lh-title lh-copy-m f3-m">A <b>B</b>&amp;C</h1>'
        '<div class="w-30x">9</div><div class="x w-30">4.5 out of 5</div>'
    )
    rows = spark.createDataFrame([("u", html), ("v", "<p>none</p>"), ("w", None)], "url string, html string")
    out = {r["url"]: r for r in pages.extract_pages(rows).collect()}
    assert out["u"]["title"] == "A B&C" and out["u"]["rating"] == 4.5 and out["u"]["success"]
    assert not out["v"]["success"] and out["v"]["error"] and not out["w"]["success"]


def test_elements_end_at_their_own_end_tag(spark):
    html = [
        '<div class="a w-30">x <div>y <div>z</div></div> <b>4</b></div> 9',
        '<div class="w-30">x <div>y',
        '<p class="w-30"></p><p class="w-30">5</p>',
        "<p class='w-30 x'>" + "<i>a</i> " * 20000 + "7</p>",
    ]
    rows = spark.createDataFrame(list(enumerate(html)), "url int, html string")
    out = {r["url"]: r for r in pages.extract_pages(rows, ["w-30"], ["w-30"]).collect()}
    assert out[0]["title"] == "x y z 4" and out[0]["rating"] == 4
    assert out[1]["title"] in (None, "x y") and out[2]["rating"] is None and out[3]["rating"] == 7


def test_elements_of_any_depth(spark):
    html = [
        "<div><div class='w-30'>" + "<div>a " * 50 + "</div>" * 50 + " 3</div> 8</div>",
        "<DIV class='w-30'>" + "<div>b " * 50 + "</DIV >" * 49 + " 6",  # unclosed: all of the page
        "<my-box class='w-30'><my>1</my><my-box-x>c</my-box-x></my-box>9",
        "<div class='w-30'></div></div>2",
        "<div class='w-3'>1</div>",
        None,
    ]
    rows = spark.createDataFrame(list(enumerate(html)), "url int, html string")
    inside = pages.inner_text(pages.element_with_classes(F.col("html"), ["w-30"]))
    out = {r["url"]: r["t"] for r in rows.select("url", inside.alias("t")).collect()}
    assert out[0] == "a " * 50 + " 3" and out[1] == "b " * 50 + " 6"
    assert out[2] == "1c" and out[3] == "" and out[4] is None and out[5] is None


def test_overall_score(spark):
    row = spark.sql("SELECT 0.0D AS s, 0.5D AS c, cast(null AS double) AS v")
    score = overall_score(F.col("s"), F.col("c"), F.col("v"))
    out = row.select(score.alias("x"), grade(score).alias("g")).first()
    assert abs(out["x"] - (0.5 + 0.5 + 0) / 3) < 1e-12 and out["g"] == "D"


def test_no_hits_is_no_success(spark):
    hits = spark.createDataFrame(
        [],
        "doc_id string, category string, aspect_name string, summary string, review_count long, similarity double, "
        "sentiment struct<overall: string, positive_pct: double, negative_pct: double>",
    )
    out = retrieval.retrieved_context(hits, "q").first()
    assert not out["success"] and out["n_results"] == 0 and out["response"] is None


def test_fallback_takes_the_nearest(spark):
    rows = spark.createDataFrame([(i, i / 100) for i in range(40)], "row_id int, similarity double")
    assert retrieval.relevant_rows(rows, 0.3).count() == 10
    nearest = retrieval.relevant_rows(rows, 0.9, fallback=3).collect()
    assert sorted(r["row_id"] for r in nearest) == [37, 38, 39]
