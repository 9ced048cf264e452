import re

import pytest

from reviewgrain.llm import decontaminate
from reviewgrain.llm.queries import QUERIES

ITEM = "Tom has 3 apples and buys 5 apples at the market for 2 dollars, then gives 3 apples to Mary. How many apples are left?"
ITEMS = [(7, ITEM), (8, None), (9, ""), (10, "Yes"), (11, "one two three four five six"), (12, ITEM)]


def found(spark, texts):
    items = spark.createDataFrame([(*i, 0) for i in ITEMS], "item_id long, text string, doc_id int")
    docs = spark.createDataFrame([(i, t, "k", 0) for i, t in enumerate(texts)], "doc_id long, text string, key string, item_id int")
    return sorted({(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()})


def test_other_values_are_found_if_they_are_consistent(spark):
    texts = [
        ITEM,
        "Before. " + ITEM.replace("3", "41").replace("5", "6").replace("Mary", "Sue") + " After that.",
        ITEM.replace("has 3", "has 4").replace("gives 3", "gives 9"),
        ITEM.replace("buys 5", "buys 3"),
        "Something else about 3 apples and 5 pears at the market for 2 dollars.",
        None, "", "yes", "oh yes", "one two three four five six", "It goes one two three four five six and on and on for long.",
    ]
    # 2: one value of the item stands for two; 3: two values of the item stand for one
    assert found(spark, texts) == [(0, 7), (1, 7), (7, 10), (9, 11), (10, 11)]


def reported(spark, item, texts):
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id for r in decontaminate.contaminated(docs, items).collect()}


def test_conflicting_values_leave_the_rest(spark):
    words = "when the old baker opened his small shop near the river people came from far away to taste warm bread with salted butter"
    plain = words + " and he sold 3 loaves to one man while 5 others waited"
    # the values coincide, or one stands for two; the words around them are the item's
    assert reported(spark, plain, [plain.replace("5", "3"), plain.replace("3", "8").replace("5", "8"), "he sold 3 loaves to one man while 3 others waited"]) == {0, 1}
    often = " ".join(f"{w} {7 if i % 2 else 4}" if i % 5 == 0 else w for i, w in enumerate((words + " " + words[::-1]).split()))
    assert reported(spark, often, [often.replace("4", "9", 1), often[::-1].replace("7", "4")]) == {0}


def test_case_and_line_breaks_do_not_hide_an_item(spark):
    item = "In which year did Marie Curie win the Nobel Prize in Physics"
    wrapped = item.replace(" Marie", "\nMarie").replace(" Nobel", "  Nobel").replace(" Physics", "\r\n\tPhysics")
    other = wrapped.replace("Marie", "Petra").replace("Curie", "Kelly")
    assert reported(spark, item, [item.lower(), item.upper(), item.title(), wrapped, other, "In which year did Petra Kelly leave"]) == {0, 1, 2, 3, 4}
    assert reported(spark, item.lower(), [item, item.upper()]) == {0, 1}


def test_odd_rows(spark, odd):
    items = spark.createDataFrame([(1, "the and of the and of the and of the and"), (None, None)], "item_id long, text string")
    assert {r.doc_id for r in decontaminate.contaminated(odd, items).collect()} == {3, None}
    left = decontaminate.without_benchmark(odd, items)
    assert left.columns == odd.columns and left.count() == odd.count() - 3
    assert decontaminate.without_benchmark(odd.limit(0), items).count() == 0
    assert decontaminate.without_benchmark(odd, items.limit(0)).count() == odd.count()


@pytest.mark.parametrize("size", [5, 6, 7, 8])
def test_windows_of_all_sizes(spark, size):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    rows = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[2 : 2 + size]))], "id int, _text string")
    made = decontaminate.windows(decontaminate.prepared(rows, [size, decontaminate.WINDOW]), ["id"], [size]).collect()
    keys = {(r.id, r.at): r.key for r in made if r.size == size}
    assert len({k for i, k in keys.items() if i[0] == 1}) == len(words) - size + 1 and keys[1, 2] == keys[2, 0]


def test_query_finds_whole_items(spark, documents):
    folder = "/root/testdata/sf0.001"
    pairs = {(r.doc_id, r.item_id) for r in QUERIES["op2_benchmark_decontamination"](spark, folder).collect()}
    words = lambda text: re.findall(r"\w+", (text or "").lower())
    items = {r.item_id: words(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    docs = {r.doc_id: words(r.text) for r in documents.collect()}
    holds = lambda doc, item: any(doc[i : i + len(item)] == item for i in range(len(doc) - len(item) + 1))
    whole = {(d, i) for d, doc in docs.items() for i, item in items.items() if item and holds(doc, item)}
    shared = {(d, i) for d, doc in docs.items() for i, item in items.items() if set(zip(*(doc[k:] for k in range(8)))) & set(zip(*(item[k:] for k in range(8))))}
    assert whole <= pairs <= shared and pairs


def test_number_heavy_and_brief_items_inside_texts(spark):
    around = "He looked at the board and read it. {} Then he went home with 7 apples and 3 pears."
    cases = {
        "What is 17 + 25 * 3 - 4?": ("What is 12 + 31 * 9 - 8?", "What is 12 and what are 5 and 6?"),
        "Convert 5 km, 7 km, 9 km and 11 km to miles.": ("Convert 2 km, 4 km, 6 km and 8 km to miles.", "Convert 2 km, 2 km, 6 km and 8 km to miles."),
        "Who wrote Hamlet?": ("who wrote hamlet", "Who wrote Macbeth?"),
    }
    for item, (same, other) in cases.items():
        assert reported(spark, item, [around.format(item), around.format(same), around.format(other), same]) == {0, 1, 3}, item


def test_pruning_changes_nothing(spark, documents, monkeypatch):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    found = lambda: sorted((r.doc_id, r.item_id, r.coverage) for r in decontaminate.contaminated(documents, benchmark).collect())
    pruned = found()
    monkeypatch.setattr(decontaminate, "PAIRS", 0)
    assert found() == pruned and pruned


def test_runs_of_known_pairs(spark):
    from pyspark.sql import functions as F

    from reviewgrain.llm import decontaminate

    words = "a b c d e f".split()
    known = decontaminate.Known(list(zip(words, words[1:], strict=False)), 5)
    texts = ["x a b c d e y", "a b c d e f", "a b c d x a b c d e", "a b", "", "x y z x y z", "a b c d e z a b c d e f"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    cut = known.islands(rows.select("i", F.array_remove(F.split("t", " "), "").alias("w")), "w")
    got = sorted((r.i, r["_first"], " ".join(r.w), r["_short"]) for r in cut.collect())
    assert got == [
        (0, 1, "a b c d e", False), (1, 0, "a b c d e f", False), (2, 5, "a b c d e", False), (3, 0, "a b", True), (6, 0, "a b c d e", False), (6, 6, "a b c d e f", False),
    ]
    assert "zip_with" not in cut._jdf.queryExecution().optimizedPlan().toString()  # no struct per border
