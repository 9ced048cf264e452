import numpy as np

from reviewgrain.llm import quality
from reviewgrain.llm.queries import QUERIES
from tests.llm import brute


def test_rare_values_have_short_paths():
    rng = np.random.default_rng(1)
    usual = rng.normal(0, 1, (500, 3)) * [1, 1, 0]
    forest = quality.Forest(usual, (np.array([-3.0, -3, 0]), np.array([3.0, 3, 5])))
    odd = np.array([[0.0, 0, 4], [0, 0, 3]])
    assert forest.score(odd).min() > np.quantile(forest.score(usual), 0.99)


def test_odd_rows_and_no_labels(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = quality.judge(odd, none).collect()
    assert len(rows) == odd.count()
    assert all(r.kept != r.base_failed for r in rows) and {r.kept for r in rows if r.doc_id in (1, 2, 6)} == {False}
    assert quality.judge(odd.limit(0), none).count() == 0
    marks = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (5, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.judge(odd, marks).count() == odd.count()


def test_query(spark, documents):
    found = {r.doc_id: r for r in QUERIES["op9_quality_rules"](spark, "/root/testdata/sf0.001").collect()}
    for row in documents.collect():
        mine = found.pop(row.doc_id)
        want = brute.rule_counts(row.text)
        assert tuple(mine[n] for n in quality.STATISTICS) == want
        assert mine.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and not (mine.base_failed and mine.kept)
    assert not found
