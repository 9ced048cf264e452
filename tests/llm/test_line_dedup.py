import random

import pytest

from reviewgrain.llm import line_dedup
from reviewgrain.llm.queries import QUERIES
from tests.llm import brute


@pytest.mark.parametrize("seed", range(4))
def test_against_all_pairs_of_lines(spark, seed):
    rng = random.Random(seed)
    common = ["a b c", "d", "e f", "g h i j", "", "k l", " m n o "]
    rows = [
        (i, "\n".join(rng.choice(common) if rng.random() < 0.8 else f"u{i} x{j}" for j in range(rng.randint(1, 14))))
        for i in range(rng.choice([6, 20]))
    ]
    out = line_dedup.without_later_copies(spark.createDataFrame(rows, "doc_id long, text string"), min_words=4).collect()
    assert {r.doc_id: r.text for r in out} == brute.without_later_runs(rows, 4)
    assert all(r.n_lines == dict(rows)[r.doc_id].count("\n") + 1 for r in out)


def test_odd_rows(odd):
    out = line_dedup.without_later_copies(odd)
    rows = out.collect()
    assert set(odd.columns) <= set(out.columns) and len(rows) == odd.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert [r.text for r in by[3]] == ["", ""] and {r.n_lines for r in by[1]} == {1}  # the NULL id comes first and keeps its line
    assert by[4][0].n_deleted_lines > 4900 and by[5][0].n_deleted_lines == 0
    assert [r.n_lines for r in by[None] if r.text is None] == [0]
    assert line_dedup.without_later_copies(odd.limit(0)).count() == 0


def test_query(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    out = QUERIES["op3_line_dedup"](spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: r.text for r in out} == brute.without_later_runs(rows, line_dedup.MIN_WORDS)
