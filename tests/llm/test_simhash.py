import numpy as np
import pytest

from reviewgrain.llm import simhash
from reviewgrain.llm.queries import QUERIES
from tests.llm import brute


def noisy(rng, n, centers, flips):
    values = rng.integers(0, 2**63, centers, dtype=np.uint64)[rng.integers(0, centers, n)]
    for _ in range(flips):
        values ^= np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
    return np.unique(values)


def parts_of(values, links):
    forest = simhash.Forest()
    for a, b in links:
        forest.adds(a, b)
    return [forest.top(i) for i in range(len(values))]


def pairs(values):
    return [(i, j) for i in range(len(values)) for j in range(i + 1, len(values)) if int(values[i] ^ values[j]).bit_count() <= 4]


@pytest.mark.parametrize("n,centers,flips", [(300, 10, 3), (600, 3, 3), (200, 200, 0), (500, 25, 4)])
def test_bit_planes_find_all_links(n, centers, flips):
    rng = np.random.default_rng(n)
    values = noisy(rng, n, centers, flips)
    assert parts_of(values, simhash.links_of_long_run(values)) == parts_of(values, pairs(values))
    runs = np.sort(rng.integers(0, max(1, len(values) // 8), len(values)))
    near = [(i, j) for i, j in pairs(values) if runs[i] == runs[j] and j - i < simhash.SHORT_RUN]
    assert sorted(simhash.links_of_short_runs(values, runs)) == sorted(near)


@pytest.mark.parametrize("file_rows", [2, 40, 10**6])
def test_files_lose_no_link(spark, file_rows):
    values = noisy(np.random.default_rng(5), 400, 12, 4)
    signed = values.view(np.int64).tolist()
    heads = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    number = {v: i for i, v in enumerate(signed)}
    links = [(number[a], number[b]) for a, b in simhash.near_links(heads, file_rows=file_rows).collect()]
    assert parts_of(values, links) == parts_of(values, pairs(values))


def test_odd_rows(odd):
    rows = simhash.groups(odd).collect()
    assert len(rows) == odd.count()
    assert {r.component_id for r in rows if r.fingerprint == 0} == {1}
    assert {r.component_id for r in rows if r.doc_id in (3, None) and r.fingerprint} == {3}
    kept = simhash.without_near_duplicates(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 5]
    assert simhash.groups(odd.limit(0)).count() == 0 == simhash.without_near_duplicates(odd.limit(0)).count()


def test_query(spark, documents):
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op10_simhash_near_duplicates"](spark, "/root/testdata/sf0.001").collect()}
    assert found == brute.near_groups([(r.doc_id, r.text) for r in documents.collect()])
