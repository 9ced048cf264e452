import numpy as np
import pytest

from reviewgrain.llm import whitening
from reviewgrain.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain(vectors, components):
    """x, the covariance's eigenvalues and vectors (falling), and the exact deviations."""
    x = np.floor(1024 * np.array(vectors, np.float64)).astype(np.int64) + 100_000
    centred = x - x.mean(axis=0)
    values, turn = np.linalg.eigh(centred.T @ centred / len(x))
    sums = [int(s) for s in x.sum(axis=0)]
    deviation = [sum((len(x) * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    return centred, values[::-1], turn[:, ::-1][:, :components], deviation


def check(rows, ids, vectors, number, tolerance=1e-7):
    centred, values, turn, deviation = plain(vectors, number)
    want = centred @ turn / np.sqrt(values[:number])
    got = np.full(want.shape, np.nan)
    at = {i: k for k, i in enumerate(ids)}
    assert len(rows) == len(ids) * number
    for r in rows:
        got[at[r.vec_id], r.component - 1] = r.whitened
        assert r.n == len(ids) and int(r.deviation) == deviation[at[r.vec_id]]
        assert abs(r.explained / (values[r.component - 1] / values.sum()) - 1) < 1e-9 and r.identity_error < 1e-9
    sign = np.sign((got * want).sum(axis=0))
    assert np.abs(got - want * sign).max() < tolerance
    assert len({r.identity_error for r in rows}) == 1


def test_query(spark):
    given = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    rows = QUERIES["op12_embedding_whitening"](spark, SF).collect()
    check(rows, [i for i, _ in given], [v for _, v in given], 8)


@pytest.mark.parametrize("d", [2, 9, 40, 130])
def test_dimensions_and_near_ties(spark, d):
    rng = np.random.default_rng(d)
    vectors = rng.standard_normal((300, d)) * np.linspace(1, 1.2, d)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(5)
    out, found = whitening.whitened(frame)
    check(out.collect(), list(range(300)), vectors, min(8, d))
    assert found.residual < 1e-12 and found.passes <= 1 + whitening.DEGREE * whitening.CYCLES


def test_odd_rows(spark):
    good = [[0.5, -1.25, 3.0], [1.5, 0.0, -2.0], [0.25, 8.0, 1.0], [0.25, 8.0, 1.0], [-4.0, 1.0, 0.5]]
    bad = [None, [], [1.0, None, 2.0], [float("nan"), 0.0, 0.0], [float("inf"), 0.0, 0.0], [1.0, 2.0]]
    rows = [(i, v, "n", "w") for i, v in enumerate(good)] + [(50 + i, v, "n", "w") for i, v in enumerate(bad)]
    frame = spark.createDataFrame(rows, "vec_id int, embedding array<double>, n string, whitened string")
    out, _ = whitening.whitened(frame)
    check(out.collect(), list(range(5)), good, 3)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and out.schema["vec_id"].dataType == frame.schema["vec_id"].dataType
    for none in (frame.limit(0), frame.where("vec_id >= 50").where("size(embedding) <> 2"), frame.where("vec_id IN (2, 3)"), frame.where("vec_id = 1")):
        assert whitening.whitened(none)[0].count() == 0
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i, 7.0]) for i in range(9)], "vec_id long, embedding array<float>")
    assert {r.component for r in whitening.whitened(flat)[0].collect()} == {1}
    null_id = spark.createDataFrame([(None, [1.0, 2.0]), (None, [2.0, 1.0]), (3, [5.0, 5.0])], "vec_id long, embedding array<double>")
    assert whitening.whitened(null_id)[0].count() == 6
    huge = spark.createDataFrame([(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [5.0, 1e9])], "vec_id long, embedding array<double>")
    assert whitening.whitened(huge)[0].count() == 6


def test_exact_sums_of_many_rows():
    shape = whitening.Shape(10**10, 3, (10**15 + 7, -(10**14) - 3, 0))
    x = np.array([[100_001, -5, 99_999], [1, 2, 3]])
    want = [sum((shape.n * int(v) - s) ** 2 for v, s in zip(row, shape.sums, strict=True)) for row in x]
    assert whitening._deviations(x, shape, sum(s * s for s in shape.sums)) == want
