import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewgrain.llm import hard_negatives as hn
from reviewgrain.llm.queries import QUERIES

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows, is_anchor, positives=5, negatives=5, lowest=80):
    """All results of (id, label, vector) rows by comparing every anchor with every row."""
    good = [r for r in rows if r[0] is not None and r[1] is not None and r[2] and all(c is not None and math.isfinite(c) for c in r[2])]
    x = [[math.floor(256 * float(c)) for c in r[2]] for r in good]
    out = []
    for i, (a, label, _) in enumerate(good):
        if not is_anchor(a):
            continue
        scored = [(-sum(p * q for p, q in zip(x[i], x[j], strict=True)), good[j][0], good[j][1], j) for j in range(len(good)) if len(x[j]) == len(x[i])]
        scored.sort()
        for s, b, _, _ in [r for r in scored if r[2] == label and r[3] != i][:positives]:
            window = [r for r in scored if r[2] != label and lowest * -s <= 100 * -r[0] <= 100 * -s][:negatives]
            out += [(a, b, k, r[1], -s, -r[0]) for k, r in enumerate(window, 1)]
    return sorted(out)


def found(frame):
    return sorted(tuple(r[c] for c in COLUMNS) for r in frame.collect())


@pytest.mark.parametrize("seed", range(12))
def test_survivors_are_all_pairs_above_the_threshold(seed):
    rng = np.random.default_rng(seed)
    d = int(rng.integers(1, 70))
    spread = rng.uniform(0.1, 3, d) ** (seed % 3)
    a, x = (np.rint(rng.standard_normal((n, d)) * 50 * spread).astype(np.int64) for n in (30, 200))
    x[:5], x[5] = a[:5], 0
    if seed % 4 == 3:
        a, x = a << 20, x << 20
    scores = a @ x.T
    for share in (0, 10, 50, 99, 99.9):
        limits = np.percentile(scores, share, axis=1).astype(np.int64)
        limits[:2] = hn.NEVER, 0
        i, j, s = hn.survivors(a, limits, x)
        assert sorted(zip(i.tolist(), j.tolist(), s.tolist())) == sorted((p, q, int(scores[p, q])) for p, q in np.argwhere(scores >= limits[:, None]).tolist())


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, None if r.label is None else (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert found(QUERIES["op13_hard_negatives"](spark, sf)) == plain(rows, lambda i: i % 100 == 0)


def test_many_anchors_copies_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(hn, "TILE_ROWS", 64)
    monkeypatch.setattr(hn, "BLOCK_ANCHORS", 40)
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((600, 12)) / 3
    vectors[100:300] = vectors[0]  # a third are copies, with two labels
    rows = [(i, int(i % 2 if 100 <= i < 300 else rng.integers(4)), v.tolist()) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id int, label int, embedding array<double>").repartition(7)
    got = hn.mine(frame, F.col("vec_id") % 5 == 0)
    assert found(got) == plain(rows, lambda i: i % 5 == 0) and got.schema["anchor_id"].dataType == frame.schema["vec_id"].dataType
    assert found(hn.mine(frame, F.col("vec_id") % 50 == 0, positives=2, negatives=3, lowest=50)) == plain(rows, lambda i: i % 50 == 0, 2, 3, 50)


def test_odd_rows(spark):
    rows = [
        (0, 1, [1.0, 0.5]), (0, 1, [1.0, 0.5]), (1, 1, [0.9, 0.5]), (2, 2, [0.9, 0.45]), (3, 2, [0.9, 0.45]), (4, 2, [-1.0, 0.0]), (5, 1, [-1.0, 0.0]), (6, 1, [0.0, 0.0]), (7, 2, [0.0, 0.0]),
        (10, None, [1.0, 0.5]), (None, 1, [1.0, 0.5]), (11, 1, None), (12, 1, []), (13, 1, [None, 1.0]), (14, 1, [float("nan"), 1.0]), (15, 2, [float("-inf"), 1.0]),
        (20, 1, [1.0, 0.5, 0.2]), (21, 1, [1.0, 0.5, 0.1]), (22, 3, [1.0, 0.5, 0.0]), (30, 9, [1.0, 0.5]),
    ]
    frame = spark.createDataFrame([(*r, "s", 1) for r in rows], "vec_id long, label int, embedding array<double>, score string, anchor int")
    for anchor, same in ((F.col("vec_id") >= 0, lambda i: True), (F.col("vec_id") == 6, lambda i: i == 6), (F.when(F.col("vec_id") == 0, True), lambda i: i == 0)):
        out = hn.mine(frame, anchor)
        assert out.columns == COLUMNS and found(out) == plain(rows, same)
    assert hn.mine(frame, F.lit(None).cast("boolean")).count() == 0 and hn.mine(frame.limit(0), F.lit(True)).count() == 0
    huge = spark.createDataFrame([(i, i % 2, [1e30 * (i + 1), 1.0]) for i in range(6)], "vec_id long, label long, embedding array<double>")
    assert hn.mine(huge, F.lit(True)).count() == 6 * 2 * 3
