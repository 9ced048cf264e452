import numpy as np
import pytest

from reviewgrain.operators import search_index, silhouettes


def frame(spark, vectors, ids=None, parts=4):
    rows = [(int(i), None if v is None else [float(x) for x in v]) for i, v in zip(ids if ids is not None else range(len(vectors)), vectors)]
    return spark.createDataFrame(rows, "doc_id long, embedding array<double>").repartition(parts)


def plain(vectors, queries, k):
    """{query: [doc]} by the full scan."""
    length = lambda m: np.where((n := np.linalg.norm(m, axis=1)) > 0, n, 1)[:, None]
    x = vectors / length(vectors)
    sims = np.round((queries / length(queries)) @ x.T, 9)
    return {q: sorted(range(len(x)), key=lambda j: (-sims[q, j], j))[:k] for q in range(len(queries))}


@pytest.mark.parametrize("kind", ["blobs", "uniform", "copies"])
def test_many_queries_equal_the_full_scan(spark, kind):
    rng = np.random.default_rng(7)
    vectors = rng.standard_normal((600, 6))
    if kind == "blobs":
        vectors = np.repeat(rng.standard_normal((12, 6)) * 9, 50, axis=0) + rng.standard_normal((600, 6)) * 0.05
    if kind == "copies":
        vectors[:200] = vectors[0]
    vectors[300] = 0
    queries = np.vstack([vectors[::40], np.zeros((1, 6)), rng.standard_normal((3, 6))])
    index = search_index.build(frame(spark, vectors))
    found = search_index.search_many(index, frame(spark, queries), 7).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["query"], r.place)):
        got.setdefault(r["query"], []).append(r.doc_id)
    assert got == plain(vectors, queries, 7)
    compared = np.mean([r.compared for r in found if np.any(queries[r["query"]])])
    assert compared < 0.35 * 600 if kind == "blobs" else compared <= 600


def test_odd_rows(spark):
    docs = frame(spark, [None, [1, 0], [0, 0], [], [1, 0], [-1, 0]])
    index = search_index.build(docs)
    found = search_index.search_many(index, frame(spark, [[2, 0], None, [0, 0]]), 10).collect()
    assert {q: [r.doc_id for r in sorted(found, key=lambda r: r.place) if r["query"] == q] for q in (0, 1, 2)} == {0: [1, 4, 2, 5], 1: [], 2: [1, 2, 4, 5]}
    empty = search_index.build(docs.limit(0))
    assert search_index.search_many(empty, docs).count() == 0 and search_index.search_many(index, docs.limit(0)).count() == 0


@pytest.mark.parametrize("tile", [3, 1024])
def test_silhouette_of_tiles(spark, monkeypatch, tile):
    monkeypatch.setattr(silhouettes, "TILE_ROWS", tile)
    rng = np.random.default_rng(tile)
    rows = [(g, int(c), (rng.standard_normal(3) + 3 * c).tolist()) for g in ("a", None, "b") for c in rng.integers(-1, 3, 25)] + [("b", 9, [100.0, 0.0, 0.0]), ("one", 0, [1.0, 2.0, 3.0]), ("one", 0, [1.0, 2.0, 4.0]), ("same", 0, [1.0, 1.0, 1.0]), ("same", 1, [1.0, 1.0, 1.0]), ("same", 1, [1.0, 1.0, 1.0])]
    points = spark.createDataFrame(rows, "g string, cluster int, embedding array<double>").repartition(3)

    def score(members):
        labels, x = np.array([c for _, c, _ in members]), np.array([v for _, _, v in members])
        if len(set(labels.tolist()) - {-1}) < 2:
            return 0.0
        d = np.linalg.norm(x[:, None] - x[None], axis=2)
        out = []
        for i, c in enumerate(labels):
            if (labels == c).sum() == 1:
                out.append(0.0)
                continue
            a = d[i, labels == c].sum() / ((labels == c).sum() - 1)
            b = min(d[i, labels == o].mean() for o in set(labels.tolist()) - {c})
            out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
        return float(np.mean(out))

    want = {g: score([r for r in rows if r[0] == g]) for g in {r[0] for r in rows}}
    got = {r.g: r.silhouette for r in silhouettes.silhouette(points, ["g"]).collect()}
    assert got.keys() == want.keys() and all(abs(got[g] - want[g]) < 1e-9 for g in want)
    assert silhouettes.silhouette(points.limit(0), ["g"]).count() == 0


def test_no_row_per_query_and_row(spark, monkeypatch):
    """Pairs stay inside the tasks, and similarities are those of vectors.cosine in every digit."""
    from pyspark.sql import functions as F

    from reviewgrain.functions import vectors

    rng = np.random.default_rng(3)
    x = rng.standard_normal((900, 32))
    x[5], x[7] = x[3], 1e-160 * x[3]
    rows = frame(spark, x)
    plan = search_index.search_many(search_index.build(rows), rows.where("doc_id % 3 = 0"), 4)
    assert "zip_with" not in plan._jdf.queryExecution().toString()
    q = rows.where("doc_id % 3 = 0").select(F.col("doc_id").alias("query"), F.col("embedding").alias("q"))
    every = q.crossJoin(rows).select("query", "doc_id", vectors.cosine(F.col("embedding"), F.col("q")).alias("s")).collect()
    want = {}
    for r in sorted(every, key=lambda r: (r["query"], -r.s, r.doc_id)):
        want.setdefault(r["query"], []).append((r.doc_id, r.s))
    got = {}
    for r in sorted(plan.collect(), key=lambda r: (r["query"], r.place)):
        got.setdefault(r["query"], []).append((r.doc_id, r.similarity))
    assert got == {k: v[:4] for k, v in want.items()}


def test_missing_and_endless_entries(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [float("nan"), 1.0]), (3, [None, 1.0]), (4, [1.0, 1.0])], "doc_id long, embedding array<double>").coalesce(1)
    index = search_index.build(rows, pivots=1)
    found = search_index.search_many(index, rows.where("doc_id in (1, 3)"), 3).collect()
    assert sorted((r["query"], r.place, r.doc_id) for r in found) == [(1, 1, 2), (1, 2, 1), (1, 3, 4), (3, 1, 1), (3, 2, 2), (3, 3, 3)]
