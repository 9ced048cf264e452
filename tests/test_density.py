import numpy as np
import pytest

from reviewgrain.operators import density, topics


def frame(spark, vectors, parts=5):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "row_id long, embedding array<double>").repartition(parts)


def brute(x, radius, min_rows):
    """(near, core, cluster) per row from the whole matrix of distances."""
    away = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    close = away <= radius
    near = close.sum(axis=1)
    core = near >= min_rows
    cluster = np.full(len(x), -1)
    for i in np.flatnonzero(core):
        if cluster[i] < 0:
            todo = [i]
            while todo:
                at = todo.pop()
                cluster[at] = i
                todo += [j for j in np.flatnonzero(close[at] & core & (cluster < 0))]
    for i in np.flatnonzero(~core):
        reach = [(away[i, j], j) for j in np.flatnonzero(close[i] & core)]
        if reach:
            cluster[i] = cluster[min(reach)[1]]
    return near, core, cluster


def shapes(kind):
    rng = np.random.default_rng(11)
    if kind == "blobs":
        x = np.vstack([rng.standard_normal((60, 5)) * 0.3 + rng.standard_normal(5) * 6 for _ in range(7)])
        return np.vstack([x, rng.uniform(-12, 12, (80, 5))]), 0.7, 6
    if kind == "chain":  # one long thin cluster over many cells
        t = np.sort(rng.uniform(0, 60, 500))
        return np.c_[np.cos(t / 5) * t, np.sin(t / 5) * t], 1.3, 3
    x = rng.standard_normal((500, 3))
    x[:170] = x[0]  # a third of the rows are copies
    return x, 0.25, 4


@pytest.mark.parametrize("kind", ["blobs", "chain", "copies"])
def test_equals_brute_force(spark, kind, monkeypatch):
    monkeypatch.setattr(density, "TILE_ROWS", 40)  # so that cells have several tiles
    x, radius, least = shapes(kind)
    near, core, cluster = brute(x, radius, least)
    found = {r.row_id: r for r in density.density_clusters(frame(spark, x), radius, least).collect()}
    assert len(found) == len(x) and len(set(cluster)) > 2
    assert [found[i].near for i in range(len(x))] == near.tolist()
    assert [found[i].core for i in range(len(x))] == core.tolist()
    assert [found[i].cluster for i in range(len(x))] == cluster.tolist()


def test_odd_rows(spark):
    rows = [[1, 1], None, [], [1, None], [float("nan"), 1], [float("inf"), 0], [1, 1], [0, 0], [0.0, -0.0]]
    found = {r.row_id: (r.near, r.core, r.cluster) for r in density.density_clusters(frame(spark, rows), 0.5, 2).collect()}
    assert all(found[i] == (0, False, -1) for i in range(1, 6))
    assert found[0] == found[6] == (2, True, 0) and found[7] == found[8] == (2, True, 7)
    assert density.density_clusters(frame(spark, [[1.0]]).limit(0), 1.0).count() == 0


def test_topics_are_numbered_by_size(spark):
    x = np.repeat([[0.0, 0.0], [9.0, 0.0], [0.0, 9.0]], [3, 8, 5], axis=0)
    found = topics.density_topics(frame(spark, np.vstack([x, [[50.0, 50.0]]])), 1.0, 3, min_size=4).collect()
    assert {r.row_id: r.topic_id for r in found} == {**dict.fromkeys(range(3), -1), **dict.fromkeys(range(3, 11), 0), **dict.fromkeys(range(11, 16), 1), 16: -1}


def test_points_are_not_copied_to_the_cells_they_reach(spark, monkeypatch):
    sizes = {}

    def counted(df, name, kept=density.store):
        out = kept(df, name)
        sizes[name] = max(sizes.get(name, 0), out.count())
        return out

    monkeypatch.setattr(density, "store", counted)
    x = np.random.default_rng(5).standard_normal((400, 12))
    x /= np.linalg.norm(x, axis=1)[:, None]  # every point can have neighbours in every cell
    near, core, cluster = brute(x, 1.1, 30)
    found = {r.row_id: r for r in density.density_clusters(frame(spark, x), 1.1, 30).collect()}
    assert [(found[i].near, found[i].core, found[i].cluster) for i in range(len(x))] == list(zip(near, core, cluster, strict=True))
    assert sizes["density-places"] == len(x)


def test_edges_that_connect_nothing_new():
    joined = density._Joined(6)
    assert joined.add(np.array([0, 2, 0, 1]), np.array([1, 3, 1, 0])).tolist() == [0, 1]
    assert joined.add(np.array([3, 1, 4]), np.array([1, 2, 5])).tolist() == [0, 2]
    assert joined.add(np.array([0]), np.array([3])).tolist() == []
