import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewgrain.operators import clusters, topics
from reviewgrain.plans import discovery, evaluation
from reviewgrain.sources import encodings


@pytest.fixture(scope="module")
def numbers():
    rng = np.random.default_rng(7)
    labels = np.repeat([0, 1, 2, 3], [12, 9, 8, 1])
    x = rng.normal(size=(30, 4)) + labels[:, None] * 1.5
    return x, labels


@pytest.fixture
def points(spark, numbers):
    x, labels = numbers
    rows = [(i, "g", int(c), [float(v) for v in row]) for i, (row, c) in enumerate(zip(x, labels))]
    return spark.createDataFrame(rows, "row_id long, g string, cluster long, embedding array<double>")


def silhouette(x, labels, squared):
    """Straight from the definition."""
    gaps = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    gaps = gaps if squared else np.sqrt(gaps)
    out = []
    for i, own in enumerate(labels):
        mine = (labels == own) & (np.arange(len(x)) != i)
        if not mine.any():
            out.append(0.0)
            continue
        a = gaps[i][mine].mean()
        b = min(gaps[i][labels == c].mean() for c in set(labels) - {own})
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


def test_squared_silhouette(points, numbers):
    got = clusters.squared_silhouette(points).first()
    assert got["n_clusters"] == 4
    assert got["squared_silhouette"] == pytest.approx(silhouette(*numbers, True), abs=1e-9)


def test_outliers_are_no_cluster(points):
    two = points.withColumn("cluster", F.when(F.col("cluster") == 0, 0).otherwise(-1).cast("long"))
    assert clusters.squared_silhouette(two).first()["squared_silhouette"] == 0.0
    assert clusters.calinski_harabasz(two).first()[0] == 0.0
    assert clusters.davies_bouldin(two).first()[0] is None


def test_one_cluster_scores_zero(points):
    one = points.withColumn("cluster", F.lit(0).cast("long"))
    assert clusters.squared_silhouette(one).first()["squared_silhouette"] == 0.0
    assert clusters.calinski_harabasz(one).first()[0] == 0.0
    assert clusters.davies_bouldin(one).first()[0] is None


def test_calinski_harabasz(points, numbers):
    x, labels = numbers
    center = x.mean(0)
    means = {c: x[labels == c].mean(0) for c in set(labels)}
    between = sum((labels == c).sum() * ((m - center) ** 2).sum() for c, m in means.items())
    within = sum(((x[labels == c] - m) ** 2).sum() for c, m in means.items())
    want = between / 3 / (within / (30 - 4))
    assert clusters.calinski_harabasz(points).first()[0] == pytest.approx(want, rel=1e-9)


def test_davies_bouldin(points, numbers):
    x, labels = numbers
    names = sorted(set(labels))
    means = {c: x[labels == c].mean(0) for c in names}
    spread = {c: np.linalg.norm(x[labels == c] - means[c], axis=1).mean() for c in names}
    worst = [
        max((spread[a] + spread[b]) / np.linalg.norm(means[a] - means[b]) for b in names if b != a) for a in names
    ]
    assert clusters.davies_bouldin(points).first()[0] == pytest.approx(np.mean(worst), rel=1e-9)


def test_coherence_equals_all_pairs(points, numbers):
    x, labels = numbers
    got = {r["cluster"]: r["avg_similarity"] for r in clusters.coherence(points).collect()}
    assert set(got) == {0, 1, 2}
    for c, value in got.items():
        unit = [v / np.linalg.norm(v) for v in x[labels == c]]
        assert value == pytest.approx(np.mean([a @ b for a, b in itertools.combinations(unit, 2)]), abs=1e-9)


def test_grouped_kmeans_separates_far_groups(spark):
    rows = [(i, "ab"[i % 2], [float(10 * (i // 2 % 2)), float(i % 3)]) for i in range(40)]
    table = spark.createDataFrame(rows, "row_id long, g string, embedding array<double>")
    for tries in (1, 2):
        found = clusters.grouped_kmeans(table, ["g"], 2, iterations=4, tries=tries).collect()
        assert len(found) == 40 and {r["cluster"] for r in found} <= {0, 1}
        sides = {(r["g"], r["embedding"][0]): set() for r in found}
        for r in found:
            sides[r["g"], r["embedding"][0]].add(r["cluster"])
        if tries == 2:
            assert all(len(s) <= 2 for s in sides.values())


def test_balance(points):
    got = clusters.cluster_balance(points).first()
    sizes = np.array([12, 9, 8, 1])
    assert (got["min_size"], got["max_size"]) == (1, 12)
    assert got["variation"] == pytest.approx(sizes.std() / sizes.mean(), abs=1e-3)


def test_evaluation_has_one_row_per_category(points):
    rows = points.withColumnRenamed("g", "product_category")
    totals = rows.groupBy("product_category").agg((F.count(F.lit(1)) * 2).alias("total_reviews"))
    got = evaluation.evaluate_categories(rows, totals).collect()
    assert len(got) == 1 and got[0]["coverage"] == 50.0 and -1 <= got[0]["squared_silhouette"] <= 1
    assert evaluation.rollup(evaluation.evaluate_categories(rows, totals)).first()["categories_evaluated"] == 1


def test_too_few_reviews_give_an_error_row(points):
    rows = points.withColumns({"review": F.lit("x"), "title": F.lit("t"), "product_category": F.lit("c")})
    got = discovery.discover_aspects(rows, 31).collect()
    assert len(got) == 1 and not got[0]["success"] and "31" in got[0]["error"]


def test_discovered_aspects_cover_all_reviews(points):
    rows = points.withColumns({"review": F.lit("good sound quality"), "title": F.lit("t"), "product_category": F.lit("c")})
    got = discovery.discover_aspects(rows, 3, tries=2).collect()
    assert sum(r["review_count"] for r in got) == 30 and all(r["success"] for r in got)


def test_hashed_vectors_have_unit_length(spark):
    rows = spark.createDataFrame([(0, "big red box"), (1, "small blue box"), (2, None)], "row_id long, review string")
    model = encodings.hashed_model(rows, size=32)
    out = encodings.encode_hashed(model, rows).orderBy("row_id").collect()
    assert [len(r["embedding"]) for r in out] == [32, 32, 32]
    assert np.linalg.norm(out[0]["embedding"]) == pytest.approx(1.0, abs=1e-5)


def test_callers_encoder(spark):
    rows = spark.createDataFrame([(0, "abc"), (1, "a")], "row_id long, review string")
    out = encodings.encode_with(rows, lambda s: s.map(lambda t: [float(len(t))])).orderBy("row_id").collect()
    assert [r["embedding"] for r in out] == [[3.0], [1.0]]


def test_topics_without_match_fall_back_to_words(spark):
    docs = spark.createDataFrame([(0, "fine warranty", 0), (1, "x", 1), (2, None, 1)], "row_id long, review string, topic_id long")
    table = spark.createDataFrame([(0, 1, ["sound"]), (1, 2, ["price"])], "topic_id long, size long, keywords array<string>")
    assert [r["row_id"] for r in topics.documents_for_aspect(docs, table, "warranty").collect()] == [0]
    assert [r["row_id"] for r in topics.documents_for_aspect(docs, table, "pric").collect()] == [1]


def test_topic_labels(spark):
    rows = spark.createDataFrame([(3, ["a", "b", "c", "d"]), (4, [])], "topic_id long, keywords array<string>")
    labels = [r[0] for r in rows.select(topics.topic_label(F.col("topic_id"), F.col("keywords"))).collect()]
    assert labels == ["a / b / c", "Topic 4"]
