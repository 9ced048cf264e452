"""The exact Euclidean silhouette, tile against tile.

The mean distance of a row to the rows of each cluster has no closed form, so all pairs of a group are compared; but pairs never become rows.  Rows stand
in tiles, a task compares a tile with others by matrix products, and only sums per row and cluster leave it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewgrain.functions import vectors
from reviewgrain.operators.clusters import OUTLIER
from reviewgrain.operators.scaling import importable, store

#: Rows and bytes of a tile, and tiles of a group that one task compares with all tiles of the group.
TILE_ROWS, TILE_BYTES, TOGETHER = 1024, 1 << 20, 4


def _tiles(points: DataFrame) -> DataFrame:
    """Stored tiles of rows (group, cluster, vector): tile, group, n, d, clusters and vectors in row order.  Rows of a group follow each other in every task."""
    schema = pa.schema([("group", pa.string()), ("n", pa.int64()), ("d", pa.int64()), ("clusters", pa.binary()), ("x", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tile(group: str, rows: list) -> pa.RecordBatch:
            x = np.array([r[1] for r in rows], "<f8")
            values = [group], [len(x)], [x.shape[1]], [np.array([r[0] for r in rows], "<i8").tobytes()], [x.tobytes()]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

        now, rows = None, []
        for batch in batches:
            for group, cluster, vector in zip(*(batch.column(c).to_pylist() for c in ("group", "cluster", "vector")), strict=True):
                if rows and (group != now or len(rows) >= max(1, min(TILE_ROWS, TILE_BYTES // (8 * len(vector))))):
                    yield tile(now, rows)
                    rows = []
                now = group
                rows.append((cluster, vector))
        if rows:
            yield tile(now, rows)

    made = points.sortWithinPartitions("group").mapInArrow(run, "group string, n long, d long, clusters binary, x binary")
    return store(made.withColumn("tile", F.monotonically_increasing_id()), "silhouette-tiles")


def _sums(pairs: DataFrame) -> DataFrame:
    """group, tile, row, own, cluster, total, n: a row's summed distances to the rows of a cluster, as far as one task has compared them."""
    schema = pa.schema([("group", pa.string()), ("tile", pa.int64()), ("row", pa.int32()), ("own", pa.int64()), ("cluster", pa.int64()), ("total", pa.float64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, totals, counts, left = None, {}, {}, None

        def done() -> Iterator[pa.RecordBatch]:
            if now is None or not totals:
                return
            group, tile = now
            own = left[1]
            for cluster, total in totals.items():
                size = len(total)
                values = [group] * size, np.full(size, tile), np.arange(size, dtype=np.int32), own, np.full(size, cluster), total, np.full(size, counts[cluster])
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

        for batch in batches:
            for i in range(batch.num_rows):
                place = batch.column("group")[i].as_py(), batch.column("tile")[i].as_py()
                d = batch.column("d")[i].as_py()
                read = lambda x, clusters: (np.frombuffer(batch.column(x)[i].as_buffer(), "<f8").reshape(-1, d), np.frombuffer(batch.column(clusters)[i].as_buffer(), "<i8"))  # noqa: B023, E731
                if place != now:
                    yield from done()
                    x, own = read("x", "clusters")
                    now, totals, counts, left = place, {}, {}, (x.copy(), own.copy())
                other, labels = read("x2", "clusters2")
                away = distances(left[0], other)
                for cluster in np.unique(labels).tolist():
                    mine = labels == cluster
                    totals[cluster] = totals.get(cluster, 0.0) + away[:, mine].sum(axis=1)
                    counts[cluster] = counts.get(cluster, 0) + int(mine.sum())
        yield from done()

    return pairs.mapInArrow(run, "group string, tile long, row int, own long, cluster long, total double, n long")


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``a`` and ``b``; where the product form loses digits (near rows) from the differences."""
    a2, b2 = (a * a).sum(axis=1), (b * b).sum(axis=1)
    squares = a2[:, None] + b2 - 2 * (a @ b.T)
    i, j = np.nonzero(squares < 1e-6 * (a2[:, None] + b2))
    for at in range(0, len(i), 65_536):
        p, q = i[at : at + 65_536], j[at : at + 65_536]
        squares[p, q] = ((a[p] - b[q]) ** 2).sum(axis=1)
    return np.sqrt(np.maximum(squares, 0.0))


def silhouette(points: DataFrame, keys: Sequence[str] = (), cluster: str = "cluster", vector: str = "embedding") -> DataFrame:
    """keys, n_clusters and silhouette: the mean over all rows of a group, with Euclidean distances.

    Rows that are alone in their cluster score 0.  Outliers (-1) are scored like a cluster but don't count as one; fewer than two clusters give 0.  Rows without a vector
    or a cluster take no part.  A group's tiles are dealt to tasks in parcels of TOGETHER, each with a copy of all tiles of the group, so a large group has many tasks.
    """
    importable(points.sparkSession)
    known = points.where(F.col(vector).isNotNull() & F.col(cluster).isNotNull())
    group = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}) if keys else F.lit("")
    tiles = _tiles(known.select(group.alias("group"), F.col(cluster).cast("long").alias("cluster"), vectors.doubles(F.col(vector)).alias("vector")))
    # parcels: the tiles of a group in the order of their numbers, which are narrow
    narrow = tiles.select("group", "tile")
    placed = narrow.withColumn("parcel", F.floor((F.row_number().over(Window.partitionBy("group").orderBy("tile")) - 1) / TOGETHER).cast("int"))
    placed = store(placed, "parcels")
    parcels = placed.groupBy("group").agg(F.max("parcel").alias("last"))
    left = tiles.join(placed, ["group", "tile"])
    right = tiles.join(parcels, "group").select(
        "group", F.explode(F.sequence(F.lit(0), "last")).alias("parcel"), F.col("clusters").alias("clusters2"), F.col("x").alias("x2")
    )
    sums = _sums(left.join(right, ["group", "parcel"]).select("group", "tile", "d", "clusters", "x", "clusters2", "x2"))
    per_cluster = sums.groupBy("group", "tile", "row", "own", "cluster").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    mine = F.col("own") == F.col("cluster")
    rows = per_cluster.groupBy("group", "tile", "row").agg(
        F.max(F.when(mine, F.col("n"))).alias("size"),
        F.max(F.when(mine & (F.col("n") > 1), F.col("total") / (F.col("n") - 1))).alias("a"),
        F.min(F.when(~mine, F.col("total") / F.col("n"))).alias("b"),
        F.count_if(F.col("cluster") != OUTLIER).alias("k"),
    )
    width = F.greatest("a", "b")
    score = F.when((F.col("size") > 1) & F.col("b").isNotNull() & (width > 0), (F.col("b") - F.col("a")) / width).otherwise(0.0)
    found = rows.groupBy("group").agg(F.max("k").alias("n_clusters"), F.when(F.max("k") >= 2, F.avg(score)).otherwise(0.0).alias("silhouette"))
    if not keys:
        return found.drop("group")
    schema = ", ".join(f"`{k}` {points.schema[k].dataType.simpleString()}" for k in keys)
    return found.select(F.from_json("group", schema).alias("g"), "n_clusters", "silhouette").select("g.*", "n_clusters", "silhouette")
