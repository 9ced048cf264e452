"""Density clusters of vectors: core rows, what they reach, and outliers.

A row is a core row if at least ``min_rows`` rows, itself included, lie within ``radius`` of it.  Core rows within ``radius`` of each other are in one cluster; any
other row within ``radius`` of a core row joins the nearest one's cluster (ties: the smaller id); the rest are outliers.

Equal vectors become one weighted point.  A point lies in the cell of its nearest pivot, one of a bounded sample, and points that follow each other in a cell make a
tile.  By the triangle inequality a tile knows the cells and distances from their pivots where its points can have neighbours; so tiles that can't hold neighbours
never meet.  Tiles meet by blocks, each two once, by matrix products, and only counts, nearest core points and the edges of a spanning forest leave two blocks, never
pairs.  Where nothing can be ruled out, as with vectors of many dimensions and a wide radius, that is all pairs, with the memory of two blocks in a task.
Forests are contracted to components in rounds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewgrain.functions import vectors
from reviewgrain.operators.clusters import OUTLIER
from reviewgrain.operators.scaling import importable, spread_join, store
from reviewgrain.operators.silhouettes import distances

#: Pivots at most; so many vectors are sent to the tasks.
PIVOTS = 1024
#: Rows and bytes of a tile; tiles of a block, as a power of two; pairs of blocks that a task compares, and tasks at most.
TILE_ROWS, TILE_BYTES, BLOCK, TOGETHER, TASKS = 512, 1 << 20, 3, 8, 2000
#: Copies of a block, so that those it meets are in several tasks.
SLICES = 4
#: Bounds on cells give way by this share; the comparison with ``radius`` itself is exact.
SLACK = 1e-9

TILE = "cell int, low double, high double, d long, ids binary, weights binary, cores binary, x binary, cells array<int>, lows array<double>, highs array<double>"


def _points(rows: DataFrame) -> DataFrame:
    """Stored distinct vectors: key, point (the smallest row id), weight, v."""
    grouped = rows.groupBy("key").agg(F.min("row").alias("point"), F.count(F.lit(1)).alias("weight"), F.min_by("v", "row").alias("v"))
    return store(grouped, "density-points")


def _pivots(points: DataFrame, most: int | None) -> np.ndarray:
    wanted = min(PIVOTS, max(1, math.isqrt(points.count()))) if most is None else most
    chosen = points.orderBy(F.xxhash64("key"), "point").select("v").limit(wanted).collect()
    return np.array([r["v"] for r in chosen], np.float64)


def _places(points: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Every point in its own cell: point, weight, v, cell, ring (the distance from its pivot)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, TILE_ROWS):
                batch = whole.slice(at, TILE_ROWS)
                away = distances(np.array(batch.column("v").to_pylist(), np.float64).reshape(batch.num_rows, -1), pivots)
                names = ["point", "weight", "v"]
                home = pa.array(away.argmin(axis=1).astype(np.int32))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), home, pa.array(away.min(axis=1))], [*names, "cell", "ring"])

    kind = points.schema["point"].dataType.simpleString()
    placed = points.select("point", "weight", "v").mapInArrow(run, f"point {kind}, weight long, v array<double>, cell int, ring double")
    return store(placed, "density-places")


def _tiles(placed: DataFrame, pivots: np.ndarray, radius: float) -> DataFrame:
    """Stored tiles of rows (point, weight, core, v, cell, ring), by cell and ring; a range of both per task, so a large cell has many.

    cells, lows and highs: the cells that can hold a neighbour of any of the tile's points, and between which distances from their pivots these points are.
    """
    reach = 2 * radius
    schema = pa.schema(
        [("cell", pa.int32()), ("low", pa.float64()), ("high", pa.float64()), ("d", pa.int64()), *((c, pa.binary()) for c in ("ids", "weights", "cores", "x")),
         ("cells", pa.list_(pa.int32())), ("lows", pa.list_(pa.float64())), ("highs", pa.list_(pa.float64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def tile() -> pa.RecordBatch:
            cells, rings, ids, weights, cores, x = zip(*rows, strict=True)
            x = np.array(x, "<f8")
            away = distances(x, pivots)
            # a neighbour in another cell is nearer to that pivot than to this one, and no farther than radius
            may = away <= away.min(axis=1)[:, None] + reach + SLACK * (1 + away)
            visited = np.flatnonzero(may.any(axis=0))
            lows, highs = np.where(may, away, np.inf).min(axis=0)[visited], np.where(may, away, -np.inf).max(axis=0)[visited]
            packed = [np.array(v, t).tobytes() for v, t in ((ids, "<i8"), (weights, "<i8"), (cores, "?"))]
            values = [cells[0], min(rings), max(rings), x.shape[1], *packed, x.tobytes(), visited.tolist(), lows.tolist(), highs.tolist()]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("cell", "ring", "point", "weight", "core", "v")), strict=True):
                if rows and (row[0] != rows[0][0] or len(rows) >= max(1, min(TILE_ROWS, TILE_BYTES // (8 * max(1, len(row[5])))))):
                    yield tile()
                    rows = []
                rows.append(row)
        if rows:
            yield tile()

    spread = placed.repartitionByRange("cell", "ring", "point").sortWithinPartitions("cell", "ring", "point")
    made = spread.select("cell", "ring", "point", "weight", "core", "v").mapInArrow(run, TILE)
    return store(made.withColumn("tile", F.monotonically_increasing_id()), "density-tiles")


def _meetings(placed: DataFrame, pivots: np.ndarray, radius: float) -> DataFrame:
    """Pairs of blocks, each once: tiles, tiles2 (arrays of tiles) and pairs (a, b) of places in them whose rings are near enough."""
    tiles = _tiles(placed, pivots, radius).withColumn("block", F.shiftright("tile", BLOCK)).withColumn("place", F.col("tile").bitwiseAND((1 << BLOCK) - 1).cast("int"))
    visits = tiles.select("tile", "block", "place", F.explode(F.arrays_zip("cells", "lows", "highs")).alias("v")).select("tile", "block", "place", F.col("v.cells").alias("cell"), "v.lows", "v.highs")
    members = tiles.select("cell", *[F.col(c).alias(f"{c}2") for c in ("tile", "block", "place", "low", "high")])
    width = F.lit(radius) + SLACK * (1 + F.col("highs") + F.col("high2"))
    near = (F.col("lows") <= F.col("high2") + width) & (F.col("low2") <= F.col("highs") + width)
    # neighbours visit each other, so one of the two directions is enough; which one is by chance, so that every block has as many
    forth = F.pmod(F.xxhash64(F.least("block", "block2"), F.greatest("block", "block2")), F.lit(2)) == 0
    once = F.when(F.col("block") == F.col("block2"), F.col("tile") <= F.col("tile2")).otherwise((F.col("block") < F.col("block2")) == forth)
    found = visits.join(members, "cell").where(near & once).groupBy("block", "block2").agg(F.collect_list(F.struct(F.col("place").alias("a"), F.col("place2").alias("b"))).alias("pairs"))
    found = store(found.withColumn("slice", F.pmod(F.xxhash64("block"), F.lit(SLICES)).cast("int")), "density-meetings")
    blocks = tiles.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("place", "d", "ids", "weights", "cores", "x"))).alias("tiles"))
    blocks = store(blocks, "density-blocks")  # of 2^BLOCK tiles at most
    cores = placed.sparkSession.sparkContext.defaultParallelism
    tasks = max(3 * cores, min(TASKS, found.count() // TOGETHER))
    left = found.join(blocks, "block").repartition(tasks, "block2", "slice")
    right = blocks.select(F.col("block").alias("block2"), F.col("tiles").alias("tiles2"), F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))).alias("slice")).repartition(tasks, "block2", "slice")
    return left.join(right.hint("merge"), ["block2", "slice"]).select((F.col("block") == F.col("block2")).alias("own"), "tiles", "tiles2", "pairs")


class _Block(NamedTuple):
    """A block's tiles behind each other: where each place begins and ends, and the values of all rows."""

    ranges: dict[int, slice]
    ids: np.ndarray
    weights: np.ndarray
    cores: np.ndarray
    x: np.ndarray


def _block(tiles: list[dict]) -> _Block:
    all_of = lambda name, kind: np.concatenate([np.frombuffer(t[name], kind) for t in tiles])
    ids = all_of("ids", "<i8")
    ends = np.cumsum([len(t["ids"]) // 8 for t in tiles]).tolist()
    ranges = {t["place"]: slice(a, b) for t, a, b in zip(tiles, [0, *ends], ends, strict=False)}
    return _Block(ranges, ids, all_of("weights", "<i8"), all_of("cores", "?"), all_of("x", "<f8").reshape(len(ids), -1))


def _met(batch: pa.RecordBatch) -> Iterator[tuple[bool, _Block, _Block, list[tuple[slice, slice]]]]:
    """Per meeting: whether a block meets itself, both blocks and the rows of the tiles that meet."""
    for i in range(batch.num_rows):
        one, two = _block(batch.column("tiles")[i].as_py()), _block(batch.column("tiles2")[i].as_py())
        yield batch.column("own")[i].as_py(), one, two, [(one.ranges[p["a"]], two.ranges[p["b"]]) for p in batch.column("pairs")[i].as_py()]


def _near_counts(meetings: DataFrame, radius: float) -> DataFrame:
    """point, near: the rows within ``radius``, itself and its copies included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, one, two, pairs in _met(batch):
                near, near2 = np.zeros(len(one.ids), np.int64), np.zeros(len(two.ids), np.int64)
                for a, b in pairs:
                    close = distances(one.x[a], two.x[b]) <= radius
                    near[a] += (close * two.weights[b]).sum(axis=1)
                    if not own or a != b:
                        near2[b] += (close * one.weights[a][:, None]).sum(axis=0)
                ids, counts = np.concatenate([one.ids, two.ids]), np.concatenate([near, near2])
                some = counts > 0
                yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(counts[some])], ["point", "near"])

    return meetings.mapInArrow(run, "point long, near long").groupBy("point").agg(F.sum("near").alias("near"))


def _forest(close: np.ndarray) -> tuple[list[int], list[int]]:
    """Edges (row, column) of a spanning forest of the bipartite graph of a boolean matrix."""
    rows, columns = [], []
    done, seen = ~close.any(axis=1), np.zeros(close.shape[1], bool)
    for start in range(len(close)):
        if done[start]:
            continue
        done[start], stack = True, [start]
        while stack:
            at = stack.pop()
            fresh = np.flatnonzero(close[at] & ~seen)
            if not len(fresh):
                continue
            seen[fresh] = True
            rows += [at] * len(fresh)
            columns += fresh.tolist()
            part = close[:, fresh]
            others = np.flatnonzero(part.any(axis=1) & ~done)
            done[others] = True
            rows += others.tolist()
            columns += fresh[part[others].argmax(axis=1)].tolist()
            stack += others.tolist()
    return rows, columns


class _Joined:
    """Which of the rows 0 to n - 1 are connected so far."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The places of the edges that connect what wasn't connected before."""
        fresh = []
        for i in np.flatnonzero(self.root[a] != self.root[b]).tolist():
            one, two = self._of(a[i]), self._of(b[i])
            if one != two:
                self.root[max(one, two)] = min(one, two)
                fresh.append(i)
        while fresh and not np.array_equal(up := self.root[self.root], self.root):
            self.root = up
        return np.array(fresh, np.int64)

    def _of(self, at: int) -> int:
        while self.root[at] != at:
            at = self.root[at]
        return at


def _nearest(away: np.ndarray, ids: np.ndarray, others: np.ndarray) -> list[np.ndarray]:
    """Per row of ``away``, where it has a finite entry: its id, the id of the nearest one (ties: the smaller id) and the distance."""
    least = away.min(axis=1, initial=np.inf)
    some = np.isfinite(least)
    largest = np.iinfo(np.int64).max
    first = np.where(away[some] == least[some][:, None], others, largest).min(axis=1, initial=largest)
    return [ids[some], first, least[some]]


def _links(meetings: DataFrame, radius: float) -> DataFrame:
    """point, other, away: forest edges between core points (away is NULL), and for other points the nearest core point of a tile within ``radius``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, one, two, pairs in _met(batch):
                joined, base = _Joined(len(one.ids) + len(two.ids)), 0 if own else len(one.ids)
                edges, border = [], [[np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]]
                for a, b in pairs:
                    away = distances(one.x[a], two.x[b])
                    close = away <= radius
                    if not close.any():
                        continue
                    cores, cores2 = one.cores[a], two.cores[b]
                    row, column = (np.array(e, np.int64) for e in _forest(close & cores[:, None] & cores2))
                    row, column = row + a.start, column + b.start
                    new = joined.add(row, column + base)
                    edges += [(one.ids[row[new]], two.ids[column[new]])]
                    border.append(_nearest(np.where(close[~cores][:, cores2], away[~cores][:, cores2], np.inf), one.ids[a][~cores], two.ids[b][cores2]))
                    if not own or a != b:
                        back, near = away[cores][:, ~cores2].T, close[cores][:, ~cores2].T
                        border.append(_nearest(np.where(near, back, np.inf), two.ids[b][~cores2], one.ids[a][cores]))
                rest = [np.concatenate(c) for c in zip(*border, strict=True)]
                first, second = (np.concatenate([e[k] for e in edges] + [np.zeros(0, np.int64)]) for k in (0, 1))
                gap = pa.concat_arrays([pa.nulls(len(first), pa.float64()), pa.array(rest[2])])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([first, rest[0]])), pa.array(np.concatenate([second, rest[1]])), gap], ["point", "other", "away"])

    return store(meetings.mapInArrow(run, "point long, other long, away double"), "density-links")


def connected(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) for every row of ``nodes`` (node): root is the smallest node that ``links`` (a, b) connect it with.

    In every round each node gives way to the member of its closed neighbourhood that comes first in a new pseudo-random order, so the number of
    nodes with links falls by a constant factor whatever the shape.
    """
    labels = store(nodes.select("node", F.col("node").alias("now")), "density-labels")
    edges = store(links.where("a <> b").select("a", "b").distinct(), "density-edges")
    turn = 0
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        order = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("h"), F.col(c).alias("n"))  # noqa: B023, E731
        ahead = both.groupBy("a").agg(F.least(F.min(order("b")), F.min(order("a"))).alias("m"))
        picks = store(ahead.select("a", F.col("m.n").alias("pick")), "density-picks")
        moved = labels.join(picks, labels["now"] == picks["a"], "left")
        labels = store(moved.select("node", F.coalesce("pick", "now").alias("now")), "density-labels")
        one = edges.join(picks.withColumnRenamed("pick", "pa"), "a")
        two = one.join(picks.select(F.col("a").alias("b"), F.col("pick").alias("pb")), "b").where("pa <> pb")
        edges = store(two.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "density-edges")
        turn += 1
    roots = labels.groupBy("now").agg(F.min("node").alias("root"))
    return spread_join(labels, roots, ["now"], "node", "inner").select("node", "root")


def density_clusters(points: DataFrame, radius: float, min_rows: int = 5, row_id: str = "row_id", vector: str = "embedding", pivots: int | None = None) -> DataFrame:
    """row_id, near (rows within ``radius``, itself included), core and cluster (the smallest id of a core row in it, or -1).

    row_id must be a unique integer.  Vectors must have one length; a row without one, or with a missing or non-finite entry, is an outlier with near 0.
    """
    spark = points.sparkSession
    importable(spark)
    v = vectors.doubles(F.col(vector))
    whole = F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    every = points.select(F.col(row_id).cast("long").alias("row"), F.when(whole, v).alias("v"))
    every = store(every.withColumn("key", F.when(F.col("v").isNotNull(), F.md5(F.concat_ws(",", F.col("v").cast("array<string>"))))), "density-rows")
    distinct = _points(every.where("v IS NOT NULL"))
    centers = _pivots(distinct, pivots)
    placed = _places(distinct, centers)
    counted = _near_counts(_meetings(placed.withColumn("core", F.lit(False)), centers, radius), radius)
    counts = store(counted.withColumn("core", F.col("near") >= min_rows), "density-counts")
    links = _links(_meetings(placed.join(counts.select("point", "core"), "point"), centers, radius), radius)
    cores = counts.where("core").select(F.col("point").alias("node"))
    roots = connected(cores, links.where("away IS NULL").select(F.col("point").alias("a"), F.col("other").alias("b")))
    nearest = links.where("away IS NOT NULL").groupBy("point").agg(F.min(F.struct("away", "other"))["other"].alias("node"))
    border = nearest.join(roots, "node").select("point", F.col("root").alias("cluster"))
    inside = roots.select(F.col("node").alias("point"), F.col("root").alias("cluster")).unionAll(border)
    known = reduce(lambda a, b: a.join(b, "point", "left"), [counts, inside], distinct.select("point", "key"))
    out = spread_join(every.select("row", "key"), known.drop("point"), ["key"], "row", "left")
    return out.select(
        F.col("row").alias(row_id), F.coalesce("near", F.lit(0)).alias("near"), F.coalesce("core", F.lit(False)).alias("core"),
        F.coalesce("cluster", F.lit(OUTLIER).cast("long")).alias("cluster"),
    )
