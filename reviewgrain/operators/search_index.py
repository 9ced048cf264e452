"""An index for exact nearest-neighbour search by cosine, for many queries at once.

Vectors of length 1 lie in cells, each around a pivot (the nearest of a bounded sample of rows); a cell keeps its radius, the largest distance of a
member from the pivot.  By the triangle inequality no member of a cell is nearer to a query than the query's distance from the pivot less
the radius.  A query first looks into the nearest cells that together hold enough rows; the last distance found there rules out all cells whose bound
is larger, and the rest is looked into.  So results are those of the full scan, ties included.

Queries stand in tiles and rows in packs, a task compares a tile with a pack by matrix products; rows near enough to a query's best ones are compared again
as ``vectors.cosine`` does, and only a query's best rows of a pack leave the task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from reviewgrain.functions import vectors
from reviewgrain.operators.scaling import importable, store

#: Pivots at most; a sample of so many rows is sent to the tasks.
PIVOTS = 1024
#: Distances are computed in doubles; bounds give way by this much.
SLACK = 1e-6
#: Rows and bytes of a pack, queries of a tile, and pairs compared again at once.
PACK_ROWS, PACK_BYTES, TILE_ROWS, AGAIN = 4096, 2 << 20, 512, 65_536
#: Similarities from matrix products are right to this much, for vectors whose lengths are within these bounds.
NEAR, LENGTHS = 1e-9, (1e-100, 1e100)
#: Copies of a pack, so that tiles of queries that look into it are in several tasks; pairs of both that a task compares, and tasks at most.
SLICES, TOGETHER, TASKS = 4, 8, 2000
#: The cell of vectors that are all zero, which every query looks into.
ZERO = -1


class Index(NamedTuple):
    """Stored rows (key, vector, cell), the same in packs, cells (number, rows, radius), and the pivots."""

    rows: DataFrame
    packs: DataFrame
    cells: list[tuple[int, int, float]]
    pivots: np.ndarray
    key: str
    vector: str


def _units(column: pa.Array) -> np.ndarray:
    """Vectors of equal length as rows of length 1; a zero vector stays zero."""
    x = np.array(column.to_pylist(), np.float64) if len(column) else np.zeros((0, 1))
    length = np.sqrt((x * x).sum(axis=1))
    return x / np.where(length > 0, length, 1.0)[:, None]


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * (x @ pivots.T)
    return np.sqrt(np.maximum(squares, 0.0))


def build(documents: DataFrame, key: str = "doc_id", vector: str = "embedding", pivots: int | None = None) -> Index:
    """Every row with a vector in its cell.  Vectors must have one length; rows without one are left out.

    pivots: how many, by default the square root of the number of rows, PIVOTS at most; chosen by a digest of the key.
    """
    spark = documents.sparkSession
    importable(spark)
    known = documents.where(F.col(vector).isNotNull() & (F.size(vector) > 0))
    wanted = min(PIVOTS, max(1, math.isqrt(known.count()))) if pivots is None else pivots
    chosen = known.orderBy(F.xxhash64(F.col(key).cast("string")), key).select(vectors.doubles(F.col(vector)).alias("v")).limit(wanted).collect()
    x = _units(pa.array([r["v"] for r in chosen], pa.list_(pa.float64())))
    x = x[(x != 0).any(axis=1)] if len(x) else x
    names = documents.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _units(batch.column(vector))
            cell, reach = np.full(len(rows), ZERO, np.int32), np.zeros(len(rows))
            real = np.flatnonzero((rows != 0).any(axis=1))
            if len(x) and len(real):
                away = _distances(rows[real], x)
                cell[real] = away.argmin(axis=1)
                reach[real] = away.min(axis=1)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(cell), pa.array(reach)], [*names, "cell", "reach"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema.fields)
    placed = known.mapInArrow(run, f"{schema}, cell int, reach double")
    stored = store(placed, "search-index")
    cells = stored.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("reach").alias("radius")).orderBy("cell").collect()  # PIVOTS + 1 rows at most
    return Index(stored, _packs(stored, key, vector), [tuple(c) for c in cells], x, key, vector)


def _packs(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """Stored packs of rows that follow each other by cell and key: pack, cells, ends (of the cells in the pack), keys, d, x, nulls (rows with a missing entry)."""
    kind = rows.schema[key].dataType
    schema = to_arrow_schema(T.StructType([T.StructField("keys", T.ArrayType(kind))]))
    schema = pa.schema([("cells", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), schema.field("keys"), ("d", pa.int32()), ("x", pa.binary()), ("nulls", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: list[tuple] = []

        def pack() -> pa.RecordBatch:
            keys, v, cells = zip(*have, strict=True)
            x = np.array(v, "<f8").reshape(len(v), -1)
            numbers, starts = np.unique(np.array(cells, np.int32), return_index=True)
            ends = [*starts[1:].tolist(), len(cells)]
            values = numbers.tolist(), ends, list(keys), x.shape[1], x.tobytes(), np.array([None in r for r in v], "?").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(values, schema, strict=True)], schema=schema)

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in (key, vector, "cell")), strict=True):
                if have and len(have) >= max(1, min(PACK_ROWS, PACK_BYTES // (8 * max(1, len(row[1]))))):
                    yield pack()
                    have = []
                have.append(row)
        if have:
            yield pack()

    spread = rows.select(key, vector, "cell").repartitionByRange("cell", key).sortWithinPartitions("cell", key)
    made = spread.mapInArrow(run, f"cells array<int>, ends array<int>, keys array<{kind.simpleString()}>, d int, x binary, nulls binary")
    return store(made.withColumn("pack", F.monotonically_increasing_id()), "search-packs")


def _tiles(index: Index, queries: DataFrame, limit: bool, top_k: int) -> DataFrame:
    """Stored tiles of queries (query, _v) with the cells they must look into: tile, queries, looked (rows in a query's cells), v, missing, cells, askers (places of the queries by cell).

    Without limit the nearest cells that hold ``top_k`` rows together; with it those besides that can hold a row as near as the column ``_limit``.
    """
    numbers = np.array([c for c, _, _ in index.cells], np.int64)
    sizes, radius = np.array([n for _, n, _ in index.cells], np.int64), np.array([r for _, _, r in index.cells])
    real, pivots = numbers != ZERO, index.pivots
    kind = queries.schema["query"].dataType
    schema = to_arrow_schema(T.StructType([T.StructField("queries", T.ArrayType(kind))]))
    schema = pa.schema(
        [schema.field("queries"), ("looked", pa.list_(pa.int64())), ("v", pa.binary()), ("missing", pa.binary()), ("cells", pa.list_(pa.int32())), ("askers", pa.list_(pa.binary()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, TILE_ROWS):
                batch = whole.slice(at, TILE_ROWS)
                v = batch.column("_v").to_pylist()
                x = _units(batch.column("_v"))
                away = np.zeros((len(x), len(numbers)))
                if len(x) and len(pivots):
                    away[:, real] = _distances(x, pivots)[:, numbers[real]]
                away[~(x != 0).any(axis=1)] = 0.0  # a zero vector is equally near to all
                asks = np.zeros(away.shape, bool)
                limits = batch.column("_limit").to_numpy(zero_copy_only=False) if limit else None
                for i in range(len(x)):
                    order = np.lexsort((numbers, away[i]))
                    first = order[: int(np.searchsorted(np.cumsum(sizes[order]), top_k)) + 1]
                    if limit:
                        low = np.where(real & (away[i] > 0), away[i] - radius, 0.0)
                        near = low <= limits[i] + SLACK if np.any(x[i] != 0) else np.ones(len(low), bool)
                        near[first] = False
                        first = np.flatnonzero(near)
                    asks[i, first] = True
                asked = np.flatnonzero(asks.any(axis=0))
                values = [
                    batch.column("query").to_pylist(), (asks @ sizes).tolist(), np.array(v, "<f8").tobytes(), np.array([None in r for r in v], "?").tobytes(),
                    numbers[asked].tolist(), [np.flatnonzero(asks[:, c]).astype("<i4").tobytes() for c in asked],
                ]
                yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(values, schema, strict=True)], schema=schema)

    columns = ["query", "_v", *(["_limit"] if limit else [])]
    made = queries.select(*columns).mapInArrow(run, f"queries array<{kind.simpleString()}>, looked array<long>, v binary, missing binary, cells array<int>, askers array<binary>")
    return store(made.withColumn("tile", F.monotonically_increasing_id()), "query-tiles")


def _odd(x: np.ndarray) -> np.ndarray:
    """Rows whose similarities need the plain way: with other than finite entries, or of extreme length."""
    length = np.sqrt((x * x).sum(axis=1))
    return (x != 0).any(axis=1) & ~((length > LENGTHS[0]) & (length < LENGTHS[1]))


def _cosines(a: np.ndarray, b: np.ndarray, missing: np.ndarray) -> np.ndarray:
    """``vectors.cosine`` of rows of ``a`` and ``b``, with its order of additions, so equal in every digit."""
    with np.errstate(all="ignore"):
        dot, one, two = (np.zeros(len(a)) for _ in range(3))
        for x, y in zip(a.T, b.T, strict=True):
            dot, one, two = dot + x * y, one + x * x, two + y * y
        size = np.sqrt(one) * np.sqrt(two)
        return np.where(((size > 0) | np.isnan(size)) & ~missing, dot / size, 0.0)


def _places_in(*groups: np.ndarray) -> np.ndarray:
    """The place of every row, from 0, in its run of equal values."""
    if not len(groups[0]):
        return np.zeros(0, np.int64)
    new = np.ones(len(groups[0]), bool)
    new[1:] = np.any([g[1:] != g[:-1] for g in groups], axis=0)
    at = np.arange(len(new))
    return at - np.maximum.accumulate(np.where(new, at, 0))


def _best(x: np.ndarray, missing: np.ndarray, rows: np.ndarray, nulls: np.ndarray, cell: np.ndarray, asks: np.ndarray, top_k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of queries and rows, and similarities, of at least the ``top_k`` nearest rows of every query that are asked for; rows of a cell are in key order.

    More than ``top_k`` are given where cells tie, as their keys are not compared here.
    """
    odd, odd2 = _odd(x) | missing, _odd(rows) | nulls
    unit = lambda v, o: np.where(o[:, None], 0.0, v / np.where((n := np.sqrt((v * v).sum(axis=1))) > 0, n, 1.0)[:, None])
    with np.errstate(all="ignore"):
        plain = asks & ~odd[:, None] & ~odd2
        near = np.where(plain, unit(x, odd) @ unit(rows, odd2).T, -np.inf)
    k = min(top_k, near.shape[1])
    least = np.partition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k]
    q, r = np.nonzero((plain & (near >= least[:, None] - NEAR)) | (asks & ~plain))
    parts = [_cosines(rows[r[i : i + AGAIN]], x[q[i : i + AGAIN]], missing[q[i : i + AGAIN]] | nulls[r[i : i + AGAIN]]) for i in range(0, len(q), AGAIN)]
    similar = np.concatenate([np.zeros(0), *parts])
    low = np.where(np.isnan(similar), -np.inf, -similar)  # as Spark sorts, NaN is the largest
    order = np.lexsort((r, low, cell[r], q))
    q, r, similar, low = (v[order][_places_in(q[order], cell[r[order]]) < top_k] for v in (q, r, similar, low))
    order = np.lexsort((low, q))
    q, r, similar, low = (v[order] for v in (q, r, similar, low))
    last = np.full(len(x), np.inf)
    ends = _places_in(q) == top_k - 1
    last[q[ends]] = low[ends]
    keep = low <= last[q]
    return q[keep], r[keep], similar[keep]


def _compared(index: Index, tiles: DataFrame, top_k: int) -> DataFrame:
    """query, the index's key and similarity: of every tile and pack the best rows of every query in the cells it looks into."""
    found = tiles.select("tile", F.explode("cells").alias("cell")).join(index.packs.select("pack", F.explode("cells").alias("cell")), "cell").select("tile", "pack").distinct()
    found = store(found.withColumn("slice", F.pmod(F.xxhash64("tile"), F.lit(SLICES)).cast("int")), "search-meetings")
    tasks = max(3 * tiles.sparkSession.sparkContext.defaultParallelism, min(TASKS, found.count() // TOGETHER))
    asking = tiles.select("tile", "queries", "v", "missing", F.col("cells").alias("asked"), "askers")
    left = found.join(asking, "tile").drop("tile").repartition(tasks, "pack", "slice")
    right = index.packs.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1)))).repartition(tasks, "pack", "slice")
    pairs = left.join(right.hint("merge"), ["pack", "slice"])
    fields = T.StructType([T.StructField("query", tiles.schema["queries"].dataType.elementType), T.StructField(index.key, index.rows.schema[index.key].dataType), T.StructField("similarity", T.DoubleType())])
    schema = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pair = {c: batch.column(c)[i] for c in ("queries", "v", "missing", "asked", "askers", "cells", "ends", "keys", "d", "x", "nulls")}
                read = lambda name, kind: np.frombuffer(pair[name].as_buffer(), kind)  # noqa: B023, E731
                d, ends, asked = pair["d"].as_py(), pair["ends"].as_py(), dict(zip(pair["asked"].as_py(), pair["askers"].as_py(), strict=True))
                x, rows, nulls = read("v", "<f8").reshape(-1, d), read("x", "<f8").reshape(-1, d), read("nulls", "?")
                cell = np.repeat(pair["cells"].values.to_numpy(), np.diff([0, *ends]))
                asks = np.zeros((len(x), len(rows)), bool)
                for number, start, end in zip(pair["cells"].as_py(), [0, *ends], ends, strict=False):
                    if number in asked:
                        asks[np.frombuffer(asked[number], "<i4"), start:end] = True
                some, wanted = np.flatnonzero(asks.any(axis=1)), np.flatnonzero(asks.any(axis=0))
                q, r, similar = _best(x[some], read("missing", "?")[some], rows[wanted], nulls[wanted], cell[wanted], asks[some][:, wanted], top_k)
                columns = pair["queries"].values.take(pa.array(some[q])), pair["keys"].values.take(pa.array(wanted[r])), pa.array(similar)
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return pairs.mapInArrow(run, fields)


def search_many(index: Index, queries: DataFrame, top_k: int = 5, key: str | None = None, vector: str | None = None) -> DataFrame:
    """query, the index's key, similarity, place (from 1) and compared: the ``top_k`` rows nearest to every query row, ties by key, and with how many rows it was compared.

    A query without a vector has no result; one that is all zero is equally similar, 0, to all rows.
    A query's rows are cut to ``top_k`` in the tasks that compare them.
    """
    asked = queries.where(F.col(vector or index.vector).isNotNull()).select(
        F.col(key or index.key).alias("query"), vectors.doubles(F.col(vector or index.vector)).alias("_v")
    )
    asked = store(asked.where("size(_v) > 0").dropDuplicates(["query"]), "queries")
    order = Window.partitionBy("query").orderBy(F.desc("similarity"), index.key)
    cut = lambda rows: rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top_k)
    first_tiles = _tiles(index, asked, False, top_k)
    first = store(cut(_compared(index, first_tiles, top_k)), "first-found")
    away = F.sqrt(F.greatest(2 - 2 * F.min("similarity"), F.lit(0.0)))
    last = first.groupBy("query").agg(F.when(F.count(F.lit(1)) >= top_k, away).otherwise(float("inf")).alias("_limit"))
    more_tiles = _tiles(index, asked.join(last, "query"), True, top_k)
    both = first.drop("place").unionByName(_compared(index, more_tiles, top_k))
    counts = first_tiles.unionByName(more_tiles).select(F.explode(F.arrays_zip("queries", "looked")).alias("q"))
    looked = counts.groupBy(F.col("q.queries").alias("query")).agg(F.sum("q.looked").alias("compared"))
    return cut(both).join(looked, "query")
