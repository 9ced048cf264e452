"""Embedding whitening by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the vectors' covariance V come from a block of trial vectors Q.  A cycle applies a Chebyshev polynomial of V to the block: its
three-term recurrence needs one product V Q a step, and each product is one pass over the distributed vectors, every task adding up Xᵀ(X Q) of its
centred rows.  On the unwanted part of the spectrum, an interval, the polynomial stays small, outside it grows fastest of all polynomials of its degree, so the block turns
to the leading eigenvectors.  Then the block is made orthonormal (QR), V is projected on it (Rayleigh-Ritz) and the wanted pairs' residuals are
looked at; cycles end when all are certified, that is as small as double precision allows.

The interval reaches from a lower bound of the spectrum, which a Lanczos process of one more vector gives that rides along in the same passes, to the
block's smallest Ritz value.  Every cycle draws the last vector of the block anew, so that a direction that the start missed still comes in.
Only the block (dimensions times BLOCK + 2 numbers) goes to the tasks and comes back; it doesn't grow with the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewgrain.llm.shared import Batches, store

COMPONENTS = 8
#: Trial vectors beside the wanted ones, recurrence steps of a cycle, and cycles at most.
EXTRA, DEGREE, CYCLES = 24, 8, 60
#: Largest residual of a certified pair, as a share of the largest eigenvalue; a residual that no cycle halves any more is at the limit of the arithmetic if it is below STALLED.
CERTIFIED, STALLED = 1e-14, 1e-12
#: Eigenvalues below this share of the trace belong to no component: the vectors don't extend in their direction.
FLAT = 1e-13
#: An entry c counts as floor(SCALE * c) + SHIFT; beyond LARGEST it counts as LARGEST.
SCALE, SHIFT, LARGEST = 1024, 100_000, 1 << 52
#: Rows and bytes of a tile, the unit in which vectors are stored for the passes.
TILE_ROWS, TILE_BYTES = 1024, 1 << 18
SEED = 42


class Shape(NamedTuple):
    """What all passes need: number of vectors, their length, sums per dimension (exact)."""

    n: int
    d: int
    sums: tuple[int, ...]

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


class Components(NamedTuple):
    """Eigenvalues by size, one unit vector a column for each, the trace of V, the passes made, and the largest residual's share of the largest eigenvalue."""

    values: np.ndarray
    vectors: np.ndarray
    trace: float
    passes: int
    residual: float


def whole_numbers(vectors: list[list[float]]) -> np.ndarray:
    """floor(SCALE * c) + SHIFT of every entry, as longs."""
    scaled = np.floor(np.asarray(vectors, np.float64) * SCALE) + SHIFT
    return np.clip(scaled, -LARGEST, LARGEST).astype(np.int64)


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """Rows (id, vector) whose vector isn't NULL or empty and holds neither NULL nor non-finite entries."""
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return rows.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, lambda c: F.coalesce(bad(c.cast("double")), F.lit(True))))


def tiles(rows: DataFrame) -> DataFrame:
    """Blocks of usable rows (id, vector), stored: ids, and the whole numbers in row order, 4 bytes each where these are enough."""
    schema = pa.schema([("d", pa.int32()), ("n", pa.int64()), ("ids", pa.list_(pa.int64())), ("x", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Batches(schema)
        for batch in batches:
            ids, vectors = batch.column("id"), batch.column("vector")
            lengths = np.asarray(vectors.value_lengths())
            for d in np.unique(lengths).tolist():
                mine = np.flatnonzero(lengths == d)
                step = max(1, min(TILE_ROWS, TILE_BYTES // (4 * d)))
                for at in range(0, len(mine), step):
                    part = pa.array(mine[at : at + step])
                    x = whole_numbers(vectors.take(part).flatten().to_numpy(zero_copy_only=False)).reshape(-1, d)
                    data = (x.astype("<i4") if np.abs(x).max() < 1 << 31 else x.astype("<i8")).tobytes()
                    yield from out.add((d, len(x), ids.take(part).to_pylist(), data), len(data))
        yield from out.flush()

    doubles = rows.select(F.col("id").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector"))
    return store(doubles.mapInArrow(run, "d int, n long, ids array<bigint>, x binary"), "tiles")


def _matrix(data: bytes, n: int, d: int) -> np.ndarray:
    return np.frombuffer(data, "<i4" if len(data) == 4 * n * d else "<i8").reshape(n, d)


def _each(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """Every tile of a batch: its number in the batch and its rows."""
    for i in range(batch.num_rows):
        yield i, _matrix(batch.column("x")[i].as_buffer(), batch.column("n")[i].as_py(), batch.column("d")[i].as_py())


def shape(stored: DataFrame) -> Shape | None:
    """The most frequent length (the largest of several), how many vectors have it, and their sums per dimension; None without vectors."""
    lengths = stored.groupBy("d").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if lengths is None:
        return None
    d, n = lengths["d"], lengths["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # whole numbers below 2**53 in rows of 2**10, kept in two halves, so that sums stay exact
        high, low = np.zeros(d, np.int64), np.zeros(d, np.int64)
        for batch in batches:
            for _, x in _each(batch):
                high += (x >> 20).sum(axis=0, dtype=np.int64)
                low += (x & 0xFFFFF).sum(axis=0, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), pa.array(high), pa.array(low)], ["j", "high", "low"])

    parts = stored.where(F.col("d") == d).select("d", "n", "x").mapInArrow(run, "j int, high long, low long")
    found = parts.groupBy("j").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]).orderBy("j").collect()
    return Shape(n, d, tuple((int(r["high"]) << 20) + int(r["low"]) for r in found))


def product(stored: DataFrame, of: Shape, block: np.ndarray) -> tuple[np.ndarray, float]:
    """V times a block of vectors, and the trace of V: one pass over the tiles, whose rows are centred first.

    Tasks hand on d rows of sums each, which Spark adds up; d times the block's width numbers come back.
    """
    d, mean, width = of.d, of.mean, block.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, squares = np.zeros((d, width)), np.zeros(d)
        for batch in batches:
            for _, x in _each(batch):
                centred = x - mean
                total += centred.T @ (centred @ block)
                squares += np.einsum("ij,ij->j", centred, centred)
        columns = [pa.array(np.arange(d, dtype=np.int32)), pa.array(squares), *(pa.array(np.ascontiguousarray(c)) for c in total.T)]
        yield pa.RecordBatch.from_arrays(columns, ["j", "s", *(f"q{k}" for k in range(width))])

    sums = ["s", *(f"q{k}" for k in range(width))]
    parts = stored.where(F.col("d") == d).select("d", "n", "x").mapInArrow(run, "j int, " + ", ".join(f"{c} double" for c in sums))
    found = np.array(sorted(tuple(r) for r in parts.groupBy("j").agg(*[F.sum(c).alias(c) for c in sums]).collect()))
    return found[:, 2:] / of.n, float(found[:, 1].sum() / of.n)


class Lanczos:
    """A Lanczos process one vector at a time, for a lower bound of a spectrum."""

    def __init__(self, start: np.ndarray):
        self.basis, self.diagonal, self.beside = [start / np.linalg.norm(start)], [], []
        self.ended = False

    @property
    def vector(self) -> np.ndarray:
        return self.basis[-1]

    def add(self, image: np.ndarray) -> None:
        """The product of V and ``vector``."""
        if self.ended:
            return
        self.diagonal.append(float(self.vector @ image))
        basis = np.array(self.basis)
        rest = image - basis.T @ (basis @ image)
        rest -= basis.T @ (basis @ rest)
        size = float(np.linalg.norm(rest))
        self.beside.append(size)
        self.ended = size <= 1e-10 * max(abs(x) for x in self.diagonal) or len(self.basis) == len(image)
        if not self.ended:
            self.basis.append(rest / size)

    def lower(self) -> float:
        """The smallest Ritz value less its residual; 0 before the first step."""
        if not self.diagonal:
            return 0.0
        off = self.beside[: len(self.diagonal) - 1]
        values, vectors = np.linalg.eigh(np.diag(self.diagonal) + np.diag(off, 1) + np.diag(off, -1))
        return max(0.0, float(values[0] - self.beside[-1] * abs(vectors[-1, 0])))


def leading(stored: DataFrame, of: Shape, components: int = COMPONENTS, extra: int = EXTRA, degree: int = DEGREE) -> Components:
    """The ``components`` leading eigenpairs of the covariance (divisor n), by Chebyshev-filtered subspace iteration.

    Eigenvalues that are equal get any orthonormal vectors of their space.  Fewer pairs come back where V has a smaller rank.
    """
    rng = np.random.default_rng(SEED)
    width = min(of.d, components + extra)
    wanted = min(components, width)
    passes = 0
    lanczos = Lanczos(rng.standard_normal(of.d))

    def times(block: np.ndarray) -> tuple[np.ndarray, float]:
        nonlocal passes
        passes += 1
        images, trace = product(stored, of, np.column_stack((block, lanczos.vector)))
        lanczos.add(images[:, -1])
        return images[:, :-1], trace

    block = np.linalg.qr(rng.standard_normal((of.d, width)))[0]
    images, trace = times(block)
    worst = np.inf
    for cycle in range(CYCLES):
        block, images, values = _ritz(block, images)
        residuals = np.linalg.norm(images[:, :wanted] - block[:, :wanted] * values[:wanted], axis=0)
        top, before = max(float(values[0]), 0.0), worst
        worst = float(residuals.max() / top) if top > 0 else 0.0
        # one cycle more than needed for the vector drawn last, so that it has been filtered too
        if cycle and (worst <= CERTIFIED or worst <= STALLED and worst > before / 2):
            break
        low, high = min(lanczos.lower(), max(float(values[-1]), 0.0)), max(float(values[-1]), 0.0)
        if width == of.d or high - low <= 1e-14 * top:
            low = 0.0
        block = _filtered(times, block, images, low, high, top, degree)
        block[:, -1] = rng.standard_normal(of.d)
        block = np.linalg.qr(block)[0]
        images, _ = times(block)
    found = int(np.sum(values[:wanted] > FLAT * trace)) if trace > 0 else 0
    return Components(values[:found], block[:, :found], trace, passes, worst)


def _ritz(block: np.ndarray, images: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rayleigh-Ritz: the block and its products turned to the Ritz vectors, and the Ritz values, largest first."""
    small = block.T @ images
    values, turn = np.linalg.eigh((small + small.T) / 2)
    turn = turn[:, ::-1]
    return block @ turn, images @ turn, values[::-1]


def _filtered(times, block: np.ndarray, images: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial that is small on [low, high], of V, times the block whose product is ``images``; scaled to 1 at ``top``."""
    centre, half = (high + low) / 2, max((high - low) / 2, 1e-300)
    if top <= 0 or half <= 1e-14 * top:
        return images if top > 0 else block
    scale = half / max(top - centre, half)
    first = scale
    now, last = (images - centre * block) * (scale / half), block
    for _ in range(degree - 1):
        following = 1.0 / (2.0 / first - scale)
        product_now, _ = times(now)
        now, last, scale = (product_now - centre * now) * (2 * following / half) - (scale * following) * last, now, following
    return now


def whitened(rows: DataFrame, vector: str = "embedding", id: str = "vec_id", components: int = COMPONENTS) -> tuple[DataFrame, Components | None]:
    """Every usable row's coordinates on the leading components, each scaled to variance 1, and the components.

    Returns id, component (from 1), n (long), deviation (decimal(38,0): the sum over dimensions of (n * x - S)**2, exact), whitened, explained (share of the trace) and
    identity_error (largest entry of the covariance of whitened less the identity, measured in a pass of its own).  An entry c
    counts as x = floor(1024 * c) + 100000, at most 2**52 either way.  Left out: rows whose vector is NULL, empty or holds a NULL or non-finite entry, and vectors of another length than the most frequent
    one.  Directions without variance are no components, so equal vectors, a single one and an empty table give no rows.
    Repeated rows and NULL ids stay; other columns are not read.
    """
    kind = rows.schema[id].dataType.simpleString()
    result = "id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    plain = rows.select(F.col(f"`{id}`").alias("id"), F.col(f"`{vector}`").alias("vector"))
    stored = tiles(usable(plain, "vector"))
    of = shape(stored)
    found = leading(stored, of, components) if of else None
    if found is None or not len(found.values):
        empty = rows.sparkSession.createDataFrame([], result)
        return empty.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id), found
    error = _identity_error(stored, of, found)
    mine = stored.where(F.col("d") == of.d)
    project, mean, shares, squares = found.vectors / np.sqrt(found.values), of.mean, found.values / found.trace, sum(s * s for s in of.sums)
    schema = pa.schema(
        [("id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.decimal128(38, 0)), ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = len(shares)
        for batch in batches:
            for i, x in _each(batch):
                values = (x - mean) @ project
                deviation = [Decimal(v) for v in _deviations(x, of, squares)]
                ids = batch.column("ids")[i].values
                times = np.repeat(np.arange(len(x)), number)
                columns = [
                    ids.take(pa.array(times)), np.tile(np.arange(1, number + 1, dtype=np.int32), len(x)), np.full(len(times), of.n),
                    pa.array(deviation, pa.decimal128(38, 0)).take(pa.array(times)), values.ravel(), np.tile(shares, len(x)), np.full(len(times), error),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    out = mine.mapInArrow(run, result)
    return out.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id), found


def _deviations(x: np.ndarray, of: Shape, squares: int) -> list[int]:
    """sum((n * x - S)**2) of every row, exact: n**2 sum(x**2) - 2 n sum(x S) + sum(S**2), whatever the size of n."""
    if np.abs(x).max(initial=0) >= 1 << 24:
        return [sum((of.n * v - s) ** 2 for v, s in zip(row, of.sums, strict=True)) for row in x.tolist()]
    wide = x.astype(np.int64)
    own = np.einsum("ij,ij->i", wide, wide).tolist()
    cross, limbs = [0] * len(x), max(abs(s) for s in of.sums).bit_length() // 24
    for k in range(limbs + 1):  # the sums in pieces of 24 bits, the last one with the sign
        part = np.array([s >> 24 * k & 0xFFFFFF if k < limbs else s >> 24 * k for s in of.sums], np.int64)
        cross = [c + (v << 24 * k) for c, v in zip(cross, (wide @ part).tolist(), strict=True)]
    return [of.n * of.n * a - 2 * of.n * b + squares for a, b in zip(own, cross, strict=True)]


def _identity_error(stored: DataFrame, of: Shape, found: Components) -> float:
    """The largest absolute entry of the covariance of the whitened rows less the identity, from one pass over them."""
    project, mean, number = found.vectors / np.sqrt(found.values), of.mean, len(found.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, squares = np.zeros(number), np.zeros((number, number))
        for batch in batches:
            for _, x in _each(batch):
                values = (x - mean) @ project
                sums += values.sum(axis=0)
                squares += values.T @ values
        j = np.arange(number, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(j, number)), pa.array(np.tile(j, number)), pa.array(squares.ravel()), pa.array(np.repeat(sums, number))], ["i", "j", "v", "s"])

    parts = stored.where(F.col("d") == of.d).select("d", "n", "x").mapInArrow(run, "i int, j int, v double, s double")
    rows = parts.groupBy("i", "j").agg(F.sum("v").alias("v"), F.sum("s").alias("s")).orderBy("i", "j").collect()
    sums = np.array([r["s"] for r in rows]).reshape(number, number)[:, 0] / of.n
    matrix = np.array([r["v"] for r in rows]).reshape(number, number) / of.n - np.outer(sums, sums)
    return float(np.abs(matrix - np.eye(number)).max())
