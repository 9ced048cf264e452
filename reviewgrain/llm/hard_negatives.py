"""Hard-negative mining by L2AP-style threshold joins.

Anchors are searched for their nearest rows of the same label (positives), then for rows of another label that score nearly as high as a positive (hard
negatives).  Both are threshold joins: all rows whose inner product with the anchor reaches the anchor's threshold.  Rows stand in tiles; in a task each tile becomes an inverted index:

* dimensions are ordered so that those in which the anchors are weak come first; a row's leading dimensions are left out of the index as long as the norms of
  that part, its own and the anchors', bound the product below every threshold; rows for which this holds to the end are in no list;
* partial scores are added up list by list, strong dimensions first; a pair is out once its partial score plus the product of
  the remaining norms is below the anchor's threshold, and rows that no anchor wants any more leave the lists;
* when few pairs are left, or the lists end, each gets the rest of its product, also from the part that the index leaves out, checked against the remaining norms in the same way.

Thresholds start high and are lowered, for the anchors whose windows aren't full, until they are or the window ends.  A window takes WANTED rows, and
every tile hands on no more for each, so that copies can't make results large.  Anchors are taken in blocks of bounded size, each against all tiles.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewgrain.llm.shared import Batches, numbered, store
from reviewgrain.llm.whitening import usable

#: Positives of an anchor, negatives of a positive, and the share of the positive's score, in hundredths, that a negative's must reach.
POSITIVES, NEGATIVES, LOWEST = 5, 5, 80
#: A component x counts as floor(SCALE * x), at most LARGEST either way.
SCALE, LARGEST = 256, 1 << 28
#: Rows and bytes of a tile; anchors and bytes of a block, which goes to all tasks; anchors that a tile is compared with at once.
ROW_BITS = 11
TILE_ROWS, TILE_BYTES = 1 << ROW_BITS, 1 << 19
BLOCK_ANCHORS, BLOCK_BYTES, AT_ONCE = 8192, 16_000_000, 128
#: Dimensions between two looks at the remaining norms.
LIST_STEP = 8
#: Once at most one pair in so many is left, pairs are followed one by one.
FEW_PAIRS = 8
#: Rows that the first threshold should let through, by the scores among the anchors; shares of a positive's score at which negatives are looked for in turn.
HOPED, SHARES = 16, (96, 90)
NEVER = np.iinfo(np.int64).min


class Anchors(NamedTuple):
    """A block of anchors: row numbers (tile << ROW_BITS | place), ids, labels and vectors of whole numbers."""

    row: np.ndarray
    id: np.ndarray
    label: np.ndarray
    x: np.ndarray


def whole_numbers(values: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(np.asarray(values, np.float64) * SCALE), -LARGEST, LARGEST).astype(np.int64)


def tiles(rows: DataFrame) -> DataFrame:
    """Blocks of rows (id, label, anchor, vector), stored: tile, d, n, and in row order ids, labels, whether they are anchors, and vectors."""
    schema = pa.schema([("d", pa.int32()), ("n", pa.int64()), ("ids", pa.binary()), ("labels", pa.binary()), ("asked", pa.binary()), ("x", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Batches(schema)
        for batch in batches:
            ids, labels = (batch.column(c).to_numpy(zero_copy_only=False).astype("<i8") for c in ("id", "label"))
            vectors, asked = batch.column("vector"), batch.column("anchor").to_numpy(zero_copy_only=False).astype(np.uint8)
            lengths = np.asarray(vectors.value_lengths())
            for d in np.unique(lengths).tolist():
                mine = np.flatnonzero(lengths == d)
                step = max(1, min(TILE_ROWS, TILE_BYTES // (4 * d)))
                for at in range(0, len(mine), step):
                    part = mine[at : at + step]
                    x = whole_numbers(vectors.take(pa.array(part)).flatten().to_numpy(zero_copy_only=False))
                    yield from out.add((d, len(part), ids[part].tobytes(), labels[part].tobytes(), asked[part].tobytes(), x.astype("<i4").tobytes()), 4 * len(x))
        yield from out.flush()

    made = rows.mapInArrow(run, "d int, n long, ids binary, labels binary, asked binary, x binary")
    # stored, so that the numbers stay
    return store(made.withColumn("tile", F.monotonically_increasing_id()), "tiles")


def _each(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Every tile of a batch: its number, and its ids, labels and vectors."""
    for i in range(batch.num_rows):
        n, d = batch.column("n")[i].as_py(), batch.column("d")[i].as_py()
        ids, labels = (np.frombuffer(batch.column(c)[i].as_buffer(), "<i8") for c in ("ids", "labels"))
        yield batch.column("tile")[i].as_py(), ids, labels, np.frombuffer(batch.column("x")[i].as_buffer(), "<i4").reshape(n, d)


# one tile against anchors


def survivors(anchors: np.ndarray, thresholds: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs (anchor, row) whose inner product is at least the anchor's threshold, and the products.

    Exact: whole numbers below 2**53 are added up as doubles, larger ones as longs.
    """
    if not len(anchors) or not len(rows):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    d = anchors.shape[1]
    order = np.argsort((anchors.astype(np.float64) ** 2).sum(axis=0), kind="stable")
    largest = float(np.abs(anchors).max()) * float(np.abs(rows).max()) * d
    kind = np.float64 if largest < 2**53 else np.int64
    a, x = anchors[:, order].astype(kind), rows[:, order].astype(kind)
    # norms of the first 0 .. d dimensions, rounded up, so that bounds hold
    norm = lambda m: np.sqrt(np.concatenate((np.zeros((1, len(m))), np.cumsum(m.T.astype(np.float64) ** 2, axis=0)))) * (1 + 1e-12)
    a_norm, x_norm = norm(a), norm(x)
    limit = thresholds.astype(np.float64)
    # for each number of leading dimensions the row norm below which no anchor reaches its threshold with these dimensions alone
    with np.errstate(divide="ignore", invalid="ignore"):
        room = np.where(limit > 0, np.where(a_norm > 0, limit / a_norm, np.inf), -np.inf).min(axis=1)
    outside = (x_norm < room[:, None]).sum(axis=0) - 1  # norms grow and room shrinks, so these are the first ones
    outside = np.maximum(outside, 0)
    listed = np.flatnonzero(outside < d)
    if not len(listed):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    listed = listed[np.argsort(outside[listed], kind="stable")]  # rows of a list stand side by side
    x, x_norm, outside = x[listed], x_norm[:, listed], outside[listed]
    partial, anchor = np.zeros((len(a), len(listed)), kind), np.arange(len(a))[:, None]
    for down in (*range(d - LIST_STEP, 0, -LIST_STEP), 0):
        upto = min(d, down + LIST_STEP) if down else (d - 1) % LIST_STEP + 1
        inside = int(np.searchsorted(outside, upto, "left"))  # rows with a dimension of this step in the index
        step = x[:inside, down:upto]
        if inside and outside[inside - 1] > down:  # some rows leave out the first dimensions of the step
            step = np.where(np.arange(down, upto) >= outside[:inside, None], step, 0)
        partial[:, :inside] += a[:, down:upto] @ step.T
        # what is left of a row: all dimensions below the step, or those outside the index where it ends earlier
        left = np.maximum(down, outside)
        wanted = partial + a_norm[left[None, :], anchor] * x_norm[left, np.arange(len(x))] >= limit[:, None] - 0.5
        pairs = int(wanted.sum())
        if down == 0 or inside == 0 or pairs * FEW_PAIRS <= wanted.size:
            break
        needed = wanted.any(axis=0)
        if 4 * int(needed.sum()) <= 3 * len(needed):
            x, x_norm, outside, listed, partial = x[needed], x_norm[:, needed], outside[needed], listed[needed], partial[:, needed]
    i, j = np.nonzero(wanted)
    score, rest = partial[i, j], left[j]
    # pair by pair, what is left of the product, again from the strong dimensions down
    for down in range((int(rest.max(initial=0)) - 1) // LIST_STEP * LIST_STEP, -1, -LIST_STEP):
        inside = np.flatnonzero(rest > down)
        upto = min(d, down + LIST_STEP)
        part = np.where(np.arange(down, upto) < rest[inside, None], x[j[inside], down:upto], 0)
        score[inside] += np.einsum("kd,kd->k", a[i[inside], down:upto], part)
        rest = np.minimum(rest, down)
        good = score + a_norm[rest, i] * x_norm[rest, j] >= limit[i] - 0.5
        i, j, score, rest = i[good], j[good], score[good], rest[good]
    exact = score.astype(np.int64)
    good = exact >= thresholds[i]
    return i[good], listed[j[good]], exact[good]


def firsts(group: np.ndarray, score: np.ndarray, id: np.ndarray, most: int) -> np.ndarray:
    """The positions of the first ``most`` rows of every group: higher scores first, ties by smaller id."""
    order = np.lexsort((id, -score, group))
    sorted_group = group[order]
    new = np.concatenate(([True], sorted_group[1:] != sorted_group[:-1])) if len(order) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - start < most]


# rounds over all tiles


def _search(stored: DataFrame, anchors: Anchors, thresholds: np.ndarray, windows: list[tuple] | None, most: int, label: str) -> DataFrame:
    """The best rows of every window among all tiles, stored: anchor (place in the block), window, id, score, place (from 1).

    windows: per anchor the score ranges (window, from, to) in which rows of another label are looked for; None: one window of the
    rows with the anchor's label and any score.  Only anchors with a threshold other than NEVER - 1 are searched for.
    """
    searched = np.flatnonzero(thresholds != SETTLED)
    d = anchors.x.shape[1]
    schema = pa.schema([("anchor", pa.int32()), ("window", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tile, ids, labels, x in _each(batch):
                for at in range(0, len(searched), AT_ONCE):
                    part = searched[at : at + AT_ONCE]
                    i, j, score = survivors(anchors.x[part], thresholds[part], x)
                    i = part[i]
                    same = labels[j] == anchors.label[i]
                    if windows is None:
                        good = np.flatnonzero(same & (anchors.row[i] != (tile << ROW_BITS) + j))
                        found = [(np.zeros(len(good), np.int64), good)]
                    else:
                        good = np.flatnonzero(~same)
                        found = [(np.full(len(k), w), k) for w, low, high in windows if len(k := good[(score[good] >= low[i[good]]) & (score[good] <= high[i[good]])])]
                    if not found:
                        continue
                    w, k = (np.concatenate(c) for c in zip(*found, strict=True))
                    first = firsts(i[k] * 64 + w, score[k], ids[j[k]], most)
                    w, k = w[first], k[first]
                    if len(k):
                        columns = [i[k].astype(np.int32), w.astype(np.int32), ids[j[k]], score[k]]
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    mine = stored.where(F.col("d") == d).select("tile", "d", "n", "ids", "labels", "x")
    best = mine.mapInArrow(run, "anchor int, window int, id long, score long")
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id")
    return store(best.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most), label)


#: The threshold of an anchor that isn't searched for.
SETTLED = NEVER + 1


def _first_thresholds(anchors: Anchors, rows_per_label: dict[int, int], wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Two thresholds per anchor for its positives: one that about HOPED rows reach by the mean and spread of its scores with anchors of its
    label, and one that ``wanted`` of those anchors reach, so that it is sure.  NEVER where too few anchors have the label."""
    hoped, sure = np.full(len(anchors.id), NEVER), np.full(len(anchors.id), NEVER)
    x = anchors.x.astype(np.float64)
    for label in np.unique(anchors.label).tolist():
        mine = np.flatnonzero(anchors.label == label)
        if len(mine) <= wanted:
            continue
        away = NormalDist().inv_cdf(max(0.5, 1 - HOPED / max(rows_per_label.get(label, 1), 2 * HOPED)))
        for at in range(0, len(mine), 1024):
            part = mine[at : at + 1024]
            scores = x[part] @ x[mine].T
            scores[np.arange(len(part)), np.arange(at, at + len(part))] = np.nan
            sure[part] = -np.sort(-np.where(np.isnan(scores), -np.inf, scores), axis=1)[:, wanted - 1].astype(np.int64)
            hoped[part] = np.floor(np.nanmean(scores, axis=1) + away * np.nanstd(scores, axis=1)).astype(np.int64)
    return np.maximum(hoped, sure), sure


def _lowered(windows: np.ndarray, low: np.ndarray, share: int | None) -> np.ndarray:
    """Where a window (its highest score) is cut this time, at least ``low``."""
    return low if share is None else np.maximum(low, -(-share * windows // 100))


def mine(
    rows: DataFrame, anchor: Column, vector: str = "embedding", id: str = "vec_id", label: str = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES, lowest: int = LOWEST,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of every anchor's hard negatives.

    Rows score by the inner product with the anchor, components counting as floor(256 * x); higher scores come first, ties by smaller id.  An anchor's
    positives are its first ``positives`` other rows of the same label, all if there are fewer; for each of them the first ``negatives`` rows of other labels come back, all if
    fewer, whose score is at most the positive's and at least ``lowest`` hundredths of it; a negative score has no such rows.
    anchor: which rows are anchors; NULL counts as false.  Rows with a NULL id, label or vector, an empty vector, or one with a NULL or
    non-finite component take no part; an anchor is compared with vectors of its own length.  Repeated rows count each for itself: a copy of the anchor's row is another row, and a repeated anchor has its
    results twice.  Components beyond 2**28 / 256 count as that.  Other columns are not read.  id and label must be integers.
    """
    kind = rows.schema[id].dataType.simpleString()
    plain = rows.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"), F.col(f"`{vector}`").cast("array<double>").alias("vector"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    plain = usable(plain.where("id IS NOT NULL AND label IS NOT NULL"), "vector")
    stored = tiles(plain)
    asked = _anchor_rows(stored)
    parts = []
    for d in sorted(r[0] for r in asked.select("d").distinct().collect()):
        of_length = stored.where(F.col("d") == d)
        per_label = _rows_per_label(of_length)
        size = max(1, min(BLOCK_ANCHORS, BLOCK_BYTES // (8 * d)))
        each, total = numbered(asked.where(F.col("d") == d), ["row"], "number", label="anchors")
        for block in range(-(-total // size)):
            inside = each.where(F.col("number").between(block * size + 1, (block + 1) * size)).orderBy("number").collect()
            x = np.array([np.frombuffer(r["x"], "<i4") for r in inside]).astype(np.int64)
            found = Anchors(np.array([r["row"] for r in inside]), np.array([r["id"] for r in inside]), np.array([r["label"] for r in inside]), x)
            parts += _mined(of_length, found, per_label, positives, negatives, lowest)
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    all_parts = rows.sparkSession.createDataFrame([], out)
    for part in parts:
        all_parts = all_parts.unionByName(part)
    return all_parts.withColumns({c: F.col(c).cast(kind) for c in ("anchor_id", "positive_id", "negative_id")})


def _anchor_rows(stored: DataFrame) -> DataFrame:
    """row, id, label, d, x of every anchor in the tiles, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, (tile, own, labels, x) in enumerate(_each(batch)):
                at = np.flatnonzero(np.frombuffer(batch.column("asked")[k].as_buffer(), np.uint8))
                columns = [(tile << ROW_BITS) + at, own[at], labels[at], np.full(len(at), x.shape[1], np.int32)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array([r.tobytes() for r in x[at]], pa.binary())], ["row", "id", "label", "d", "x"])

    return store(stored.mapInArrow(run, "row long, id long, label long, d int, x binary"), "asked")


def _rows_per_label(stored: DataFrame) -> dict[int, int]:
    """How many rows the 10,000 most frequent labels have; only the first thresholds depend on it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, labels, _ in _each(batch):
                values, counts = np.unique(labels, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts)], ["label", "n"])

    each = stored.select("tile", "d", "n", "ids", "labels", "x").mapInArrow(run, "label long, n long")
    return {r["label"]: r["n"] for r in each.groupBy("label").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "label").limit(10_000).collect()}


def _mined(stored: DataFrame, anchors: Anchors, per_label: dict[int, int], positives: int, negatives: int, lowest: int) -> list[DataFrame]:
    """The results of a block of anchors, one table per round that filled windows."""
    best = _positives(stored, anchors, per_label, positives)
    # per positive: its id and score; windows that can't hold anything are settled from the start
    high = np.full((positives, len(anchors.id)), SETTLED)
    who = np.zeros((positives, len(anchors.id)), np.int64)
    for i, place, other, score in best:
        high[place - 1, i], who[place - 1, i] = score, other
    low = np.where(high >= 0, -(-lowest * high // 100), 0)
    done = high < 0
    parts = []
    for share in (*SHARES, None):
        if done.all():
            break
        cut = np.where(done, np.iinfo(np.int64).max, _lowered(high, low, share))
        thresholds = np.where(done.all(axis=0), SETTLED, cut.min(axis=0))
        windows = [(w, cut[w], np.where(done[w], NEVER, high[w])) for w in range(positives) if not done[w].all()]
        found = _search(stored, anchors, thresholds, windows, negatives, "negatives")
        last = share is None
        filled = found.groupBy("anchor", "window").agg(F.count(F.lit(1)).alias("k"))
        full = filled if last else filled.where(F.col("k") >= negatives)
        ready = [(r["anchor"], r["window"]) for r in full.select("anchor", "window").collect()]
        at_end = ~done & (cut <= low)  # windows that have been looked at down to their end are ready, however few rows they have
        ready = set(ready) | {(int(i), int(w)) for w, i in zip(*np.nonzero(at_end), strict=True)}
        rows = [(i, w, int(anchors.id[i]), int(who[w, i]), int(high[w, i])) for i, w in ready]
        known = stored.sparkSession.createDataFrame(rows, "anchor int, window int, anchor_id long, positive_id long, positive_score long")
        parts.append(
            found.join(F.broadcast(known), ["anchor", "window"]).select(  # at most positives * BLOCK_ANCHORS rows
                "anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
            )
        )
        for i, w in ready:
            done[w, i] = True
    return parts


def _positives(stored: DataFrame, anchors: Anchors, per_label: dict[int, int], wanted: int) -> list[tuple[int, int, int, int]]:
    """(anchor, place, id, score) of the block's positives."""
    best: list[tuple[int, int, int, int]] = []
    hoped, sure = _first_thresholds(anchors, per_label, wanted)
    thresholds = hoped.copy()
    while (thresholds != SETTLED).any():
        rows = _search(stored, anchors, thresholds, None, wanted, "positives").select("anchor", "place", "id", "score").collect()
        of: dict[int, list] = {}
        for r in rows:
            of.setdefault(r["anchor"], []).append((r["anchor"], r["place"], r["id"], r["score"]))
        for i in np.flatnonzero(thresholds != SETTLED).tolist():
            found = of.get(i, [])
            if len(found) >= wanted or thresholds[i] == NEVER:
                best += found
                thresholds[i] = SETTLED
            else:
                thresholds[i] = sure[i] if thresholds[i] > sure[i] else NEVER
    return best
