"""Packed token ids: best-fit-decreasing with a segment tree over the capacities.

Texts are encoded, documents longer than a row are cut into pieces without loss, and the pieces are packed into rows of
a fixed number of ids: longest first, each into the open row that it leaves the least room in.  A segment
tree over the free ids of the open rows finds that row in logarithmic time.  Each task packs its documents in units of bounded
size, so memory is bounded and nothing is shuffled.
"""

from __future__ import annotations

import struct
from collections import deque
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewgrain.llm.byte_bpe import CHUNK, ODD_SPACE, Memory, load_ranks
from reviewgrain.llm.shared import Batches, texts

#: Ids of a row, id of the empty places, and ids that a unit gathers before it is packed.
ROW, PAD, UNIT_IDS = 2048, 50256, 2_000_000
#: Chunks per generation of a worker's memory (about 200 bytes each).
REMEMBERED = 250_000


class Capacities:
    """Open rows by their free ids; a segment tree tells the smallest capacity that is enough."""

    def __init__(self, most: int):
        self.leaves = 1 << max(1, most.bit_length())
        self.counts = [0] * (2 * self.leaves)
        self.rows: list[deque[int]] = [deque() for _ in range(most + 1)]

    def _change(self, capacity: int, by: int) -> None:
        at = self.leaves + capacity
        while at:
            self.counts[at] += by
            at >>= 1

    def add(self, row: int, capacity: int) -> None:
        self.rows[capacity].append(row)
        self._change(capacity, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """The open row with the least capacity of at least ``need`` (of equal ones the first added), taken out."""
        counts, at = self.counts, self.leaves + need
        if not counts[at]:
            while at > 1 and (at & 1 or not counts[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at *= 2
                if not counts[at]:
                    at += 1
        capacity = at - self.leaves
        row = self.rows[capacity].popleft()
        self._change(capacity, -1)
        return row, capacity


def best_fit_decreasing(lengths: Sequence[int], size: int) -> list[list[int]]:
    """Rows of piece numbers; lengths are 1 to ``size``.  Equal lengths go in the given order."""
    open_rows, rows = Capacities(size), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = open_rows.take(lengths[i])
        if found is None:
            rows.append([])
            found = len(rows) - 1, size
        row, capacity = found
        rows[row].append(i)
        if capacity > lengths[i]:
            open_rows.add(row, capacity - lengths[i])
    return rows


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> tuple[tiktoken.Encoding, Memory]:
    """The library's encoder and a memory of recent chunks, once per worker."""
    whole = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={})

    def ids_of(chunk: str) -> bytes:
        ids = whole.encode_ordinary(chunk)
        return struct.pack(f"<{len(ids)}I", *ids)

    return whole, Memory(ids_of, REMEMBERED)


def encode(text: str, path: str, pattern: str) -> bytes:
    """Ids of a whole text as little-endian unsigned 32-bit integers."""
    whole, chunk = encoder(path, pattern)
    if ODD_SPACE.search(text):
        return np.array(whole.encode_ordinary(text), "<u4").tobytes()
    young, out = chunk.young, []
    for part in CHUNK.findall(text):
        ids = young.get(part)
        if ids is None:
            ids = chunk(part)
            young = chunk.young
        out.append(ids)
    return b"".join(out)


def pack(docs: DataFrame, path: str, pattern: str, text: str = "text", id: str = "doc_id", size: int = ROW, pad: int = PAD, unit_ids: int = UNIT_IDS) -> DataFrame:
    """One row per packed row of ``size`` ids: unit, row, n_ids, doc_ids, pieces, cu_seqlens, ids, positions.

    unit numbers what was packed together, row counts within it.  doc_ids and pieces name the segments (piece k of a document starts at its id k * size);
    cu_seqlens holds the ends of the segments, 0 first.  ids and positions are binary, ``size`` little-endian unsigned 32-bit integers each: the ids
    with ``pad`` behind the last segment, and positions that restart with 0 at every segment and in the empty places.  Together
    the pieces are all ids of all texts.  NULL and empty texts have no ids and are in no row; repeated rows are packed each; a NULL id stays NULL.
    """
    rows = docs.select(F.col(f"`{id}`").cast("long").alias("_id"), F.col(f"`{text}`").alias("_text"))
    schema = pa.schema(
        [
            ("unit", pa.int64()), ("row", pa.int32()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("pieces", pa.list_(pa.int32())),
            ("cu_seqlens", pa.list_(pa.int32())), ("ids", pa.binary()), ("positions", pa.binary()),
        ]
    )

    def packed(unit: int, pieces: list[tuple[int | None, int, bytes]]) -> Iterator[tuple]:
        for number, members in enumerate(best_fit_decreasing([len(p[2]) // 4 for p in pieces], size)):
            ends = np.cumsum([0, *(len(pieces[i][2]) // 4 for i in members)])
            ids = b"".join([pieces[i][2] for i in members])
            free = size - int(ends[-1])
            positions = np.arange(size, dtype="<u4") - np.repeat(ends, [*np.diff(ends), free]).astype("<u4")
            if free:
                positions[-free:] = 0
                ids += np.full(free, pad, "<u4").tobytes()
            yield unit, number, int(ends[-1]), [pieces[i][0] for i in members], [pieces[i][1] for i in members], ends.tolist(), ids, positions.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, pieces, gathered = Batches(schema), [], 0
        unit = TaskContext.get().partitionId() << 32
        for batch in batches:
            for doc, text in zip(batch.column("_id").to_pylist(), texts(batch, "_text"), strict=True):
                ids = encode(text, path, pattern) if text else b""
                pieces += [(doc, k, ids[at : at + 4 * size]) for k, at in enumerate(range(0, len(ids), 4 * size))]
                gathered += len(ids) // 4
                if gathered >= unit_ids:
                    for row in packed(unit, pieces):
                        yield from out.add(row, 8 * size)
                    unit, pieces, gathered = unit + 1, [], 0
        for row in packed(unit, pieces):
            yield from out.add(row, 8 * size)
        yield from out.flush()

    return rows.mapInArrow(
        run, "unit long, row int, n_ids long, doc_ids array<long>, pieces array<int>, cu_seqlens array<int>, ids binary, positions binary"
    )


def write(packed_rows: DataFrame, path: str) -> None:
    """Write packed rows as Parquet: each file is a matrix of ids and one of positions with the segments beside."""
    packed_rows.write.parquet(path)


def matrix(rows: Sequence, column: str, size: int = ROW) -> np.ndarray:
    """Collected or file rows of one unit as a matrix, one packed row per line."""
    return np.frombuffer(b"".join(bytes(r[column]) for r in rows), "<u4").reshape(-1, size)
