"""Byte-level BPE encoding and decoding by tree reduction.

Encodings of byte strings form a monoid.  A piece is cut into halves down to a
few bytes; two neighbours are joined by encoding a window around their border
anew, and the window grows until the tokens outside of it provably stay.

Why they stay: call a pair of tokens (x, y) stable if merging the bytes of x + y
gives exactly [x, y].  A token sequence is the encoding of its bytes if and only if
each adjacent pair is stable.  (Take the first merge that crosses a border between two
tokens of the sequence; until then the bytes of these two tokens went through the same
merges as they do alone, as the lowest rank, leftmost pair of the whole is also that of
the part.  So the pair alone would make this merge too and not be stable.  The other
direction follows from the same correspondence.)  So a join only has to find a window
whose own encoding is stable against the tokens to its left and right.
"""

from __future__ import annotations

import base64
import contextlib
import ctypes
import gc
import heapq
import re
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewgrain.llm.shared import Batches, texts

#: Pieces of at most this many bytes are merged directly: the leaves of the tree.
LEAF = 8
#: Entries per generation of a worker's memory of chunks, half as many in those below it (about 220 bytes each), and the longest text remembered.
REMEMBERED, LONGEST = 120_000, 48
#: Stands for the rank of a pair that is no token.
NO_RANK = 1 << 62
#: Tokens that are joined at once at the lowest level of a decoding tree.
DECODED_TOGETHER = 256
#: Runs without white space, each with the white space before it.  No match of the split
#: pattern crosses the border between a character that is not white space and one that is.
CHUNK = re.compile(r"\s*\S+|\s+")
#: Python counts these as white space, the split pattern does not; texts with one are split in one go.
ODD_SPACE = re.compile(r"[\x1c-\x1f]")
#: Characters of a text that are taken apart at once, up to the next end of a chunk.
SLICE, CHUNK_END = 1 << 16, re.compile(r"\S(?=\s)")


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a file with base64 tokens and numbers."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class Memory:
    """Remembers recent values in two generations, so that common ones survive when it is full."""

    def __init__(self, make: Callable, size: int = REMEMBERED):
        self.make, self.size = make, size
        self.young: dict = {}
        self.old: dict = {}

    def __call__(self, key):
        value = self.young.get(key)
        if value is None:
            value = self.old.get(key)
            if value is None:
                value = self.make(key)
            if len(key) <= LONGEST:
                if len(self.young) >= self.size:
                    self.old, self.young = self.young, {}
                self.young[key] = value
        return value


class TreeBpe:
    """Encoder and decoder for one vocabulary and one split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf: int = LEAF, remembered: int = REMEMBERED):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.split = regex.compile(pattern)
        self.leaf = max(1, leaf)
        self.chunk = Memory(self._chunk, remembered)
        self.piece = Memory(self._piece, remembered // 2)
        self.leaves = Memory(self.merge, remembered // 2)
        self.pairs = Memory(self._pair, remembered // 2)

    # pieces

    def merge(self, piece: bytes) -> list[int]:
        """Merge the bytes of a short piece, lowest rank first, leftmost first."""
        if len(piece) > 64:
            return self._merge_long(piece)
        get, tokens = self.ranks.get, self.tokens
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [get(piece[i : i + 2], NO_RANK) for i in range(len(piece) - 1)]
        while pairs:
            best = min(pairs)
            if best == NO_RANK:
                break
            i = pairs.index(best)
            parts[i : i + 2] = [tokens[best]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], NO_RANK)
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], NO_RANK)
        return [self.ranks[p] for p in parts]

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same merges with a heap and linked parts, for wide windows."""
        n = len(piece)
        end = list(range(1, n + 1))
        left = list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = end[i]
            if j < n and (rank := self.ranks.get(piece[i : end[j]])) is not None:
                heapq.heappush(heap, (rank, i, j, end[j]))

        for i in range(n - 1):
            offer(i)
        gone = bytearray(n)
        while heap:
            _, i, j, stop = heapq.heappop(heap)
            if gone[i] or gone[j] or end[i] != j or end[j] != stop:
                continue
            gone[j] = 1
            end[i] = stop
            if stop < n:
                left[stop] = i
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : end[i]]])
            i = end[i]
        return out

    def _pair(self, pair: tuple[int, int]) -> list[int]:
        """The encoding of the bytes of two tokens; an empty list says that the pair is stable."""
        window = self.leaves(self.tokens[pair[0]] + self.tokens[pair[1]])
        return [] if window == list(pair) else window

    def join(self, a: list[int], b: list[int]) -> list[int]:
        """The encoding of two neighbours together."""
        if not a or not b:
            return a + b
        pairs = self.pairs
        window = pairs((a[-1], b[0]))
        if not window:
            return a + b
        back, ahead = 1, 1
        while True:
            holds_left = back >= len(a) or not pairs((a[-back - 1], window[0]))
            holds_right = ahead >= len(b) or not pairs((window[-1], b[ahead]))
            if holds_left and holds_right:
                return a[:-back] + window + b[ahead:]
            back = back if holds_left else min(len(a), 2 * back)
            ahead = ahead if holds_right else min(len(b), 2 * ahead)
            window = self.leaves(b"".join([self.tokens[t] for t in (*a[-back:], *b[:ahead])]))

    def tree(self, piece: bytes) -> list[int]:
        """Encode halves, then join them."""
        if len(piece) <= self.leaf:
            return self.leaves(piece)
        half = len(piece) // 2
        return self.join(self.tree(piece[:half]), self.tree(piece[half:]))

    def _piece(self, match: str) -> bytes:
        """The packed ids of one match of the split pattern; a whole token is itself."""
        piece = match.encode("utf-8", "surrogatepass")
        rank = self.ranks.get(piece)
        ids = self.tree(piece) if rank is None else [rank]
        return struct.pack(f"<{len(ids)}I", *ids)

    # texts

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if ODD_SPACE.search(text):
            return self._chunk(text)
        out, start = [], 0
        while start < len(text):
            end = CHUNK_END.search(text, start + SLICE)
            stop = end.end() if end else len(text)
            out.append(self._chunks(text[start:stop]))
            start = stop
        return b"".join(out)

    def _chunks(self, text: str) -> bytes:
        chunk, young = self.chunk, self.chunk.young
        out = []
        for part in CHUNK.findall(text):
            ids = young.get(part)
            if ids is None:
                ids = chunk(part)
                young = chunk.young
            out.append(ids)
        return b"".join(out)

    def _chunk(self, chunk: str) -> bytes:
        matches = self.split.findall(chunk)
        return self._piece(matches[0]) if len(matches) == 1 else b"".join([self.piece(m) for m in matches])

    def decode(self, ids: bytes) -> bytes:
        """The bytes of the ids, concatenated pair by pair up a tree."""
        numbers = np.frombuffer(ids, "<u4")
        tokens = self.tokens
        level = [
            b"".join([tokens[t] for t in numbers[i : i + DECODED_TOGETHER].tolist()])
            for i in range(0, len(numbers), DECODED_TOGETHER)
        ]
        while len(level) > 1:
            level = [b"".join(level[i : i + 2]) for i in range(0, len(level), 2)]
        return level[0] if level else b""


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str, leaf: int = LEAF, remembered: int = REMEMBERED) -> TreeBpe:
    """One encoder per worker and vocabulary."""
    return TreeBpe(load_ranks(path), pattern, leaf, remembered)


def forget() -> None:
    """Drop a worker's encoders and give their memory back, since workers live on after a stage."""
    encoder.cache_clear()
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def encode(
    docs: DataFrame, path: str, pattern: str, text: str = "text", keep: list[str] | None = None, leaf: int = LEAF, release: bool = False
) -> DataFrame:
    """Encode every whole text: the columns ``keep`` plus n_tokens and ids.

    docs: any table with a text column.  keep: columns to carry along (default:
    doc_id).  n_tokens is a long, ids a binary column with little-endian unsigned
    32-bit integers.  NULL and empty texts have 0 tokens and empty ids; repeated rows
    are encoded each; further columns are not read.  release: tasks drop their memories when they end, for jobs that go on with other stages.
    """
    return _encoded(docs, path, pattern, text, keep, leaf, release, False)


def round_trip(
    docs: DataFrame, path: str, pattern: str, text: str = "text", keep: list[str] | None = None, leaf: int = LEAF, release: bool = False, remembered: int = REMEMBERED
) -> DataFrame:
    """``encode`` and then ``decode`` of its ids in the same tasks, which need one vocabulary and one process for both: ``keep``, n_tokens, ids and decoded (binary).

    remembered: entries of a worker's memory; fewer need more time.
    """
    return _encoded(docs, path, pattern, text, keep, leaf, release, True, remembered)


def _encoded(docs: DataFrame, path: str, pattern: str, text: str, keep: list[str] | None, leaf: int, release: bool, back: bool, remembered: int = REMEMBERED) -> DataFrame:
    keep = ["doc_id"] if keep is None else keep
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_text"))
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    made = [pa.field("n_tokens", pa.int64()), pa.field("ids", pa.binary()), *([pa.field("decoded", pa.binary())] if back else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, out = encoder(path, pattern, leaf, remembered), None
        for batch in batches:
            if out is None:
                out = Batches(pa.schema([*(batch.schema.field(c) for c in keep), *made]))
            kept = [batch.column(c) for c in keep]
            for i, value in enumerate(texts(batch, "_text")):
                ids = bpe.encode(value) if value else b""
                again = (bpe.decode(ids),) if back else ()
                yield from out.add((*(c[i].as_py() for c in kept), len(ids) // 4, ids, *again), len(ids) + sum(map(len, again)) + 64)
        if out is not None:
            yield from out.flush()
        if release:
            del bpe
            forget()

    return rows.mapInArrow(run, f"{schema}, n_tokens long, ids binary{', decoded binary' if back else ''}")


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "ids", keep: list[str] | None = None, release: bool = False) -> DataFrame:
    """Decode a binary column of ids: the columns ``keep`` plus decoded (binary).

    NULL and empty ids give empty bytes; an id without a token is an error.
    """
    keep = ["doc_id"] if keep is None else keep
    rows = encoded.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{ids}`").alias("_ids"))
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, out = encoder(path, pattern), None
        for batch in batches:
            if out is None:
                out = Batches(pa.schema([*(batch.schema.field(c) for c in keep), pa.field("decoded", pa.binary())]))
            kept = [batch.column(c) for c in keep]
            for i, value in enumerate(batch.column("_ids")):
                data = bpe.decode(value.as_py() or b"")
                yield from out.add((*(c[i].as_py() for c in kept), data), len(data) + 64)
        if out is not None:
            yield from out.flush()
        if release:
            del bpe
            forget()

    return rows.mapInArrow(run, f"{schema}, decoded binary")
