"""SimHash near-duplicates by bit-sliced comparison.

A text's fingerprint has 64 bits; two texts are linked if at most RADIUS bits differ.  Each fingerprint is
filed under every choice of EQUAL of BLOCKS bit blocks: RADIUS changed bits touch at most RADIUS blocks, so linked fingerprints share the rest
and meet in at least one file.  Inside a file, fingerprints are stored vertically, one bit plane per bit position, and carry-save counters add up
the differing bits of very many pairs at once; a block of pairs is abandoned as soon as every pair is beyond the radius.

Files are kept small without dropping pairs: a file with more than FILE_ROWS fingerprints is filed again by
the bits that its key leaves free.  Each level fixes at least 10 more bits, and after LEVELS levels a file has
at most 2**20 different fingerprints, whatever the input.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewgrain.llm.shared import Batches, components, partitions, renamed, store, texts

SHINGLE = 4
SEED = 42
BITS, RADIUS = 64, 4
BLOCKS, EQUAL = 6, 2
#: Largest file that is compared as it is, and how often larger ones are filed again.
FILE_ROWS, LEVELS = 32_768, 3
#: Runs of up to this many rows of one file are compared by shifting the planes of many files together.
SHORT_RUN = 48
#: Planes added between two looks at whether all pairs of a block are beyond the radius, and pairs in a block.
PLANES_AT_ONCE, PAIRS_AT_ONCE = 8, 4096


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit SimHash of a whole text; 0 if it has no word.

    A-Z are lower-cased, words are runs without ASCII white space, shingles are ``shingle`` words joined by one space, repeats included;
    with fewer words the whole sequence is the only shingle.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    width = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = [
        digest(joined[a:b], seed)
        for a, b in zip(starts[: len(words) - width + 1].tolist(), (ends[width - 1 :] - 1).tolist(), strict=True)
    ]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    set_bits = bits.sum(axis=0, dtype=np.uint32) * 2 > len(hashes)
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default doc_id) of every row plus fingerprint, a signed long."""
    keep = ["doc_id"] if keep is None else keep
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_text"))
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t) for t in texts(batch, "_text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(values, pa.int64())], [*keep, "fingerprint"]
            )

    return rows.mapInArrow(run, f"{schema}, fingerprint long")


# bit planes: bit i of a plane belongs to row i; planes are Python integers


def planes(values: np.ndarray) -> list[int]:
    """The 64 bit planes of unsigned 64-bit fingerprints."""
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    return [int.from_bytes(row.tobytes(), "little") for row in packed]


def within(differences: Iterator[int], wanted: int, radius: int = RADIUS) -> int:
    """The pairs of ``wanted`` for which at most ``radius`` of the difference planes are set.

    Carry-save: ``counts`` holds bit j of all counters in plane j, with as many planes as the radius needs; a pair whose counter has passed the radius is taken
    out, and once none is left the rest of the planes isn't looked at.
    """
    size = (radius + PLANES_AT_ONCE).bit_length()
    counts = [0] * size
    for number, carry in enumerate(differences, 1):
        for j in range(size):
            if not carry:
                break
            counts[j], carry = counts[j] ^ carry, counts[j] & carry
        if number % PLANES_AT_ONCE == 0 or number == BITS:
            beyond = _above(counts, radius, wanted)
            wanted &= ~beyond
            if not wanted:
                return 0
            counts = [c & wanted for c in counts]
    return wanted


def _above(counts: list[int], radius: int, wanted: int) -> int:
    """The pairs whose counter is over ``radius``."""
    over, same = 0, wanted
    for j in reversed(range(len(counts))):
        if radius >> j & 1:
            same &= counts[j]
        else:
            over |= same & counts[j]
            same &= ~counts[j]
    return over


def set_rows(mask: int) -> list[int]:
    """The positions of the set bits."""
    data = np.frombuffer(mask.to_bytes((mask.bit_length() + 7) // 8, "little"), np.uint8)
    return np.flatnonzero(np.unpackbits(data, bitorder="little")).tolist()


class Forest:
    """Keeps the links that join two parts and forgets the others."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def top(self, x: int) -> int:
        up = self.up
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    def adds(self, x: int, y: int) -> bool:
        a, b = self.top(x), self.top(y)
        self.up[max(a, b)] = min(a, b)
        return a != b


def links_of_short_runs(values: np.ndarray, runs: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[int, int]]:
    """Linked rows of many short files at once; ``runs`` numbers the file of each row, equal ones adjacent.

    Row i is compared to row i + d for each distance d up to the longest run: a shift of the planes lines them up.
    """
    for start in range(0, len(values), PAIRS_AT_ONCE):
        block = slice(start, min(len(values), start + PAIRS_AT_ONCE + SHORT_RUN))
        rows, run = values[block], runs[block]
        vertical = None
        for d in range(1, SHORT_RUN):
            same = run[d:] == run[:-d]
            same[PAIRS_AT_ONCE:] = False
            if not same.any():
                break
            if vertical is None:
                vertical = planes(rows)
            wanted = int.from_bytes(np.packbits(same, bitorder="little").tobytes(), "little")
            for i in set_rows(within((p ^ (p >> d) for p in vertical), wanted, radius)):
                yield start + i, start + i + d


def links_of_long_run(values: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links in one large file.

    Breadth first: a row is compared to all rows not reached yet, and those it reaches leave the file, so that groups of near copies shrink at once.
    """
    vertical, queue = planes(values), []
    rest = (1 << len(values)) - 1
    bits = values.tolist()
    while rest:
        if not queue:
            queue.append((rest & -rest).bit_length() - 1)
            rest ^= 1 << queue[-1]
        at = queue.pop()
        query = bits[at]
        found = within((p ^ rest if query >> b & 1 else p for b, p in enumerate(vertical)), rest, radius)
        if found:
            rest ^= found
            for i in set_rows(found):
                yield at, i
                queue.append(i)
        if rest.bit_count() * 2 < len(bits):  # most rows have left: make the planes shorter
            left, open_rows = set_rows(rest) if rest else [], queue
            yield from _shrunk(values, left, open_rows, radius)
            return


def _shrunk(values: np.ndarray, left: list[int], queue: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """Go on with the rows that are left; ``queue`` holds reached rows that were not compared yet."""
    if not left:
        return
    numbers = np.array(left)
    vertical, rest = planes(values[numbers]), (1 << len(left)) - 1
    for at in queue:
        if not rest:
            break
        query = int(values[at])
        found = within((p ^ rest if query >> b & 1 else p for b, p in enumerate(vertical)), rest, radius)
        if found:
            rest ^= found
            for i in set_rows(found):
                yield at, int(numbers[i])
                queue.append(int(numbers[i]))
    remaining = numbers[set_rows(rest)] if rest else numbers[:0]
    for a, b in links_of_long_run(values[remaining], radius):
        yield int(remaining[a]), int(remaining[b])


def compare_files(filed: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that span the linked rows of each file; ``filed`` has file and fingerprint, each pair once.

    Rows of a file are adjacent after the sort; a task holds one Arrow batch and one file.
    """
    dealt = (
        filed.select("file", "fingerprint")
        .repartition(partitions(filed.sparkSession), "file")
        .sortWithinPartitions("file", "fingerprint")
    )
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compared(files: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, int]]:
        starts = np.flatnonzero(np.concatenate(([True], files[1:] != files[:-1])))
        sizes = np.diff(np.append(starts, len(files)))
        runs = np.repeat(np.arange(len(starts)), sizes)
        size_of = sizes[runs]
        short = np.flatnonzero((size_of > 1) & (size_of <= SHORT_RUN))
        forest = Forest()
        for i, j in links_of_short_runs(values[short], runs[short], radius):
            a, b = int(values[short[i]]), int(values[short[j]])
            if forest.adds(a, b):
                yield a, b
        for at in np.flatnonzero(sizes > SHORT_RUN):
            rows = values[starts[at] : starts[at] + sizes[at]]
            for i, j in links_of_long_run(rows, radius):
                yield int(rows[i]), int(rows[j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Batches(schema)
        files, values = np.empty(0, np.int64), np.empty(0, np.uint64)

        def emit(upto: int) -> Iterator[pa.RecordBatch]:
            for a, b in compared(files[:upto], values[:upto]):
                yield from out.add(tuple(np.array([a, b], np.uint64).view(np.int64).tolist()))

        for batch in batches:
            files = np.concatenate((files, batch.column("file").to_numpy()))
            values = np.concatenate((values, batch.column("fingerprint").to_numpy().view(np.uint64)))
            last = int(np.searchsorted(files, files[-1])) if len(files) else 0
            if last:
                yield from emit(last)
                files, values = files[last:], values[last:]
        if len(files):
            yield from emit(len(files))
        yield from out.flush()

    return dealt.mapInArrow(run, "a long, b long")


def _files(values: np.ndarray, mask: int) -> Iterator[tuple[int, np.ndarray]]:
    """All files of fingerprints whose bits under ``mask`` are already equal: (new mask, values under it)."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    edges = [round(i * len(free) / BLOCKS) for i in range(BLOCKS + 1)]
    for choice in combinations(range(BLOCKS), EQUAL):
        fixed = mask | sum(1 << b for i in choice for b in free[edges[i] : edges[i + 1]])
        yield fixed, values & np.uint64(fixed)


def file_rows_of(rows: DataFrame) -> DataFrame:
    """File fingerprints: rows (file, mask, fingerprint); ``rows`` has mask, the bits fixed so far, and fingerprint.

    A file is known by the digest of its mask and of the bits under it; two files with the same digest are only compared needlessly.
    """
    names = ["file", "mask", "fingerprint"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks = batch.column("mask").to_numpy().view(np.uint64)
            values = batch.column("fingerprint").to_numpy().view(np.uint64)
            for mask in np.unique(masks).tolist():
                own = values[masks == np.uint64(mask)]
                for fixed, under in _files(own, mask):
                    key = _mixed(under ^ _mixed(np.array([fixed], np.uint64)))
                    columns = key, np.full(len(own), fixed, np.uint64), own
                    yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], names)

    return rows.select("mask", "fingerprint").mapInArrow(run, "file long, mask long, fingerprint long")


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def near_links(heads: DataFrame, radius: int = RADIUS, file_rows: int = FILE_ROWS) -> DataFrame:
    """Links (a, b) between different fingerprints that connect all within ``radius`` bits.

    heads: distinct fingerprints.  The links span the same components as all pairs within the radius.
    """
    if radius > BLOCKS - EQUAL:
        raise ValueError(f"{BLOCKS} blocks, {EQUAL} equal, find at most {BLOCKS - EQUAL} changed bits")
    rows, found = heads.select(F.lit(0).cast("long").alias("mask"), "fingerprint"), []
    for level in range(1, LEVELS + 1):
        filed = file_rows_of(rows)
        if level == LEVELS:
            found.append(compare_files(filed, radius))
            break
        large = store(filed.groupBy("file").count().where(F.col("count") > file_rows).select("file"), "large-files")
        if large.isEmpty():
            found.append(compare_files(filed, radius))
            break
        found.append(compare_files(filed.join(large, "file", "left_anti"), radius))
        rows = filed.join(large, "file", "left_semi").select("mask", "fingerprint")
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out


def _rooted(docs: DataFrame, keep: list[str], radius: int) -> tuple[DataFrame, DataFrame]:
    """Stored tables: ``keep`` and fingerprint of every row, and the root fingerprint of every fingerprint."""
    rows = store(fingerprints(docs, keep=keep), "fingerprints")
    heads = store(rows.select("fingerprint").distinct(), "heads")
    parts = components(near_links(heads, radius), "simhash").select(F.col("node").alias("fingerprint"), "root")
    rooted = heads.join(parts, "fingerprint", "left").select("fingerprint", F.coalesce("root", "fingerprint").alias("root"))
    return rows, store(rooted, "rooted")


def groups(docs: DataFrame, text: str = "text", id: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (long), component_id, the smallest id reachable over links.

    Rows with the same fingerprint are linked; all texts without a word have fingerprint 0 and are linked too.  NULL ids
    stay and never become a component_id unless a component has no other.  Repeated rows
    are in one component.  An empty table gives an empty result.  Only ids and fingerprints are shuffled; equal
    fingerprints are combined in the map tasks before they are compared.
    """
    narrow = docs.select(F.col(f"`{id}`").alias("_id"), F.col(f"`{text}`").alias("text"))
    rows, rooted = _rooted(narrow, ["_id"], radius)
    first = rows.groupBy("fingerprint").agg(F.min("_id").alias("first")).join(rooted, "fingerprint")
    least = first.groupBy("root").agg(F.min("first").alias("component_id"))
    named = store(rooted.join(least, "root").select("fingerprint", "component_id"), "components")
    return rows.join(named, "fingerprint").select(F.col("_id").alias(id), "fingerprint", "component_id")


def without_near_duplicates(docs: DataFrame, text: str = "text", id: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """One document of each group of near duplicates, all columns as they are.

    The one with the smallest id stays; a NULL id comes last, ties go by a digest of the text.  Texts without a word are one group.  Of rows
    with the same id and text one stays.
    """
    rows, names = renamed(docs)
    key = F.struct(F.col(names[id]).alias("id"), F.xxhash64(names[text]).alias("text_key"))
    prints, rooted = _rooted(rows.select(key.alias("_key"), F.col(names[text]).alias("text")), ["_key"], radius)
    place = F.struct(F.col("_key.id").isNull().alias("last"), F.col("_key").alias("key"))
    first = prints.groupBy("fingerprint").agg(F.min(place).alias("p")).join(rooted, "fingerprint")
    kept = first.groupBy("root").agg(F.min("p").alias("p")).select("p.key")
    keyed = rows.withColumn("_key", key)
    return keyed.join(kept, keyed["_key"] == kept["key"], "left_semi").dropDuplicates(["_key"]).drop("_key").toDF(*docs.columns)


def hexadecimal(fingerprint_column: str) -> Column:
    """A signed long as 16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(fingerprint_column)), 16, "0")
