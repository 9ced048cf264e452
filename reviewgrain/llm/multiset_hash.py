"""Document fingerprints by a homomorphic multiset hash.

Every paragraph (what stands between two line breaks, exactly) is hashed to a wide vector; a fingerprint is the sum of its paragraphs' vectors,
each lane modulo a power of two.  So the order of paragraphs doesn't matter, a paragraph is inserted or deleted by adding or
subtracting its vector, and fingerprints of parts add up to that of the whole.

The vector has two parts.  SUM lanes of 64 uniform bits tell multisets apart.  LIKE lanes of 32 bits hold signed counts of the
paragraph's word triples, each in one lane chosen by its hash: the scalar product of two such sums estimates how many triples two texts share, so the cosine
of the lanes is a likeness (its standard error is about 1 / sqrt(LIKE)).
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewgrain.llm.shared import Batches, partitions, renamed, texts

SUM, LIKE = 8, 128
#: Words of a piece that is counted for the likeness; a paragraph with fewer words is one piece.
PIECE = 3
#: Distinct words whose hashes a worker remembers: so many, and so many bytes of them.
REMEMBERED_WORDS, REMEMBERED_BYTES = 100_000, 4_000_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Fingerprint(NamedTuple):
    """A multiset of paragraphs: sums modulo 2**64 and signed counts modulo 2**32."""

    sums: np.ndarray
    counts: np.ndarray

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.sums + other.sums, self.counts + other.counts)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.sums - other.sums, self.counts - other.counts)

    def text(self) -> str:
        """The lanes in base 64, little-endian."""
        return base64.b64encode(self.sums.astype("<u8").tobytes() + self.counts.astype("<u4").tobytes()).decode("ascii")

    def likeness(self, other: Fingerprint) -> float:
        """1 for equal fingerprints, else the cosine of the signed counts, at least 0."""
        if np.array_equal(self.sums, other.sums) and np.array_equal(self.counts, other.counts):
            return 1.0
        a, b = self.counts.view(np.int32).astype(np.float64), other.counts.view(np.int32).astype(np.float64)
        lengths = float(a @ a) * float(b @ b)
        return min(1.0, max(0.0, float(a @ b) / lengths**0.5)) if lengths else 0.0


def parsed(text: str) -> Fingerprint:
    """The fingerprint that ``Fingerprint.text`` wrote."""
    data = base64.b64decode(text)
    return Fingerprint(np.frombuffer(data[: 8 * SUM], "<u8").copy(), np.frombuffer(data[8 * SUM :], "<u4").copy())


NOTHING = Fingerprint(np.zeros(SUM, np.uint64), np.zeros(LIKE, np.uint32))


class WordHashes(dict):
    """The hashes of recent words; forgets all of them when there are too many."""

    kept = 0

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED_WORDS or self.kept >= REMEMBERED_BYTES:
            self.clear()
            self.kept = 0
        self.kept += len(word)
        self[word] = out = xxhash.xxh3_64_intdigest(word)
        return out


class Paragraphs:
    """The hashed paragraphs of a text, from which the fingerprint of any leading paragraphs follows."""

    def __init__(self, text: str, words: WordHashes):
        self.lines = text.split("\n")
        coded = [line.encode("utf-8", "surrogatepass") for line in self.lines]
        digest = b"".join([hashlib.blake2b(line, digest_size=8 * SUM).digest() for line in coded])
        self.sums = np.frombuffer(digest, "<u8").reshape(-1, SUM)
        parts = [line.lower().split() for line in coded]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        hashed = np.fromiter((words[w] for part in parts for w in part), np.uint64, int(sizes.sum()))
        self.owner, self.lane, self.sign = _pieces(hashed, sizes)

    def leading(self, n: int) -> Fingerprint:
        """The fingerprint of the first ``n`` paragraphs."""
        upto = int(np.searchsorted(self.owner, n)) if n < len(self.lines) else len(self.owner)
        counts = np.bincount(self.lane[:upto], self.sign[:upto], LIKE).astype(np.int64)
        return Fingerprint(self.sums[:n].sum(axis=0, dtype=np.uint64), (counts & 0xFFFFFFFF).astype(np.uint32))

    def whole(self) -> Fingerprint:
        return self.leading(len(self.lines))


def _pieces(hashed: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every run of PIECE words inside a paragraph: the paragraph's number, the lane and the sign."""
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    left = np.repeat(ends, sizes) - np.arange(len(hashed))  # words from here to the paragraph's end
    first = left == np.repeat(sizes, sizes)
    starts = np.flatnonzero((left >= PIECE) | first)
    mixed = np.zeros(len(starts), np.uint64)
    for k in range(PIECE):
        there = left[starts] > k
        word = np.where(there, hashed[np.minimum(starts + k, len(hashed) - 1)], np.uint64(k)) if len(hashed) else mixed
        mixed = (mixed ^ word) * MULTIPLIER
        mixed ^= mixed >> np.uint64(29)
    return owner[starts], (mixed & np.uint64(LIKE - 1)).astype(np.int64), np.where(mixed >> np.uint64(63), 1.0, -1.0)


def fingerprint(text: str | None) -> Fingerprint:
    """The fingerprint of a whole text; NULL counts as empty, which is one empty paragraph."""
    return Paragraphs(text or "", WordHashes()).whole()


def inserted(print_: Fingerprint, paragraph: str) -> Fingerprint:
    """With one more paragraph, wherever it stands."""
    return print_ + fingerprint(paragraph)


def deleted(print_: Fingerprint, paragraph: str) -> Fingerprint:
    """With one paragraph less."""
    return print_ - fingerprint(paragraph)


def joined(own: Paragraphs, keep: int, other: Paragraphs, take: int, words: WordHashes) -> Fingerprint:
    """The fingerprint of own's first ``keep`` code points followed by the first ``take`` of other.

    Paragraphs that stay whole are not hashed again: their vectors are added up; only the one at the joint and the one at the end are new.
    """
    whole, rest = _cut(own.lines, keep)
    if take == 0:
        return own.leading(whole) + Paragraphs(rest, words).whole()
    more, end = _cut(other.lines, take)
    if more == 0:
        return own.leading(whole) + Paragraphs(rest + end, words).whole()
    inside = other.leading(more) - other.leading(1)
    return own.leading(whole) + Paragraphs(rest + other.lines[0], words).whole() + inside + Paragraphs(end, words).whole()


def _cut(lines: list[str], n: int) -> tuple[int, str]:
    """How many paragraphs end, with their line break, in the first ``n`` code points, and what is left of the next one."""
    number, used = 0, 0
    while number < len(lines) - 1 and used + len(lines[number]) + 1 <= n:
        used += len(lines[number]) + 1
        number += 1
    return number, lines[number][: n - used]


def fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default doc_id) of every row plus fingerprint (text in base 64), without a shuffle.

    Repeated rows stay; NULL and empty texts have the fingerprint of one empty paragraph.  A kept column of that name is replaced.
    """
    keep = ["doc_id"] if keep is None else [c for c in keep if c != "fingerprint"]
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_text"))
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            found = [Paragraphs(t or "", words).whole().text() for t in texts(batch, "_text")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(found, pa.string())], [*keep, "fingerprint"])

    return rows.mapInArrow(run, f"{schema}, fingerprint string")


def ranges(ids: DataFrame, id: str, number: int) -> list[int]:
    """The smallest id of each of at most ``number`` ranges with about equally many rows, ascending; NULL ids don't count.

    Only ids are shuffled; one value per range comes to the driver.
    """
    dealt = ids.where(F.col(id).isNotNull()).repartitionByRange(number, id)
    return sorted({r[1] for r in dealt.groupBy(F.spark_partition_id()).agg(F.min(id)).collect()})


def _range_of(id: str, starts: Column, n: int) -> Column:
    """The number of the range that holds an id, by binary search; 0 for NULL and for ids below all starts."""
    step = lambda at, s: F.when((at + s < n) & (F.element_at(starts, (F.least(at + s, F.lit(n - 1)) + 1).cast("int")) <= F.col(id)), at + s).otherwise(at)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max(n - 1, 1).bit_length()))])
    return F.aggregate(steps, F.lit(0), step)


def edited(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Each row's fingerprint beside those of its successor and of an edit that takes in the successor's text.

    Returns id, n_chars (code points), edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.  The successor is the next row in the order of
    (id, text), NULL first; the last row's is the first, and a single row is its own.  The edited text is the row's text with the last floor(n_chars / 2) code points replaced
    by the successor's first as many, or all if it has fewer.  NULL texts count as empty; repeated rows follow each other; other columns are not read.

    Ids are cut into ranges, and every range also gets the first row of the next one, so that whole texts are shuffled once and a task holds two of them.
    Rows that share an id are streamed by one task.  id must be of an integer type.
    """
    rows, names = renamed(docs.select(f"`{id}`", f"`{text}`"))
    rows = rows.select(F.col(names[id]).cast("long").alias("id"), F.coalesce(F.col(names[text]), F.lit("")).alias("text"))
    spark = docs.sparkSession
    number = partitions(spark)
    starts = ranges(rows.select("id"), "id", number)
    first_null = not rows.where("id IS NULL").isEmpty() if starts else True
    n = len(starts) + first_null  # range 0 holds rows without an id, if there are any
    known = F.from_json(F.lit(json.dumps({"s": starts})), "s array<bigint>")["s"]
    place = F.when(F.col("id").isNull(), 0).otherwise(_range_of("id", known, len(starts)) + int(first_null)) if starts else F.lit(0)
    # rows that can be the first of their range are also sent to the range before it
    begins = F.coalesce(F.array_contains(known, F.col("id")), F.lit(False)) | F.col("id").isNull() if starts else F.lit(True)
    before = F.pmod(F.col("range") - 1, F.lit(n))
    dealt = (
        rows.withColumn("range", place.cast("int"))
        .withColumn("to", F.explode(F.when(begins, F.array(F.struct(F.col("range").alias("range"), F.lit(False).alias("guard")), F.struct(before.alias("range"), F.lit(True).alias("guard")))).otherwise(F.array(F.struct(F.col("range").alias("range"), F.lit(False).alias("guard"))))))
        .select("to.range", "to.guard", "id", "text")
        .repartitionById(max(number, n), F.col("range"))  # a range a task, so that tasks are even
        .sortWithinPartitions("range", "guard", "id", "text")
    )
    schema = pa.schema(
        [
            ("id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
            ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, out = WordHashes(), Batches(schema)
        last = None  # range, id, text, paragraphs and fingerprint of the row that waits for its successor
        for batch in batches:
            for where, guard, own, body in zip(
                batch.column("range").to_pylist(), batch.column("guard").to_pylist(), batch.column("id").to_pylist(), texts(batch, "text"), strict=True
            ):
                if guard and (last is None or last[0] != where):
                    continue  # of the rows sent from the next range only the first is a successor
                parts = Paragraphs(body, words)
                whole = parts.whole()
                if last is not None and last[0] == where:
                    yield from out.add(_compared(last[1:], (body, parts, whole), words), 2048)
                last = None if guard else (where, own, body, parts, whole)
        yield from out.flush()

    found = dealt.mapInArrow(run, "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return found.withColumn("id", F.col("id").cast(docs.schema[id].dataType)).withColumnRenamed("id", id)


def _compared(row: tuple, after: tuple, words: WordHashes) -> tuple:
    """The result row of a row (id, text, paragraphs, fingerprint) and its successor (text, paragraphs, fingerprint)."""
    own, body, parts, whole = row
    following, other, next_whole = after
    half = len(body) // 2
    take = min(half, len(following))
    made = joined(parts, len(body) - half, other, take, words)
    digest = hashlib.sha256((body[: len(body) - half] + following[:take]).encode("utf-8", "surrogatepass")).hexdigest()
    return own, len(body), digest, whole.text(), made.text(), whole.likeness(made), whole.likeness(next_whole)
