"""Line deduplication with a suffix array over line-id sequences.

Lines become ids.  Lines that occur once split every document into stretches of repeated lines; only stretches with enough
words can hold a run worth deleting, and equal stretches are put together first.  The suffixes of the different stretches are then
sorted by distributed prefix doubling: in round k each position is ranked by its first 2**k lines, from the
pair of its rank and the rank 2**(k-1) lines on.  Common prefixes of neighbouring suffixes follow from line-by-line
comparison only where the line before differs; behind such a place they get shorter by one per line.  The intervals of
suffixes that share enough words are the repeated runs; the copy that comes first stays, later ones are deleted.
This is done for the sequences and for their mirror images: a run's lines up to its last MIN_WORDS words are found
from its start, the rest from its end, whichever earlier copies they have.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewgrain.llm.shared import numbered, renamed, store, texts

#: Words that a repeated run must have.
MIN_WORDS = 10
KEYS = ["_id", "_text_key"]


def line_arrays(docs: DataFrame) -> DataFrame:
    """_id, _text_key, lines (16-byte digests) and words (their word counts) of every row with a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts = [], []
            for text in texts(batch, "text"):
                lines = (text or "").encode("utf-8", "surrogatepass").split(b"\n")
                ids.append([xxhash.xxh3_128_digest(line.strip()) for line in lines])
                counts.append([len(line.split()) for line in lines])
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_text_key"), pa.array(ids, pa.list_(pa.binary())), pa.array(counts, pa.list_(pa.int32()))],
                ["_id", "_text_key", "lines", "words"],
            )

    kind = docs.schema["_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"_id {kind}, _text_key long, lines array<binary>, words array<int>")


def stretches(lines: DataFrame, min_words: int) -> DataFrame:
    """Maximal sequences of repeated lines with at least ``min_words`` words: _id, _text_key, start, ids, words."""
    each = lines.select(*KEYS, F.posexplode(F.arrays_zip("lines", "words")).alias("at", "x")).select(
        *KEYS, "at", F.col("x.lines").alias("line"), F.col("x.words").alias("words")
    )
    again = each.groupBy("line").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("line")
    place = F.dense_rank().over(Window.partitionBy(*KEYS).orderBy("at"))
    return (
        each.join(again, "line")
        .withColumn("island", F.col("at") - place)
        .groupBy(*KEYS, "island")
        .agg(F.sort_array(F.collect_set(F.struct("at", "line", "words"))).alias("x"))
        .select(*KEYS, F.col("x.at")[0].alias("start"), F.col("x.line").alias("ids"), F.col("x.words").alias("words"))
        .where(F.aggregate("words", F.lit(0), lambda a, b: a + b) >= min_words)
    )


def suffix_ranks(positions: DataFrame, longest: int) -> DataFrame:
    """Prefix doubling over positions (stretch, at, line): stretch, at, rank, since.

    In round k a rank is 1 plus the number of suffixes whose first 2**k lines sort before; the end of a stretch sorts first.  So a
    rank is the place of the first suffix of its class in the suffix array, and ``since``, the last round that changed it, tells how
    many lines that suffix shares with the one before: fewer than 2**since.
    Rounds end when no rank separates further or the longest stretch is covered.  A round ranks the different pairs of
    ranks: they are counted in the map tasks and numbered in even ranges, so a line that holds a third of all positions is one row.
    """
    names, classes = numbered(positions.groupBy("line").agg(F.count(F.lit(1)).alias("n")), ["line"], "upto", "n", "lines")
    first = names.select("line", (F.col("upto") - F.col("n") + 1).alias("rank"))
    ranked = store(positions.join(first, "line").select("stretch", "at", "rank", F.lit(0).alias("since")), "ranks0")
    width, number = 1, 1
    while width < longest:
        ahead = F.lead("rank", width, 0).over(Window.partitionBy("stretch").orderBy("at"))
        paired = ranked.select("stretch", "at", "since", F.col("rank").alias("a"), ahead.alias("b"))
        sums, found = numbered(paired.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")), ["a", "b"], "upto", "n", f"pairs{number}")
        if found == classes:
            break
        next_rank = sums.select("a", "b", (F.col("upto") - F.col("n") + 1).alias("rank"))
        changed = F.when(F.col("rank") == F.col("a"), F.col("since")).otherwise(F.lit(number)).alias("since")
        ranked = store(paired.join(next_rank, ["a", "b"]).select("stretch", "at", "rank", changed), f"ranks{number}")
        classes, width, number = found, 2 * width, number + 1
    return ranked


def common_lines(pairs: DataFrame, sequences: DataFrame) -> DataFrame:
    """Add lcp, the number of lines that the suffixes (stretch, at) and (other, other_at) share, to ``pairs``.

    ``reach`` bounds it: only so many lines of either are compared.
    """
    left = sequences.select("stretch", F.col("ids").alias("_a"))
    right = sequences.select(F.col("stretch").alias("other"), F.col("ids").alias("_b"))
    cut = pairs.join(left, "stretch").withColumn("_a", F.slice("_a", F.col("at") + 1, F.col("reach")))
    cut = cut.join(right, "other").withColumn("_b", F.slice("_b", F.col("other_at") + 1, F.col("reach")))
    equal = F.zip_with("_a", "_b", lambda a, b: F.coalesce(a == b, F.lit(False)))
    differ = F.array_position(equal, False)
    return cut.withColumn("lcp", F.when(differ > 0, differ - 1).otherwise(F.size(equal)).cast("long")).drop("_a", "_b")


def with_heads(pairs: DataFrame) -> DataFrame:
    """Add head: false where the row before is (at - 1, other_at - 1) of the same two stretches.

    Behind a head the common prefix gets shorter by one per line, so only heads are compared; the lines compared there add up to
    O(n log n) at most.
    """
    order = Window.partitionBy("stretch").orderBy("at")
    follows = (
        (F.lag("at").over(order) == F.col("at") - 1)
        & (F.lag("other").over(order) == F.col("other"))
        & (F.lag("other_at").over(order) == F.col("other_at") - 1)
    )
    return pairs.withColumn("head", ~F.coalesce(follows, F.lit(False)))


def needed_lines(sequences: DataFrame, min_words: int) -> DataFrame:
    """stretch, mirrored, at, needed: how many lines from ``at`` on hold ``min_words`` words; only places where the rest has so many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], []]
            for stretch, mirrored, words in zip(*(batch.column(c).to_pylist() for c in ("stretch", "mirrored", "words")), strict=True):
                sums = np.concatenate(([0], np.cumsum(words)))
                ends = np.searchsorted(sums, sums[:-1] + min_words)
                at = np.flatnonzero(ends < len(sums))
                own = np.full(len(at), stretch, np.int64), np.full(len(at), mirrored), at.astype(np.int32), (ends[at] - at).astype(np.int64)
                for column, values in zip(out, own, strict=True):
                    column.append(values)
            if out[0]:
                columns = [pa.array(np.concatenate(c)) for c in out]
                yield pa.RecordBatch.from_arrays(columns, ["stretch", "mirrored", "at", "needed"])

    return sequences.select("stretch", "mirrored", "words").mapInArrow(run, "stretch long, mirrored boolean, at int, needed long")


def repeated_runs(sequences: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Later copies of repeated runs: stretch, at, length, and other, other_at, where the first copy starts.

    sequences: stretch (numbered in text order), mirrored, ids, words.  In mirrored sequences a later place comes
    first in the text; they share no id with the others.  No two have the same ids.
    """
    longest = sequences.agg(F.max(F.size("ids"))).first()[0] or 0
    each = sequences.select("stretch", F.posexplode("ids").alias("at", "line"))
    ranked = suffix_ranks(each, longest)
    # the suffix array: equal suffixes are in text order
    array, _ = numbered(ranked, ["rank", "stretch", "at"], "slot", label="suffix-array")
    before = array.select((F.col("slot") + 1).alias("slot"), F.col("stretch").alias("other"), F.col("at").alias("other_at"))
    bound = F.when(F.col("rank") < F.col("slot"), longest).when(F.col("since") == 0, 0).otherwise(F.call_function("shiftleft", F.lit(1), F.col("since")))
    neighbours = array.withColumn("reach", bound).where("reach > 0").join(before, "slot")
    pairs = store(with_heads(neighbours.select("slot", "stretch", "at", "other", "other_at", "reach")), "neighbours")
    compared = common_lines(pairs.where("head"), sequences).select("slot", "lcp")
    last = F.last(F.when(F.col("head"), F.struct("at", "lcp")), ignorenulls=True).over(Window.partitionBy("stretch").orderBy("at"))
    shared = pairs.join(compared, "slot", "left").select("slot", (last["lcp"] - (F.col("at") - last["at"])).alias("lcp"))
    # each suffix with what it shares with the one before and the one behind, of which the larger bounds what it shares with any
    ends = shared.unionAll(shared.select(F.col("slot") - 1, -F.col("lcp"))).groupBy("slot").agg(F.max("lcp").alias("lcp"), (-F.min("lcp")).alias("behind"))
    known = lambda c: F.greatest(F.coalesce(F.col(c), F.lit(0)), F.lit(0))
    intervals = (
        array.select("slot", "stretch", "at")
        .join(needed_lines(sequences, min_words), ["stretch", "at"])
        .join(ends, "slot", "left")
        .withColumn("opens", (known("lcp") < F.col("needed")).cast("long"))
        .withColumn("reach", F.greatest(known("lcp"), known("behind")).cast("int"))
        .where("reach >= needed")
        .select("slot", "stretch", "mirrored", "at", "reach", "opens")
    )
    grouped, _ = numbered(intervals, ["slot"], "interval", "opens", "intervals")
    place = F.struct("stretch", F.when(F.col("mirrored"), -F.col("at")).otherwise(F.col("at")).alias("place"), "at")
    first = grouped.groupBy("interval").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    later = (
        grouped.join(first.where("n > 1"), "interval")
        .where("stretch <> first.stretch OR at <> first.at")
        .select("stretch", "at", F.col("first.stretch").alias("other"), F.col("first.at").alias("other_at"), "reach")
    )
    heads = with_heads(later).where("head")
    return common_lines(heads, sequences).select("stretch", "at", F.col("lcp").alias("length"), "other", "other_at")


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """_id, _text_key, spans: for each document with deleted lines the spans (from, length) of lines to delete.

    docs: _id, _text_key, text.
    """
    found = store(stretches(store(line_arrays(docs), "lines"), min_words), "stretches")
    place = F.struct(*KEYS, "start")
    groups = found.groupBy("ids").agg(F.min(place).alias("p"), F.min("words").alias("words"))
    alone = groups.select("p._id", "p._text_key", "p.start", "ids", "words")
    forwards, _ = numbered(alone, [*KEYS, "start"], "stretch", label="stretch-order")
    tagged = lambda tag: F.transform("ids", lambda x: F.concat(F.lit(tag), x))
    both = forwards.select(
        *KEYS, "start",
        F.explode(
            F.array(
                F.struct((2 * F.col("stretch")).alias("stretch"), F.lit(False).alias("mirrored"), tagged(b"f").alias("ids"), "words"),
                F.struct((2 * F.col("stretch") + 1).alias("stretch"), F.lit(True).alias("mirrored"), F.reverse(tagged(b"m")).alias("ids"), F.reverse("words").alias("words")),
            )
        ).alias("s"),
    )
    sequences = store(both.select(*KEYS, "start", "s.*"), "sequences")
    runs = repeated_runs(sequences, min_words).join(sequences.select("stretch", "mirrored", *KEYS, "start", F.size("ids").alias("n")), "stretch")
    begin = F.col("start") + F.when(F.col("mirrored"), F.col("n") - F.col("at") - F.col("length")).otherwise(F.col("at"))
    inside = runs.select(*KEYS, begin.cast("int").alias("from"), F.col("length").cast("int").alias("length"))
    copies = found.join(groups.select("ids", "p"), "ids").where(place != F.col("p"))
    whole = copies.select(*KEYS, F.col("start").cast("int").alias("from"), F.size("ids").alias("length"))
    return inside.unionByName(whole).groupBy(*KEYS).agg(F.collect_set(F.struct("from", "length")).alias("spans"))


def without_later_copies(docs: DataFrame, text: str = "text", id: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """All columns of ``docs`` with the text less later copies, plus n_lines and n_deleted_lines (longs; such columns of ``docs`` are replaced).

    A run of lines is repeated if the same lines, without white space around them, follow each other elsewhere and hold at least
    ``min_words`` words; it is as long as its first copy goes on equally.  First is by id (NULL first), then by
    digest of the text, then by place; overlapping copies in one text count too.  Rows with the same id and text are one document and
    treated alike.  Texts without copies stay as they are, NULL stays NULL with 0 lines; an empty text is one line.
    """
    keyed = docs.select(F.col(f"`{id}`").alias("_id"), F.xxhash64(f"`{text}`").alias("_text_key"), F.col(f"`{text}`").alias("text"))
    spans = store(later_copies(keyed, min_words), "spans")
    key = F.struct(F.col("_id").alias("id"), F.col("_text_key").alias("text_key"))
    rows, names = renamed(docs)
    body = names[text]
    keyed = rows.withColumn("_key", F.struct(F.col(names[id]).alias("id"), F.xxhash64(body).alias("text_key")))
    found = keyed.join(spans.select(key.alias("_key"), "spans"), "_key", "left").withColumn("_lines", F.when(F.col("spans").isNotNull(), F.split(body, "\n", -1)))
    inside = lambda i: F.exists("spans", lambda s: (i >= s["from"]) & (i < s["from"] + s["length"]))
    found = found.withColumn("_kept", F.filter("_lines", lambda line, i: ~inside(i)))
    breaks = F.octet_length(body) - F.octet_length(F.replace(F.col(body), F.lit("\n"), F.lit("")))
    new = {
        text: F.when(F.col("spans").isNull(), F.col(body)).otherwise(F.array_join("_kept", "\n")),
        "n_lines": F.coalesce(breaks + 1, F.lit(0)).cast("long"),
        "n_deleted_lines": F.when(F.col("spans").isNull(), 0).otherwise(F.size("_lines") - F.size("_kept")).cast("long"),
    }
    old = [c for c in docs.columns if c not in new]
    order = [c for c in docs.columns if c in (*old, text)] + ["n_lines", "n_deleted_lines"]
    return found.select(*[(new[c] if c in new else F.col(names[c])).alias(c) for c in order])
