"""CSV files with quoted line breaks, read by many tasks.

Spark splits a file into ranges of lines, but a record may begin in one range and end in another, and whether a line starts inside quotes
depends on everything before it.  So the ranges are read twice.  The first time each reports, for both states it may start in, its state at the
end and the pieces of records that reach over its borders.  The states are then composed from range to range, which tells where every range really
starts.  The second time each task puts together the records that begin and end in its own range.  Records over borders come from the pieces.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewgrain.operators.scaling import importable

#: Characters of one record at most, against a quote that is never closed, and ranges whose states are sent to all tasks.
LONGEST, RANGES = 256_000_000, 2_000_000
_TO_QUOTE = re.compile('[^"]*(?:""[^"]*)*')

RANGE = "file string, start long"


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line ends inside quotes, for a line that starts inside quotes or at a field's beginning.

    A quote opens a field only as its first character and is written twice inside; after the closing one a field goes on to the next comma.
    """
    at, n = 0, len(line)
    while True:
        if not inside:
            at = line.find('"', at)
            if at < 0:
                return False
            if at and line[at - 1] != ",":
                at = line.find(",", at)
                if at < 0:
                    return False
                continue
            at += 1
        at = _TO_QUOTE.match(line, at).end()
        if at >= n:
            return True
        inside = False
        at = line.find(",", at)
        if at < 0:
            return False


def unended(record: str) -> str:
    """A record without the carriage return of its line end; one that has it also has its inner line breaks read as line feeds."""
    return record[:-1].replace("\r\n", "\n") if record.endswith("\r") else record


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, start (of the range), line; only a line feed ends a line, so that other line breaks inside quotes stay."""
    text = spark.read.text(path, lineSep="\n")
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))


class _Range:
    """The lines of one range under one starting state."""

    def __init__(self, inside: bool):
        self.inside = self.started = inside
        self.open: list[str] = []  # lines of a record that hasn't ended; the first one's record began before the range if ``crossing``
        self.crossing = inside
        self.size = self.own = 0

    def add(self, line: str, quoted: bool) -> tuple[str, bool] | None:
        """A record that ends with this line, and whether it began before the range; none for an empty line between records."""
        if quoted:
            self.inside = ends_inside(line, self.inside)
        if not self.inside and not self.open and not self.crossing:
            line = line.removesuffix("\r")
            self.own += line != ""
            return (line, False) if line else None
        self.open.append(line)
        self.size += len(line) + 1
        if self.size > LONGEST:
            raise ValueError(f"a record is longer than {LONGEST} characters; is a quote never closed?")
        if self.inside:
            return None
        text = "\n".join(self.open)
        done = text if self.crossing else unended(text), self.crossing
        self.own += not self.crossing
        self.open, self.crossing, self.size = [], False, 0
        return done


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[str]]]:
    """Every line with its range; lines of a range follow each other."""
    for batch in batches:
        yield from zip(zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True), batch.column("line").to_pylist(), strict=True)


def reported(lines: DataFrame) -> DataFrame:
    """Per range and starting state: file, start, state, ending (state), own (records that begin and end in it), head, tail.

    head: the rest of a record from an earlier range, NULL if the range holds no end of it; tail: the beginning of a record that goes on
    in the next range, or all lines where a record neither begins nor ends.
    """
    schema = pa.schema([("file", pa.string()), ("start", pa.int64()), ("state", pa.bool_()), ("ending", pa.bool_()), ("own", pa.int64()), ("head", pa.string()), ("tail", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, states, heads = None, [], [None, None]

        def report() -> Iterator[pa.RecordBatch]:
            if now is not None:
                rows = [(*now, r.started, r.inside, r.own, head, "\n".join(r.open) if r.open else None) for r, head in zip(states, heads, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for place, line in _ranges(batches):
            if place != now:
                yield from report()
                now, states, heads = place, [_Range(False), _Range(True)], [None, None]
            quoted = '"' in line
            for k, r in enumerate(states):
                done = r.add(line, quoted)
                if done is not None and done[1]:
                    heads[k] = done[0]
        yield from report()

    return lines.mapInArrow(run, f"{RANGE}, state boolean, ending boolean, own long, head string, tail string")


def composed(reports: DataFrame) -> DataFrame:
    """The state every range really starts in: file, start, inside.

    Only flags are moved here, a row per range.  A range either fixes its ending whatever it starts in, keeps the state, or turns it round; so the
    state is that of the last range that fixes it, turned by those that turn between.
    """
    ends = reports.groupBy("file", "start").agg(F.max(F.when(~F.col("state"), F.col("ending"))).alias("e0"), F.max(F.when(F.col("state"), F.col("ending"))).alias("e1"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    turns = F.sum((F.col("e0") & ~F.col("e1")).cast("long"))
    counted = ends.withColumn("turned", F.coalesce(turns.over(before), F.lit(0))).withColumn("fixes", F.col("e0") == F.col("e1"))
    fixed = F.last(F.when(F.col("fixes"), F.struct(F.col("e0").alias("value"), "turned")), ignorenulls=True).over(before)
    last = counted.withColumn("fixed", fixed)
    value = F.coalesce(F.col("fixed.value"), F.lit(False)).cast("long") + F.col("turned") - F.coalesce(F.col("fixed.turned"), F.lit(0))
    return last.select("file", "start", (value % 2 == 1).alias("inside"))


def crossing_records(reports: DataFrame, states: DataFrame) -> DataFrame:
    """Records over range borders, put together from pieces: file, start, number, record, first.  They come last in the range where they begin."""
    flags = reports.select("file", "start", "state", F.col("head").isNotNull().alias("ends"), F.col("tail").isNotNull().alias("opens"))
    real = flags.join(states, ["file", "start"]).where("state = inside")
    real = real.select("file", "start", "state", (F.col("opens") & (~F.col("inside") | F.col("ends"))).alias("begins"))
    order = Window.partitionBy("file").orderBy("start")  # over flags, a row per range; the texts of a file join again by range
    opened = F.last(F.when(F.col("begins"), F.col("start")), ignorenulls=True)
    # the record that a head or a range without any end belongs to is the one opened last before
    earlier = real.withColumn("earlier", opened.over(order.rowsBetween(Window.unboundedPreceding, -1)))
    marked = reports.join(earlier, ["file", "start", "state"])
    pieces = F.array(
        F.struct(F.col("earlier").alias("record"), F.col("head").alias("text"), F.lit(None).cast("long").alias("own")),
        F.struct(F.when(F.col("begins"), F.col("start")).otherwise(F.col("earlier")).alias("record"), F.col("tail").alias("text"), F.when(F.col("begins"), F.col("own")).alias("own")),
    )
    each = marked.select("file", "start", F.explode(pieces).alias("p")).where("p.text IS NOT NULL")
    joined = each.groupBy("file", F.col("p.record").alias("record")).agg(
        F.array_sort(F.collect_list(F.struct("start", F.col("p.text").alias("text")))).alias("x"), F.sum(F.length("p.text")).alias("size"), F.max("p.own").alias("number")
    )
    text = F.array_join(F.col("x.text"), "\n")
    text = F.when(text.endswith("\r"), F.replace(F.regexp_replace(text, r"\r\z", ""), F.lit("\r\n"), F.lit("\n"))).otherwise(text)  # as unended
    whole = F.when(F.col("size") <= LONGEST, text).otherwise(F.raise_error(F.lit("a record is too long; is a quote never closed?")))
    return joined.select("file", F.col("record").alias("start"), "number", whole.alias("record"), ((F.col("record") == 0) & (F.col("number") == 0)).alias("first"))


def own_records(lines: DataFrame, states: DataFrame) -> DataFrame:
    """Records that begin and end in one range: file, start, number, record, first."""
    if states.where("inside").limit(RANGES + 1).count() > RANGES:
        raise ValueError(f"more than {RANGES} ranges start inside quotes; set a larger spark.sql.files.maxPartitionBytes")
    placed = lines.join(F.broadcast(states.where("inside")), ["file", "start"], "left").select("file", "start", "line", F.coalesce("inside", F.lit(False)).alias("inside"))
    schema = pa.schema([("file", pa.string()), ("start", pa.int64()), ("number", pa.int64()), ("record", pa.string()), ("first", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, number = None, _Range(False), 0
        for batch in batches:
            out: list[tuple] = []
            insides = batch.column("inside").to_pylist()
            for k, (place, line) in enumerate(_ranges(iter([batch]))):
                if place != now:
                    now, state, number = place, _Range(insides[k]), 0
                done = state.add(line, '"' in line)
                if done is not None and not done[1]:
                    out.append((*place, number, done[0], place[1] == number == 0))
                    number += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return placed.mapInArrow(run, f"{RANGE}, number long, record string, first boolean")


def records(spark: SparkSession, path: str, store: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Every record of the files at ``path`` as text, headers included: file, start (of the range it begins in), number (in that range, from 0), record, first (of its file).

    store: writes a table and gives it back; the reports, two rows per range, are read twice.  Empty lines between records are
    skipped.  Carriage returns before line feeds belong to the line break where the record ends with one, else to the text.  An unclosed quote takes in the rest of its file, as one record, up to LONGEST characters.
    """
    importable(spark)
    lines = _lines(spark, path)
    reports = store(reported(lines))
    states = store(composed(reports))
    return own_records(lines, states).unionByName(crossing_records(reports, states))


def read(spark: SparkSession, path: str, store: Callable[[DataFrame], DataFrame], position: str | None = None) -> DataFrame:
    """The rows that Spark's own reader gives for files with a header and quoted line breaks (multiLine), all columns as text, but from many tasks.

    position: name of an added column that orders the rows as in the files.
    """
    names = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"').columns  # reads one record
    schema = ", ".join("`" + name.replace("`", "``") + "` string" for name in names)
    found = records(spark, path, store).where("NOT first")
    row = F.from_csv("record", schema, {"quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"})
    place = [] if position is None else [F.struct("file", "start", "number").alias(position)]
    return found.select(row.alias("row"), *place).select("row.*", *([] if position is None else [position]))
