"""Quality rules with an isolation forest over rule statistics.

Base rules count words, symbols, repeated lines and repeated 5-word windows of whole texts.  An isolation
forest cuts random features of the statistics at random values: a document that few cuts set apart, that
is, with short paths, is anomalous.  Trees hold good rows, but their cuts are drawn from the range of good and bad
rows, so that a value no good row has ends in an empty branch after few cuts.  The threshold
on the anomaly is calibrated on labelled rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewgrain.llm.shared import bounded_sample, store, texts

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
#: Labelled rows used for the fit at most, trees, rows per tree, cuts on a path at most.
FIT_ROWS, TREES, TREE_ROWS, DEPTH = 8192, 100, 256, 12
#: Steps of the score that the threshold is looked for on, and the share of good rows it may reject at most.
STEPS, MAX_GOOD_LOSS = 1000, 0.005
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("symbols", "dup_lines", "repeated_words", "capitals", "other_chars")


@cache
def character_tables() -> tuple[np.ndarray, np.ndarray]:
    """Which 16-bit characters are upper-case letters and which are letters."""
    return tuple(np.array([test(chr(c)) for c in range(1 << 16)], np.uint8) for test in (str.isupper, str.isalpha))


def statistics(text: str | None) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_capitals, n_other of a whole text.

    Words are runs without ASCII white space.  n_capitals counts upper-case letters, n_other characters of words that are
    neither letters nor symbols.  A NULL is a text without words.
    """
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return 0, 0, sum(map(text.count, SYMBOLS)), 0, 0, 0, 0
    joined = b"".join(words)
    word_chars = len(joined) - int(np.count_nonzero((np.frombuffer(joined, np.uint8) & 0xC0) == 0x80))
    n_symbols = sum(map(text.count, SYMBOLS))
    lines, n_dup_lines = set(), 0
    for line in data.split(b"\n"):
        if line in lines:
            n_dup_lines += 1
        elif line.strip():
            lines.add(line)
    n_repeat_words = 0
    windows = list(zip(*(words[i:] for i in range(WINDOW)), strict=False))
    if len(set(windows)) < len(windows):
        first: dict[tuple, int] = {}
        covered = np.zeros(len(words) + 1, np.int32)
        for i, window in enumerate(windows):
            j = first.setdefault(window, i)
            if j != i:
                covered[i] += 1
                covered[i + WINDOW] -= 1
                covered[j] += 1
                covered[j + WINDOW] -= 1
        n_repeat_words = int(np.count_nonzero(np.cumsum(covered[:-1]) > 0))
    upper, alpha = character_tables()
    codes = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), "<u2")
    capitals, letters = int(upper[codes].sum(dtype=np.int64)), int(alpha[codes].sum(dtype=np.int64))
    return len(words), word_chars, n_symbols, n_dup_lines, n_repeat_words, capitals, max(0, word_chars - letters - n_symbols)


def measure(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default doc_id), the statistics and base_failed of every row."""
    keep = ["doc_id"] if keep is None else keep
    names = [*STATISTICS, "n_capitals", "n_other"]
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_text"))
    schema = ", ".join([*(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep), *(f"{n} long" for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([statistics(t) for t in texts(batch, "_text")], np.int64).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), *(pa.array(found[:, i]) for i in range(len(names)))], [*keep, *names]
            )

    out = rows.mapInArrow(run, schema)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def features(columns: dict[str, np.ndarray]) -> np.ndarray:
    """The statistics as shares of words or characters on a logarithmic scale, one row per document."""
    c = {k: np.asarray(v, float) for k, v in columns.items()}
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)
    shares = (
        c["n_symbols"] / chars,
        c["n_dup_lines"] / words,
        c["n_repeat_words"] / words,
        c["n_capitals"] / chars,
        c["n_other"] / chars,
    )
    return np.log1p(100 * np.column_stack(shares))


def average_path(n: float) -> float:
    """Mean path length of an unsuccessful search in a binary tree of n rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


class Forest:
    """Isolation trees as arrays: feature, cut, children, and the path length at the leaves."""

    def __init__(self, rows: np.ndarray, box: tuple[np.ndarray, np.ndarray], trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 7):
        rng = np.random.default_rng(seed)
        take = min(tree_rows, len(rows))
        self.usual = max(average_path(take), 1.0)
        self.roots, nodes = [], []
        for _ in range(trees):
            self.roots.append(len(nodes))
            self._grow(rows[rng.choice(len(rows), take, replace=False)], *box, 0, nodes, rng)
        self.feature, self.cut, self.left, self.right, self.path = map(np.array, zip(*nodes, strict=True))

    def _grow(self, rows: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int, nodes: list, rng) -> int:
        at = len(nodes)
        nodes.append((0, np.inf, at, at, depth + average_path(len(rows))))
        usable = np.flatnonzero(high > low)
        if depth < DEPTH and len(rows) > 1 and len(usable):
            feature = int(rng.choice(usable))
            cut = float(rng.uniform(low[feature], high[feature]))
            below = rows[:, feature] < cut
            middle = np.where(np.arange(len(low)) == feature, cut, high)
            left = self._grow(rows[below], low, middle, depth + 1, nodes, rng)
            middle = np.where(np.arange(len(low)) == feature, cut, low)
            right = self._grow(rows[~below], middle, high, depth + 1, nodes, rng)
            nodes[at] = (feature, cut, left, right, 0.0)
        return at

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly of each row, 0 to 1: 2 ** -(mean path / usual path)."""
        total, lines = np.zeros(len(rows)), np.arange(len(rows))
        for root in self.roots:
            at = np.full(len(rows), root)
            for _ in range(DEPTH):
                at = np.where(rows[lines, self.feature[at]] < self.cut[at], self.left[at], self.right[at])
            total += self.path[at]
        return 2.0 ** (-total / len(self.roots) / self.usual)


def fit(measured: DataFrame, labels: DataFrame, id: str = "doc_id", fit_rows: int = FIT_ROWS) -> Forest | None:
    """Grow the forest from at most ``fit_rows`` labelled rows that pass the base rules.

    Rows are chosen by a digest of id and statistics.  Trees hold those of the best quality, the ranges of the cuts come
    from all of them; without labels any rows are taken.  None if there is no row at all.
    """
    marks = labels.groupBy(F.col("doc_id").alias("_mark")).agg(F.max("quality").alias("_quality"))
    known = measured.where("NOT base_failed").join(marks, F.col(f"`{id}`") == F.col("_mark"), "left")
    used = [*STATISTICS, "n_capitals", "n_other"]
    labelled = known.where("_quality IS NOT NULL")
    total = labelled.count()
    pool, total = (labelled, total) if total else (known, known.count())
    digest = F.xxhash64(F.col(f"`{id}`").cast("string"), *used)
    rows = bounded_sample(pool, digest, fit_rows, total).select("_quality", *used).toPandas()
    if rows.empty:
        return None
    quality = rows["_quality"].fillna(-1).to_numpy()
    found = features({c: rows[c].to_numpy() for c in rows.columns if c != "_quality"})
    return Forest(found[quality == quality.max()], (found.min(axis=0), found.max(axis=0)))


def score(measured: DataFrame, forest: Forest | None) -> DataFrame:
    """Add anomaly (0 to 1; 0 without a forest) to measured rows."""
    names = measured.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in measured.schema.fields)
    used = [*STATISTICS, "n_capitals", "n_other"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = features({c: batch.column(c).to_numpy() for c in used})
            values = np.zeros(len(rows)) if forest is None else forest.score(rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())], [*names, "anomaly"])

    return measured.mapInArrow(run, f"{schema}, anomaly double")


def calibrate(scored: DataFrame, labels: DataFrame, id: str = "doc_id", max_good_loss: float = MAX_GOOD_LOSS) -> float:
    """The score from which on a document is rejected.

    Of the thresholds that reject at most ``max_good_loss`` of the good labelled rows, the one with the largest share
    of bad rows less share of good rows rejected.  All labelled rows count that pass the base rules; only counts
    per step of the score reach the driver.  Without bad rows nothing is rejected.
    """
    marks = labels.groupBy(F.col("doc_id").alias("_mark")).agg(F.max("quality").alias("_quality"))
    counted = (
        scored.where("NOT base_failed")
        .join(marks.where("_quality IS NOT NULL"), F.col(f"`{id}`") == F.col("_mark"))
        .groupBy(F.floor(F.col("anomaly") * STEPS).cast("int").alias("step"))
        .agg(F.sum((F.col("_quality") > 0).cast("long")).alias("good"), F.sum((F.col("_quality") <= 0).cast("long")).alias("bad"))
        .orderBy(F.desc("step"))
        .collect()
    )
    good, bad = sum(r["good"] for r in counted), sum(r["bad"] for r in counted)
    best, cut, lost, found = 0.0, 2.0, 0, 0
    for r in counted:
        lost, found = lost + r["good"], found + r["bad"]
        if bad and lost <= max_good_loss * good:
            gain = found / bad - (lost / good if good else 0)
            if gain > best:
                best, cut = gain, r["step"] / STEPS
    return cut


def judge(docs: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """id, the statistics, base_failed, anomaly and kept for every row.

    kept is false if the base rules fail, else whether the anomaly is below the calibrated threshold.  NULL and empty texts have
    no words and fail the base rules.  Repeated rows are judged alike; rows with a NULL id are judged but
    never used to fit.  Without labels nothing but the base rules rejects.  The statistics are
    stored once and used for the fit, the threshold and the result.
    """
    measured = store(measure(docs.select(F.col(f"`{id}`").alias("_id"), F.col(f"`{text}`").alias("text")), keep=["_id"]), "statistics")
    forest = fit(measured, labels, "_id")
    scored = store(score(measured, forest), "scored")
    cut = calibrate(scored, labels, "_id")
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < cut)).withColumnRenamed("_id", id)
