"""What several operators need: tables in the shared folder, cumulative ranks, connected components."""

from __future__ import annotations

import math
import os
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewgrain.operators.scaling import store

#: Rows and bytes of one Arrow batch that a Python task hands back.
ROWS_OUT, BYTES_OUT = 2_000, 16_000_000

__all__ = ["Batches", "bounded_sample", "components", "importable", "numbered", "partitions", "renamed", "store", "texts"]


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package; a cluster gets it with --py-files."""
    root, env = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts(batch: pa.RecordBatch, name: str) -> Iterator[str | None]:
    """The values of a text column one by one, so that a batch is never held twice."""
    for value in batch.column(name):
        yield value.as_py()


class Batches:
    """Collects output rows and gives them back as Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema = schema
        self.rows: list[tuple] = []
        self.bytes = 0

    def add(self, row: tuple, size: int = 64) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.bytes += size
        if len(self.rows) >= ROWS_OUT or self.bytes >= BYTES_OUT:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = zip(*self.rows, strict=True)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)]
            self.rows, self.bytes = [], 0
            yield pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def renamed(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The table with columns c0, c1 and so on, which clash with no name used here, and the new name of each old one."""
    names = {name: f"c{i}" for i, name in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def bounded_sample(rows: DataFrame, digest: Column, most: int, total: int) -> DataFrame:
    """At most ``most`` rows, those with the smallest ``digest`` (a long) of about twice as many that pass a cut on it.

    total: the number of rows, or more.  The cut is made where the rows are, so that what is sent on is about
    2 * ``most`` rows however many tasks there are.
    """
    buckets = 1 << 30
    cut = min(buckets, math.ceil(buckets * 2 * most / max(total, 1)))
    return rows.where(F.pmod(digest, F.lit(buckets)) < cut).orderBy(F.pmod(digest, F.lit(buckets)), digest).limit(most)


def numbered(
    rows: DataFrame, order: Sequence[str], name: str, weight: str | None = None, label: str = "numbered"
) -> tuple[DataFrame, int]:
    """Add ``name``: the running sum of ``weight`` (1 if None) in ``order``, the own row included; and the number of rows.

    ``order`` must be a total order of the rows, so that ranges are even whatever
    value is frequent.  Range partitions are summed in parallel; the driver adds
    up one number per partition.  The rows are stored, because the sampled range
    bounds of a second run could differ.
    """
    spark = rows.sparkSession
    weight_of = F.lit(1).cast("long") if weight is None else F.col(weight).cast("long")
    dealt = (
        rows.withColumn("_weight", weight_of)
        .repartitionByRange(partitions(spark), *order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
    )
    names = rows.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for batch in batches:
            sums = np.cumsum(batch.column("_weight").to_numpy(zero_copy_only=False)) + before
            before = int(sums[-1]) if len(sums) else before
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), batch.column("_part"), pa.array(sums, pa.int64())],
                [*names, "_part", "_sum"],
            )

    summed = store(dealt.mapInArrow(add_up, f"{schema}, _part int, _sum long"), label)
    ends = sorted(tuple(r) for r in summed.groupBy("_part").agg(F.max("_sum"), F.count(F.lit(1))).collect())
    offsets, before = [], 0
    for part, total, _ in ends:
        offsets.append((part, before))
        before += total
    starts = spark.createDataFrame(offsets, "_part int, _before long")
    added = summed.join(F.broadcast(starts), "_part").withColumn(name, F.col("_sum") + F.col("_before"))
    return added.drop("_part", "_sum", "_before"), sum(n for *_, n in ends)


def components(links: DataFrame, label: str = "links") -> DataFrame:
    """Connected components of undirected ``links`` (a, b): rows (node, root), one per linked node.

    Contraction: every node picks the member of its closed neighbourhood with the
    smallest pseudo-random number of the round, linked picks become one node, and
    so on until no link is left.  The expected number of nodes falls by a constant
    factor, so rounds grow with the logarithm of the nodes whatever the shape.
    Each round only takes minima per node (combined in the map tasks) and joins to
    one row per node; every table is written to the shared folder.
    """
    spark = links.sparkSession
    edges = store(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), label)
    picks: list[DataFrame] = []
    number = 0
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(
            edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        rated = lambda c: F.struct(F.xxhash64(F.lit(number), F.col(c)).alias("h"), F.col(c).alias("n"))
        best = both.groupBy("node").agg(F.min(rated("other")).alias("other"))
        pick = store(best.select("node", F.least("other", rated("node"))["n"].alias("root")), f"{label}-pick{number}")
        picks.append(pick)
        edges = store(
            edges.join(pick.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a")
            .join(pick.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
            .where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .distinct(),
            f"{label}-{number}",
        )
        number += 1
    if not picks:
        return spark.createDataFrame([], "node long, root long")
    out = picks[0]
    for pick in picks[1:]:
        out = (
            out.join(pick.select(F.col("node").alias("root"), F.col("root").alias("next")), "root", "left")
            .select("node", F.coalesce("next", "root").alias("root"))
        )
    return out
