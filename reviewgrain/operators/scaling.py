"""How the other operators stay safe with hot keys, long lineages and big tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HOT_KEYS = 256
SALTS = 32
BROADCAST_ROWS = 20_000
BROADCAST_BYTES = 64_000_000
BUCKETS = 4096


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder.
    """
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.gettempdir() + "/reviewgrain-checkpoints"


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package; a cluster gets it with --py-files."""
    root, env = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark).rstrip('/')}/reviewgrain/{uuid.uuid4().hex}/{name}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and go on from there."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def store(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a wide intermediate table once and read it back as Parquet.

    Unlike a checkpoint the stored table still prunes columns and pushes filters.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def with_row_id(df: DataFrame, key: str | None = None) -> DataFrame:
    """Row ordinal needed by every "first" rule.

    A source key is used when there is one; generated ids are written out once,
    because they would change when a lost partition is computed again.
    """
    if key is not None:
        return df.withColumn("row_id", F.col(key))
    return cut_lineage(df.withColumn("row_id", F.monotonically_increasing_id()))


def hot_keys(counts: DataFrame, keys: Sequence[str], count: str, limit: int = HOT_KEYS) -> DataFrame:
    """The ``limit`` most frequent keys of a key-count table.

    At most ``limit`` rows by construction, so the result may be broadcast, and
    every key with more than 1/limit of all rows is in it.
    """
    known = counts.where(_all_known(keys))
    return (
        known.orderBy(F.desc(count), *keys).limit(limit).select(*keys, F.lit(True).alias("_hot"))
    )


def _all_known(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for key in keys:
        out = out & F.col(key).isNotNull()
    return out


def splits_skew(spark: SparkSession) -> bool:
    """True when the session splits oversized join partitions at run time."""
    wanted = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    return all(spark.conf.get(name, "true").lower() == "true" for name in wanted)


def spread_join(
    big: DataFrame, lookup: DataFrame, keys: Sequence[str], row_id: str, how: str = "left"
) -> DataFrame:
    """Join ``big`` to a table with one row per key, whatever share a key holds.

    A session with adaptive skew joins needs no help: it broadcasts the lookup
    if that turns out small, and otherwise cuts the partition of a hot key into
    even pieces of ``big``, without another pass over the table.  In other
    sessions the hot keys are looked up first and salted.
    """
    if splits_skew(big.sparkSession):
        return big.join(lookup, list(keys), how)
    return salted_join(big, lookup, keys, row_id, how)


def salted_join(
    big: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    row_id: str,
    how: str = "left",
    salts: int = SALTS,
) -> DataFrame:
    """The same join with explicit salts for the hottest keys and for missing keys.

    Only the hot rows of ``lookup`` are repeated, at most 256 x ``salts`` of them.
    """
    keys = list(keys)
    counts = big.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    hot = F.broadcast(hot_keys(counts, keys, "_rows"))
    spread = F.pmod(F.xxhash64(row_id), F.lit(salts)).cast("int")
    left = big.join(hot, keys, "left").withColumn(
        "_salt", F.when(F.col("_hot") | ~_all_known(keys), spread).otherwise(0)
    )
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1)))
    right = (
        lookup.join(hot, keys, "left")
        .withColumn("_salt", F.explode(F.coalesce(copies, F.array(F.lit(0)))))
        .drop("_hot")
    )
    return left.drop("_hot").join(right, [*keys, "_salt"], how).drop("_salt")


def is_small(lookup: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when a stored table has at most ``max_rows`` rows and ``max_bytes`` bytes, as JSON; stops counting there."""
    size = F.sum(F.octet_length(F.to_json(F.struct(*lookup.columns))))
    found = lookup.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(size, F.lit(0)).alias("bytes")).first()
    return found["n"] <= max_rows and found["bytes"] <= max_bytes


def attach(
    big: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    row_id: str,
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    small: bool | None = None,
) -> DataFrame:
    """Join to a lookup that is already stored; broadcast only after counting its rows and bytes.

    ``small`` passes on an answer of ``is_small`` for a table of the same size.  A larger lookup is joined with
    explicit salts: Spark does not split a hot key when the join feeds a grouping by the same key.
    """
    if is_small(lookup, max_rows) if small is None else small:
        return big.join(F.broadcast(lookup), list(keys), how)
    return salted_join(big, lookup, keys, row_id, how)


def attach_derived(
    big: DataFrame, lookup: DataFrame, keys: Sequence[str], row_id: str, how: str = "left"
) -> DataFrame:
    """Join to a lookup computed from big data that is expected to be small.

    The planner cannot know its size and would shuffle all of ``big`` on a few
    hot keys; so the lookup is stored, its rows counted, and broadcast if few.
    """
    return attach(big, cut_lineage(lookup), keys, row_id, how)


def dense_ordinal(df: DataFrame, key: str, name: str = "ordinal") -> DataFrame:
    """Number the rows 0..n-1 in the order of md5(key), without sorting in one task.

    ``key`` must be unique.  Rows fall into 4096 even hash buckets; the bucket
    offsets (at most 4096 rows) are the only thing that is accumulated globally.
    """
    digest = F.md5(F.col(key).cast("string"))
    keyed = df.withColumn("_digest", digest).withColumn("_bucket", F.substring("_digest", 1, 3))
    sizes = keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(_window([], ["_bucket"])) - F.col("_size")
    offsets = sizes.select("_bucket", before.alias("_before"))
    place = F.row_number().over(_window(["_bucket"], ["_digest", key]))
    return (
        keyed.withColumn("_place", place)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(name, F.col("_before") + F.col("_place") - 1)
        .drop("_digest", "_bucket", "_place", "_before")
    )


def _window(partition: Sequence[str], order: Sequence[str]):
    from pyspark.sql import Window

    return Window.partitionBy(*partition).orderBy(*order)


def first_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int, name: str = "place"
) -> DataFrame:
    """The first ``n`` rows of every group, numbered from 1 in column ``name``.

    For n <= 1000 Spark limits each group inside the map tasks before the
    shuffle, so a hot group sends at most n rows per task.
    """
    from pyspark.sql import Window

    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= n)
