"""URL rules looked up in a Bloom filter cascade.

Every key that a URL could match (each parent domain of its host with each prefix of its path as long as some rule's path) is a key
of the corpus.  Level 1 encodes the listed keys; the corpus keys that it lets through by mistake are
encoded in level 2; the listed keys that level 2 lets through go to level 3, and so on until nobody is left.
A corpus key is listed if and only if the first level that refuses it has an even number
(or, if none does, the number of levels is odd): exact membership without a join, for all keys of the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewgrain.llm.shared import store

#: False positive rates of level 1 and of the others, and the least number of bits of a level.
FIRST_RATE, OTHER_RATE, LEAST_BITS = 0.01, 0.5, 1 << 10
#: Levels after which building gives up (each level halves what is left, so this is never reached by honest hashes).
MOST_LEVELS = 60
ALLOW, BLOCK = "allow", "block"


def parts(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a URL; both empty if it is NULL or has no ``://``."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, path = rest[:end], rest[end:]
    stop = min((i for i in map(path.find, "?#") if i >= 0), default=len(path))
    return host.translate(LOWER), path[:stop]


LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def host_and_path(url: str):
    """The same as columns: (host, path)."""
    url = F.coalesce(F.col(url), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)?", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def candidates(host: str, path: str, lengths: Sequence[int]) -> list[str]:
    """The keys that could decide about a URL, the longest first, ties with the longer host first.

    A key is a domain of the host, a tab and a prefix of the path as long as some rule's path.
    """
    if not host:
        return []
    labels = host.split(".")
    domains = [".".join(labels[i:]) for i in range(len(labels))]
    found = [(len(d) + n, len(d), f"{d}\t{path[:n]}") for d in domains if d for n in lengths if n <= len(path)]
    return [key for *_, key in sorted(found, key=lambda x: (-x[0], -x[1]))]


class Level:
    """One Bloom filter: bits, and a level number that makes its hashes its own."""

    def __init__(self, number: int, bits: int, hashes: int, data: np.ndarray):
        self.number, self.bits, self.hashes, self.data = number, bits, hashes, data

    def has(self, key: str) -> bool:
        data = self.data
        return all(data[at >> 6] >> (at & 63) & 1 for at in places(key, self.number, self.bits, self.hashes))


def places(key: str, number: int, bits: int, hashes: int) -> list[int]:
    """The bits of a key in a level, from the two halves of one 128-bit digest."""
    digest = xxhash.xxh3_128_intdigest(key.encode("utf-8", "surrogatepass"), number)
    a, b = digest & (1 << 64) - 1, digest >> 64 | 1
    return [(a + i * b) % (1 << 64) % bits for i in range(hashes)]


def build_level(keys: DataFrame, number: int, count: int, rate: float) -> Level:
    """A filter of ``count`` keys: each task sets bits of words, words are or-ed together.

    What reaches the driver is the filter itself: at most bits / 64 words.
    """
    bits = max(LEAST_BITS, math.ceil(-count * math.log(rate) / math.log(2) ** 2))
    hashes = max(1, round(-math.log2(rate)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: dict[int, int] = {}
            for key in batch.column("key").to_pylist():
                for at in places(key, number, bits, hashes):
                    words[at >> 6] = words.get(at >> 6, 0) | 1 << (at & 63)
            masks = np.array(list(words.values()), np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(list(words), pa.int64()), pa.array(masks)], ["word", "mask"])

    data = np.zeros((bits + 63) // 64, np.uint64)
    for word, mask in keys.select("key").mapInArrow(run, "word long, mask long").groupBy("word").agg(F.bit_or("mask")).collect():
        data[word] = np.array([mask], np.int64).view(np.uint64)[0]
    return Level(number, bits, hashes, data)


def passing(keys: DataFrame, level: Level) -> DataFrame:
    """The keys that a level lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [key for key in batch.column("key").to_pylist() if level.has(key)]
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.string())], ["key"])

    return keys.select("key").mapInArrow(run, "key string")


def build(listed: DataFrame, universe: DataFrame, first_rate: float = FIRST_RATE) -> list[Level]:
    """The cascade of ``listed`` keys over a ``universe`` of keys (both: column key, distinct).

    The listed keys are joined to the universe only here, once, to know which of the keys that level 1 lets through are
    not listed.  Level 1 lets through that share of the universe; each later level halves what the one before it let through.
    So a filter's size follows the list and that share, and only filters reach the driver.
    """
    levels: list[Level] = []
    inside, outside = store(listed.select("key").distinct(), "listed"), universe.select("key")
    count = inside.count()
    while count and len(levels) < MOST_LEVELS:
        level = build_level(inside, len(levels) + 1, count, OTHER_RATE if levels else first_rate)
        levels.append(level)
        passed = passing(outside, level)
        if len(levels) == 1:
            passed = passed.join(inside, "key", "left_anti")
        inside, outside = store(passed, f"level{len(levels)}"), inside
        count = inside.count()
    if count:
        raise ValueError("the cascade does not end")
    return levels


def listed_in(levels: list[Level], key: str) -> bool:
    """Whether a key of the universe is listed."""
    for level in levels:
        if not level.has(key):
            return level.number % 2 == 0
    return len(levels) % 2 == 1


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules (verdict, host, path) as a table; hosts are lower-cased."""
    return spark.createDataFrame([(v, h.translate(LOWER), p) for v, h, p in rules], "verdict string, host string, path string")


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", keep: list[str] | None = None, default: str = ALLOW) -> DataFrame:
    """The columns ``keep`` (default page_id) plus host, path, rule and verdict of every row.

    rules: verdict, host, path.  A rule fits its host and all subdomains if the path starts with the rule's; the longest
    rule wins.  A URL that no rule fits, a NULL and a URL without ``://`` get rule NULL and ``default``.  Of rules
    with the same host and path the one that blocks holds; rules with a NULL are ignored.  The cascade has two lists, the allowed and the
    blocked keys, so a URL's verdict is read from the filters alone.  Repeated rows get equal results.
    """
    spark = pages.sparkSession
    keep = ["page_id"] if keep is None else keep
    host, path = host_and_path("_url")
    rows = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{url}`").alias("_url"))
    rows = rows.withColumns({"_host": host, "_path": path}).drop("_url")
    known = rules.where("verdict IS NOT NULL AND host IS NOT NULL AND path IS NOT NULL")
    lists = store(
        known.select("verdict", F.concat_ws("\t", "host", "path").alias("key"), F.length("path").alias("n"))
        .groupBy("key", "n")
        .agg(F.max("verdict").alias("verdict")),  # block sorts after allow
        "rules",
    )
    lengths = sorted(r[0] for r in lists.select("n").distinct().collect())

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = set(zip(batch.column("_host").to_pylist(), batch.column("_path").to_pylist(), strict=True))
            keys = {k for h, p in pairs for k in candidates(h, p, lengths)}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(keys), pa.string())], ["key"])

    universe = store(rows.select("_host", "_path").mapInArrow(spread, "key string").distinct(), "universe")
    cascades = {v: build(lists.where(F.col("verdict") == v), universe) for v in (BLOCK, ALLOW)}
    names = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep]
    schema = ", ".join([*names, "host string", "path string", "rule string", "verdict string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = batch.column("_host"), batch.column("_path")
            rules, verdicts = [], []
            for h, p in zip(hosts.to_pylist(), paths.to_pylist(), strict=True):
                found = ((k, v) for k in candidates(h, p, lengths) for v in cascades if listed_in(cascades[v], k))
                key, verdict = next(found, (None, default))
                rules.append(key and key.replace("\t", ""))
                verdicts.append(verdict)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), hosts, paths, pa.array(rules, pa.string()), pa.array(verdicts, pa.string())],
                [*keep, "host", "path", "rule", "verdict"],
            )

    return rows.mapInArrow(run, schema)
