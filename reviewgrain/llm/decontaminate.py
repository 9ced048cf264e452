"""Benchmark decontamination by template canonicalisation, with DataFrame functions only.

Numbers, units and names of a text become typed placeholders, so that a question asked again with other values has the
same template.  Names are known by their capitals, so a text with names is also read with the names as plain words: copies that
differ in case or line breaks share those templates.  Windows of template tokens are hash-joined; then the values in the placeholders are checked:
within one alignment of a document and an item, equal values of the item must
stand for equal values of the document, and the other way round.  Windows without a placeholder always count; of an
alignment with conflicting values, the largest agreeing part counts if it is long enough to be a passage of its own.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewgrain.llm.shared import renamed, store

#: Template tokens of a window; shorter items of at least SHORTEST tokens are one window; shorter ones must be the whole document or stand in it as they are.
WINDOW, SHORTEST = 8, 5
#: Items of so many tokens, below SHORTEST, are also found inside documents, word by word.
BRIEF = (3, 4)
#: Different pairs of neighbouring tokens of the benchmark that documents are pruned by; with more of them nothing is pruned, which only costs time.
PAIRS = 200_000
#: Share of an item's tokens that aligned windows must cover, or number of tokens that is enough for a longer item.
COVERED, ENOUGH = 0.5, 24
#: Window keys of the benchmark that are broadcast at most; beyond that the join is left to the planner.
BROADCAST_KEYS = 1_000_000
NUMBER, UNIT, NAME = "<num>", "<unit>", "<name>"
WINDOWS = "array<struct<at: int, size: int, key: bigint, weak: boolean>>"
#: Spelled-out numbers, and units that count as such after a number.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()
UNITS = (
    "mm cm m km in ft yd mi mile miles meter meters metre metres inch inches foot feet yard yards g kg mg lb lbs oz gram grams "
    "kilogram kilograms pound pounds ounce ounces ton tons s sec second seconds min minute minutes h hr hour hours day days week "
    "weeks month months year years l ml liter liters litre litres gallon gallons w kw v a hz k c f degree degrees percent dollar dollars "
    "euro euros cent cents mph kmh"
).split()


def marked(text: Column) -> Column:
    """The text with a mark before each number (\u0001), name (\u0002) and unit (\u0003), and . or , inside a number made part of it (\u0004).

    A name is a capitalised word after a word, number, comma, semicolon or bracket and one space, so not at the start of a sentence; a unit is a
    unit word or % after a number.  Spelled-out numbers carry no mark.  Any white space counts as one space.
    """
    clean = F.regexp_replace(F.coalesce(text, F.lit("")), "[\u0001-\u0004]", " ")
    clean = F.regexp_replace(clean, r"[\s\p{Z}]{2,}|[\s\p{Z}&&[^ ]]", " ")
    # patterns begin with the character itself and look back only then, as most places hold another one
    joined = F.regexp_replace(clean, r"[.,](?<=\p{N}[.,])(?=\p{N})", "\u0004")
    numbers = F.regexp_replace(joined, "\\p{N}(?<![\\p{L}\\p{M}\\p{N}\u0004]\\p{N})", "\u0001$0")
    names = F.regexp_replace(numbers, r"\p{Lu}(?<=[\p{L}\p{N},;)('’\"] \p{Lu})[\p{Ll}\p{M}]+(?![\p{L}\p{N}])", "\u0002$0")
    units = "|".join(sorted(UNITS, key=lambda u: (-len(u), u)))
    after_number = rf"(\p{{N}} ?)((?i:{units})(?![\p{{L}}\p{{N}}]))"
    return F.regexp_replace(F.regexp_replace(names, after_number, "$1\u0003$2"), r"(\p{N} ?)%", "$1 \u0003percent ")


def tokens(text: Column) -> Column:
    """The marked words and numbers of a text in order, lower-cased."""
    return F.array_remove(F.split(F.lower(marked(text)), "[^\\p{L}\\p{M}\\p{N}\u0001\u0002\u0003\u0004]+"), "")


def kind(token: Column) -> Column:
    """The typed placeholder of a token; NULL for a plain word."""
    by_mark = F.when(token.startswith("\u0002"), NAME).when(token.startswith("\u0003"), UNIT).when(token.startswith("\u0001"), NUMBER)
    return F.when(token < "\u0004", by_mark).when(token.isin(NUMBER_WORDS), NUMBER)


def _mixed(a: Column, b: Column) -> Column:
    return F.when(a.isNotNull() & b.isNotNull(), F.xxhash64(a, b))


#: What is combined over windows, and how: digests of templates and of values, numbers of plain words.
COMBINED = {"_template": _mixed, "_exact": _mixed, "_plain": lambda a, b: a + b}


def _part(name: str, width: int) -> str:
    return name if width == 1 else f"{name}{width}"


def _from(array: str, start: int) -> Column:
    """The rest of an array from its element ``start`` (0 is the first) on."""
    return F.slice(array, F.lit(start + 1), F.greatest(F.size(array) - start, F.lit(0)))


def _of_size(name: str, size: int) -> Column:
    """Per token, the windows of ``size`` tokens that start there, put together from windows of 2, 4, 8 tokens; NULL at the end."""
    width = 1 << (size.bit_length() - 1)
    out, have = F.col(_part(name, width)), width
    while have < size:
        width //= 2
        if have + width <= size:
            out, have = F.zip_with(out, _from(_part(name, width), have), COMBINED[name]), have + width
    return out


def _doubled(rows: DataFrame, name: str, most: int) -> DataFrame:
    """Add the windows of 2, 4, 8 tokens up to ``most``, one column each."""
    width = 1
    while 2 * width <= most:
        half = _part(name, width)
        rows, width = rows.withColumn(_part(name, 2 * width), F.zip_with(half, _from(half, width), COMBINED[name])), 2 * width
    return rows


def _chosen(size: int):
    return lambda h, plain: F.when(2 * plain >= size, h["a"]).otherwise(h["b"])


def _weak(size: int):
    """Templates of windows that are mostly placeholders but not only: keys of their own."""
    return lambda h, plain: F.when((2 * plain < size) & (plain > 0), F.xxhash64(h, F.lit("weak")))


def _readings(found: str) -> Column:
    """The tokens, and if there are names among them also the tokens with the names as plain words."""
    plain = F.transform(found, lambda t: F.replace(t, F.lit("\u0002"), F.lit("")))
    return F.when(F.exists(found, lambda t: t.startswith("\u0002")), F.array(F.col(found), plain)).otherwise(F.array(F.col(found)))


class Known:
    """What a document's tokens must be to match a window of the benchmark: every two that follow each other must do so, as template tokens, in some item."""

    def __init__(self, pairs: list[tuple[str, str]] | None, shortest: int):
        self.pairs, self.shortest = pairs, shortest

    def islands(self, rows: DataFrame, tokens: str) -> DataFrame:
        """One row per run of known pairs that can hold a window: _tokens, _first (its place in the text), _short (it is all of a short text)."""
        size = F.size(tokens)
        if self.pairs is None:
            return rows.withColumn("_first", F.lit(0)).withColumn("_short", size < SHORTEST).where(size > 0)
        short = rows.withColumn("_short", size < SHORTEST)
        known = _member(self.pairs)
        flags = short.withColumn("_symbols", F.transform(tokens, lambda t: F.coalesce(kind(t), t))).withColumn("_last", F.greatest(size - 1, F.lit(0)))
        # runs lie between the pairs that aren't known
        unknown = F.transform("_symbols", lambda t, i: F.when((i < F.col("_last")) & ~known(t, F.get("_symbols", i + 1)), i))
        borders = F.array_append(F.filter(unknown, lambda i: i.isNotNull()), F.col("_last"))
        flags = flags.withColumn("_borders", F.array_prepend(borders, F.lit(-1)))
        # only long runs become structs, as there is a border at most tokens
        runs = F.transform("_borders", lambda a, i: F.when(F.get("_borders", i + 1) - a >= self.shortest, F.struct((a + 1).alias("a"), (F.get("_borders", i + 1) - a).alias("n"))))
        whole = F.array(F.struct(F.lit(0).alias("a"), size.alias("n")))
        flags = flags.withColumn("_runs", F.when(F.col("_short"), whole).otherwise(F.filter(runs, lambda r: r.isNotNull())))
        out = flags.withColumn("_run", F.explode_outer("_runs")).where("_run.n > 0")
        cut = out.withColumn("_first", F.col("_run.a")).withColumn(tokens, F.slice(tokens, F.col("_run.a") + 1, F.col("_run.n")))
        return cut.drop("_symbols", "_last", "_borders", "_runs", "_run")


def _member(values: list[tuple[str, str]]) -> Callable[[Column, Column], Column]:
    """A test for pairs ``values`` by one bit each, so one that may also let others pass but never stops one of them."""
    size = 1 << max(10, (64 * len(values)).bit_length())
    bits = np.zeros(size, np.uint8)
    digest = lambda a, b: xxhash.xxh64_intdigest(b.encode("utf-8"), xxhash.xxh64_intdigest(a.encode("utf-8"), 42))  # noqa: E731 - as Spark's xxhash64 of both
    bits[[digest(a, b) & size - 1 for a, b in values]] = 1
    words = F.from_json(F.lit(json.dumps(np.packbits(bits, bitorder="little").view("<i8").tolist())), "array<bigint>")

    def test(a: Column, b: Column) -> Column:
        at = F.xxhash64(a, b).bitwiseAND(F.lit(size - 1)).cast("int")
        return F.getbit(F.get(words, F.call_function("shiftright", at, F.lit(6))), at.bitwiseAND(63)) == 1

    return test


def _pairs(symbols: str) -> Column:
    """Every two symbols of a column that follow each other, joined by a space."""
    pair = F.zip_with(symbols, F.slice(symbols, 2, F.greatest(F.size(symbols), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.slice(pair, 1, F.greatest(F.size(symbols) - 1, F.lit(0)))


def prepared(rows: DataFrame, sizes: list[int], known: Known | None = None) -> DataFrame:
    """Replace column _text by _tokens, _n, _first, _short and, for each size, key<size> and weak<size>: the keys of the windows that start at each token.

    A text with names gives two readings, the second one with the names as plain words.  With ``known`` there is a row per run of known tokens, at place _first of the text.
    A key is that of the template if at least half of the window is plain words, else that of the words and values themselves, as it is for windows below
    SHORTEST tokens; a weak key is the template of a window with fewer plain words, but some.
    A text with fewer than SHORTEST tokens has one window, itself, among those of WINDOW tokens.  Windows double from step to step; each step is a column
    of its own, so that nothing is computed again for each window.
    """
    kept = [c for c in rows.columns if c != "_text"]
    rows = rows.withColumn("_found", tokens(F.col("_text"))).drop("_text")
    rows = rows.select(*kept, F.explode_outer(_readings("_found")).alias("_tokens"))
    if known is not None:
        rows = known.islands(rows, "_tokens")
    else:
        rows = rows.withColumn("_first", F.lit(0)).withColumn("_short", F.size("_tokens") < SHORTEST)
    rows = rows.withColumn("_n", F.size("_tokens"))
    rows = rows.withColumns(
        {
            "_template": F.transform("_tokens", lambda t: F.xxhash64(F.coalesce(kind(t), t))),
            "_exact": F.transform("_tokens", lambda t: F.xxhash64(t)),
            "_plain": F.transform("_tokens", lambda t: kind(t).isNull().cast("int")),
        }
    )
    for name in ("_template", "_plain", "_exact"):
        rows = _doubled(rows, name, max(sizes))
    found = {}
    for size in sizes:
        if size < SHORTEST:
            found[f"key{size}"] = F.when(~F.col("_short"), _of_size("_exact", size))
            continue
        template = _of_size("_template", size)
        either = F.zip_with(template, _of_size("_exact", size), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        found[f"key{size}"] = F.when(~F.col("_short"), F.zip_with(either, _of_size("_plain", size), _chosen(size)))
        found[f"weak{size}"] = F.when(~F.col("_short"), F.zip_with(template, _of_size("_plain", size), _weak(size)))
    mix = lambda name: F.aggregate(name, F.lit(0).cast("long"), lambda a, b: F.xxhash64(a, b))
    plain = F.aggregate("_plain", F.lit(0), lambda a, b: a + b)
    whole = F.array(F.when(2 * plain >= F.col("_n"), mix("_template")).otherwise(mix("_exact")))
    found[f"key{WINDOW}"] = F.when(F.col("_short") & (F.col("_n") > 0), whole).otherwise(found[f"key{WINDOW}"])
    return rows.select(*kept, "_tokens", "_n", "_first", "_short", *[column.alias(name) for name, column in found.items()])


def windows(rows: DataFrame, keys: list[str], sizes: list[int]) -> DataFrame:
    """One row per window of prepared rows: keys, _tokens, _n, _first, at (in _tokens), size, key, weak.

    The outer form is meant: for the inner one Spark would filter the scan by the whole expression first.
    """
    every = []
    for size in sizes:
        for name in (f"key{size}", f"weak{size}"):
            if name in rows.columns:
                of_size = F.when(F.col("_short") & (size >= SHORTEST), F.col("_n")).otherwise(size)
                made = F.transform(name, lambda k, i: F.struct(i.alias("at"), of_size.alias("size"), k.alias("key"), F.lit(name.startswith("weak")).alias("weak")))  # noqa: B023
                every.append(F.filter(F.coalesce(made, F.array().cast(WINDOWS)), lambda w: w["key"].isNotNull()))
    return rows.select(*keys, "_tokens", "_n", "_first", "_short", F.inline_outer(F.concat(*every))).where("key IS NOT NULL")


def item_windows(benchmark: DataFrame, text: str = "text", id: str = "item_id") -> tuple[DataFrame, list[int], Known]:
    """(item_id, n_tokens, item_at, size, key, weak, item_tokens) of every different item, stored; the sizes of windows; and the pairs that documents need.

    Items are cut into windows of WINDOW tokens, shorter ones are one window; items of the same words and values count as the one
    with the smallest id.
    """
    items = benchmark.select(F.col(f"`{id}`").alias("item_id"), F.col(f"`{text}`").alias("_text")).withColumn("found", tokens(F.col("_text")))
    one = items.where("size(found) > 0").groupBy("found").agg(F.min(F.struct("item_id", "_text")).alias("x")).select("x.*")
    one = store(one, "items")
    lengths = one.select(F.size(tokens(F.col("_text"))).alias("n")).where(F.col("n").between(min(BRIEF), WINDOW - 1)).distinct()
    sizes = sorted({r[0] for r in lengths.collect()} | {WINDOW})  # at most WINDOW - min(BRIEF) + 1 sizes
    # a brief item is looked for as a whole document and, word by word, inside documents
    inside = prepared(one.select("item_id", "_text"), sizes).where("_short").select("item_id", "_tokens", "_n")
    cut = windows(prepared(one, sizes), ["item_id"], sizes).where(F.col("size") == F.least(F.col("_n"), F.lit(WINDOW)))
    columns = [
        "item_id", F.col("_n").alias("n_tokens"), F.col("at").alias("item_at"), "size", "key", "weak", F.slice("_tokens", F.col("at") + 1, F.col("size")).alias("item_tokens"),
    ]
    made = cut.select(*columns)
    for size in [n for n in sizes if n in BRIEF]:
        own = inside.where(F.col("_n") == size).withColumn("_exact", F.transform("_tokens", lambda t: F.xxhash64(t)))
        own = _doubled(own, "_exact", size).select("*", F.get(_of_size("_exact", size), F.lit(0)).alias("key"))
        made = made.unionByName(own.select("item_id", F.col("_n").alias("n_tokens"), F.lit(0).alias("item_at"), F.lit(size).alias("size"), "key", F.lit(False).alias("weak"), F.col("_tokens").alias("item_tokens")))
    stored = store(made.dropDuplicates(["item_id", "item_at", "size", "key"]), "item-windows")
    symbols = stored.select(F.transform("item_tokens", lambda t: F.coalesce(kind(t), t)).alias("s"))
    found = symbols.select(F.explode(_pairs("s")).alias("p")).distinct().limit(PAIRS + 1).collect()
    shortest = min([n for n in sizes if n in BRIEF], default=SHORTEST)
    return stored, sizes, Known([tuple(r["p"].split(" ")) for r in found] if len(found) <= PAIRS else None, shortest)


def _places(seen: Column) -> Column:
    """The item tokens that windows cover."""
    return F.array_distinct(F.flatten(F.transform(seen, lambda w: F.sequence(w["item_at"], w["item_at"] + w["size"] - 1))))


def _agreed() -> Column:
    """Pairs of column pairs that map one to one, taken by the number of windows of column seen that hold them."""
    conflict = lambda p, q: (p["t"] == q["t"]) & ((p["item"] == q["item"]) != (p["doc"] == q["doc"]))
    held = lambda p: F.size(F.filter("seen", lambda w: F.array_contains(w["pairs"], p)))
    ordered = F.array_sort(F.transform("pairs", lambda p: F.struct((-held(p)).alias("n"), p.alias("p"))))
    add = lambda have, x: F.when(F.exists(have, lambda q: conflict(q, x["p"])), have).otherwise(F.concat(have, F.array(x["p"])))
    return F.aggregate(ordered, F.slice("pairs", 1, 0), add)


def alignments(docs: DataFrame, benchmark: DataFrame, keys: list[str], text: str = "text", enough: int = ENOUGH) -> DataFrame:
    """Every alignment of a document and an item that shares a window: ``keys``, item_id, n_tokens, shift, places (covered item tokens), consistent.

    places holds the tokens of all windows if their slots are consistent; else those of the windows that agree with each other if these are
    at least ``enough`` tokens, and those of the windows without slots if not.
    The texts stay where they are: windows are made and looked up in the scanning tasks, and only matching windows are shuffled.  Only runs of tokens whose pairs the
    benchmark has are cut into windows, as no other window can match.
    """
    items, sizes, known = item_windows(benchmark)
    if items.count() <= BROADCAST_KEYS:
        items = F.broadcast(items)
    rows = prepared(docs.select(*[F.col(k) for k in keys], F.col(f"`{text}`").alias("_text")), sizes, known)
    hits = windows(rows, keys, sizes).join(items, ["key", "size", "weak"])
    aligned = F.zip_with(
        "item_tokens", F.slice("_tokens", F.col("at") + 1, F.col("size")),
        lambda a, b: F.struct(kind(a).alias("t"), a.alias("item"), b.alias("doc")),
    )
    found = hits.select(
        *keys, "item_id", "n_tokens", (F.col("_first") + F.col("at") - F.col("item_at")).alias("shift"),
        "item_at", "size", "weak", F.filter(aligned, lambda x: x["t"].isNotNull()).alias("pairs"),
    )
    joined = found.groupBy(*keys, "item_id", "n_tokens", "shift").agg(F.collect_set(F.struct("item_at", "size", "pairs", "weak")).alias("every"))
    pairs_of = lambda seen: F.array_distinct(F.flatten(F.transform(seen, lambda w: w["pairs"])))
    joined = joined.withColumn("seen", F.filter("every", lambda w: ~w["weak"])).withColumn("pairs", pairs_of("every"))
    different = lambda side: F.size(F.array_distinct(F.transform("pairs", lambda x: F.struct(x["t"], x[side]))))
    one_to_one = (different("item") == F.size("pairs")) & (different("doc") == F.size("pairs"))
    # windows that are mostly placeholders count only where all windows cover the whole item without a conflict
    joined = joined.withColumn("whole", F.when(one_to_one & (F.size(_places(F.col("every"))) == F.col("n_tokens")), _places(F.col("every"))))
    joined = joined.where("whole IS NOT NULL OR size(seen) > 0").withColumn("pairs", pairs_of("seen"))
    joined = joined.withColumn("consistent", one_to_one).withColumn("agreed", F.when(~F.col("consistent"), _agreed()))
    agreeing = F.filter("seen", lambda w: F.forall(w["pairs"], lambda p: F.array_contains("agreed", p)))
    joined = joined.withColumn("part", F.when(~F.col("consistent"), _places(agreeing)))
    without_slots = F.filter("seen", lambda w: F.size(w["pairs"]) == 0)
    places = F.when(F.col("consistent"), _places(F.col("seen"))).when(F.size("part") >= enough, F.col("part")).otherwise(_places(without_slots))
    return joined.withColumn("places", F.coalesce("whole", places)).drop("pairs", "seen", "every", "whole", "agreed", "part")


def contaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", id: str = "doc_id", covered: float = COVERED, enough: int = ENOUGH
) -> DataFrame:
    """One row per document and item that it contains: id, text_key, item_id, n_tokens, coverage, n_alignments.

    coverage is the share of the item's template tokens that lie in windows without slots or with slots that agree (see alignments); rows have at
    least ``covered``, or ``enough`` covered tokens.  text_key is a digest of the text: rows that share an id are told apart by it, repeated rows are one
    document.  NULL and empty texts and items contain and match nothing; an item with fewer than SHORTEST tokens is found where it is
    the whole document, with 3 or 4 tokens also where its words and values stand in a text as they are.  Items that are mostly placeholders are found with other values if all of it is there and the slots are consistent;
    items without any plain word only with their own values.  Items with equal words and values are reported under the smallest id.
    """
    keyed = docs.select(F.col(f"`{id}`").alias("_id"), F.col(f"`{text}`").alias("text"), F.xxhash64(f"`{text}`").alias("text_key"))
    found = alignments(keyed, benchmark, ["_id", "text_key"], enough=enough).where("size(places) > 0")
    share = F.size(F.array_distinct(F.flatten(F.collect_list("places")))) / F.col("n_tokens")
    per_item = found.groupBy("_id", "text_key", "item_id", "n_tokens").agg(share.alias("coverage"), F.count(F.lit(1)).alias("n_alignments"))
    long = F.col("coverage") * F.col("n_tokens") >= enough - 0.5
    return per_item.where((F.col("coverage") >= covered) | long).withColumnRenamed("_id", id)


def without_benchmark(docs: DataFrame, benchmark: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """The documents that contain no item, all columns as they are."""
    found = contaminated(docs, benchmark, text, id).select(F.struct(F.col(f"`{id}`").alias("id"), "text_key").alias("key")).distinct()
    rows, names = renamed(docs)
    keyed = rows.withColumn("_key", F.struct(F.col(names[id]).alias("id"), F.xxhash64(names[text]).alias("text_key")))
    return keyed.join(found, keyed["_key"] == found["key"], "left_anti").drop("_key").toDF(*docs.columns)
