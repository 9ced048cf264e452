"""Language identification by rank-order profiles.

A profile lists a language's most frequent n-grams (1 to 3 characters, words padded with a
space on both sides) in order of frequency.  A document's own list is compared to each profile by
the out-of-place distance: the sum over its n-grams of how far their ranks lie apart, with the profile's length for an n-gram that
it does not have.  The nearest profile wins.  N-grams of a document that are equally frequent are listed in the order of a digest.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewgrain.llm.shared import store, texts

GRAM = 3
#: N-grams of a profile and of a document's list.
PROFILE = 400
UNDETERMINED = "und"
#: Code points of a text that are counted at once, and different n-grams of a language that a task keeps before it hands counts on.
AT_ONCE, COUNTED = 1 << 18, 1 << 19
WORD = re.compile(r"[^\W\d_]+")
#: An n-gram as a number: its code points, BITS bits each.
BITS, SPACE = 21, 32
#: N-grams whose digests a worker remembers.
REMEMBERED = 100_000


def held_out(id_column: str) -> Column:
    """True for documents that are kept out of training: crc32 of the id as text is 2 modulo 4; false for a NULL id."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 4 == 2, F.lit(False))


def grams_of(word: str) -> list[str]:
    """The n-grams of one word: its characters, and the pairs and triples of the word with a space on both sides."""
    padded = f" {word} "
    return [*word, *(padded[i : i + 2] for i in range(len(word) + 1)), *(padded[i : i + 3] for i in range(len(word)))]


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text)) if text else False


@cache
def _letters() -> np.ndarray:
    """For every code point whether words consist of it."""
    out = np.zeros(0x110000, bool)
    for found in WORD.finditer("".join(map(chr, range(0x110000)))):
        out[found.start() : found.end()] = True
    return out


def _counted(codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different codes, ascending, and how often they occur, given counts of some of them."""
    order = np.argsort(codes, kind="stable")
    codes, times = codes[order], times[order]
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1]))) if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.add.reduceat(times, first) if len(first) else times


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a whole text, as ascending numbers, and their counts.

    They are those of all its words (see grams_of).  A long text is counted in pieces that end between words, so that memory follows its different n-grams.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    found = []
    at = 0
    while at < len(points):
        piece = points[at : at + AT_ONCE]
        inside = _letters()[piece]
        if at + AT_ONCE < len(points) and inside[-1]:
            ends = np.flatnonzero(~inside)
            if len(ends):
                piece, inside = piece[: ends[-1] + 1], inside[: ends[-1] + 1]
            else:  # a word longer than a piece is taken whole
                rest = np.flatnonzero(~_letters()[points[at:]])
                piece = points[at : at + (int(rest[0]) if len(rest) else len(points) - at)]
                inside = np.ones(len(piece), bool)
        at += len(piece)
        found.append(_piece_grams(piece, inside))
    if len(found) == 1:
        return found[0]
    return _counted(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _piece_grams(points: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    # words with one space before, between and behind
    letter = np.concatenate(([False], inside, [False]))
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    kept[0] = True
    s = np.where(letter, np.concatenate(([SPACE], points, [SPACE])), SPACE)[kept].astype(np.uint64)
    shift = np.uint64(BITS)
    pairs = s[:-1] << shift | s[1:]
    triples = (pairs[:-1] << shift | s[2:])[s[1:-1] != SPACE]
    codes = np.concatenate((s[s != SPACE], pairs, triples))
    codes.sort()
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1]))) if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.diff(np.append(first, len(codes)))


def gram_text(code: int) -> str:
    """The n-gram that a number stands for."""
    points = []
    while code:
        points.append(chr(code & (1 << BITS) - 1))
        code >>= BITS
    return "".join(reversed(points))


def gram_code(gram: str) -> int:
    out = 0
    for c in gram:
        out = out << BITS | ord(c)
    return out


def count_grams(rows: DataFrame) -> DataFrame:
    """(lang, gram, n) over all training rows (lang, text): counted per task, then summed."""
    schema = pa.schema([("lang", pa.string()), ("gram", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list] = {}
        sizes: dict[str, int] = {}

        def flush(lang: str) -> Iterator[pa.RecordBatch]:
            codes, sums = _counted(*map(np.concatenate, zip(*waiting.pop(lang), strict=True)))
            sizes.pop(lang)
            columns = [lang] * len(codes), list(map(gram_text, codes.tolist())), sums
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), texts(batch, "text"), strict=True):
                if not text:
                    continue
                codes, times = grams(text)
                waiting.setdefault(lang, []).append((codes, times))
                sizes[lang] = sizes.get(lang, 0) + len(codes)
                if sizes[lang] > COUNTED:  # put together, and hand on if they are many even so
                    waiting[lang] = [_counted(*map(np.concatenate, zip(*waiting[lang], strict=True)))]
                    sizes[lang] = len(waiting[lang][0][0])
                    if sizes[lang] > COUNTED // 2:
                        yield from flush(lang)
        for lang in list(waiting):
            yield from flush(lang)

    return rows.select("lang", "text").mapInArrow(run, "lang string, gram string, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n")
    )


def learn(rows: DataFrame, size: int = PROFILE) -> DataFrame:
    """Profiles (lang, gram, place) from rows (lang, text): all rows and whole texts are counted.

    place counts from 0 in order of frequency, ties in order of the n-gram.  At most ``size`` rows
    per language.  Rows with a NULL lang are left out.
    """
    counts = count_grams(rows.where("lang IS NOT NULL"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    ranked = counts.withColumn("place", F.row_number().over(order) - 1).where(F.col("place") < size)
    return store(ranked.select("lang", "gram", "place"), "profiles")


class Digests(dict):
    """The digests of recent n-grams, by which equally frequent ones are ordered."""

    def __missing__(self, code: int) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[code] = out = zlib.crc32(gram_text(code).encode("utf-8", "surrogatepass"))
        return out


class Profiles:
    """The profiles as one table over the n-grams that any of them has."""

    def __init__(self, rows: list[tuple[str, str, int]], size: int):
        self.size, self.digests = size, Digests()
        self.langs = sorted({r[0] for r in rows})
        coded = {gram: gram_code(gram) for gram in {r[1] for r in rows}}
        self.codes = np.array(sorted(coded.values()), np.uint64)
        # place of each n-gram in each profile; -1 says that it has none; the last column is for n-grams no profile has
        self.places = np.full((len(self.langs), len(self.codes) + 1), -1, np.int32)
        for lang, gram, place in rows:
            self.places[self.langs.index(lang), np.searchsorted(self.codes, np.uint64(coded[gram]))] = place

    def predict(self, text: str | None) -> tuple[str, float]:
        """The nearest profile's language and how near it is: 1 less the distance's share of the largest possible."""
        if not self.langs or not has_letter(text):
            return UNDETERMINED, 0.0
        seen, amount = grams(text)
        if not len(seen):
            return UNDETERMINED, 0.0
        if len(seen) > self.size:  # the n-grams that can be among the first, ties at the border included
            border = np.partition(amount, len(seen) - self.size)[len(seen) - self.size]
            seen, amount = seen[amount >= border], amount[amount >= border]
        digests = np.fromiter(map(self.digests.__getitem__, seen.tolist()), np.uint32, len(seen))
        seen = seen[np.lexsort((seen, digests, -amount))][: self.size]
        at = np.minimum(np.searchsorted(self.codes, seen), len(self.codes) - 1)
        places = self.places[:, np.where(self.codes[at] == seen, at, len(self.codes))]
        distance = np.where(places < 0, self.size, np.abs(places - np.arange(len(seen)))).sum(axis=1)
        best = int(np.argmin(distance))
        return self.langs[best], float(1 - distance[best] / (self.size * len(seen)))


def predict(docs: DataFrame, profiles: DataFrame, text: str = "text", keep: list[str] | None = None, size: int = PROFILE) -> DataFrame:
    """The columns ``keep`` (default doc_id) of each row plus lang_pred and score (0 to 1).

    The profiles are at most ``size`` rows per language and are sent to the tasks.  A NULL, an empty text and one without a letter are
    ``und`` with score 0, as is every text if there is no profile.  Equal distances go to the language first in the alphabet.
    Repeated rows get equal results; other columns are not read.
    """
    keep = ["doc_id"] if keep is None else keep
    body = text if text in keep else "_text"  # sent once
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], *([] if text in keep else [F.col(f"`{text}`").alias(body)]))
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    known = [tuple(r) for r in profiles.select("lang", "gram", "place").collect()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Profiles(known, size)
        for batch in batches:
            found = [model.predict(t) for t in texts(batch, body)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                [*keep, "lang_pred", "score"],
            )

    return rows.mapInArrow(run, f"{schema}, lang_pred string, score double")
