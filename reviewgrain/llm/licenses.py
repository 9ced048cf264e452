"""Licence texts found by the digest of a canonical form.

Texts are brought into a canonical form: lower case, no copyright lines, one spelling for equivalent words, no punctuation, single
spaces.  The digest of an entire text (a document, one of its blocks between empty lines, or one of its lines) is then hash-joined to the
digests of known licence texts and statements.  A run of blocks is digested where its form is as long as a known text and begins like it.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewgrain.llm.shared import Batches

#: Digests that are broadcast at most; a larger catalogue is left to the planner.
BROADCAST_DIGESTS = 100_000

# Equivalent spellings, patterns for both Java and RE2, applied in this order to lower-case text.
EQUIVALENT = (
    (r"https?://", "https://"),
    (r"\(c\)|©", " copyright "),
    (r"&", " and "),
    (r"licen[cs]e", "license"),
    (r"licen[cs]or", "licensor"),
    (r"licen[cs]ing", "licensing"),
    (r"acknowledgement", "acknowledgment"),
    (r"organisation", "organization"),
    (r"favour", "favor"),
    (r"behaviour", "behavior"),
    (r"honour", "honor"),
    (r"merchantibility", "merchantability"),
    (r"whilst", "while"),
    (r"wilful", "willful"),
    (r"modelling", "modeling"),
    (r"non-commercial|non commercial", "noncommercial"),
    (r"sub-licen", "sublicen"),
    (r"per cent", "percent"),
    (r"copyright owner", "copyright holder"),
    (r"in connection with", "in connection to"),
    (r"\bv(?:ersion|er\.|\.)? ?([0-9])", "version $1"),
)
COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n]*(?:copyright|\(c\)|©)[^\n]*[0-9]{4}[^\n]*$"
RIGHTS_LINE = r"(?m)^[^\p{L}\p{N}\n]*all rights reserved[^\p{L}\p{N}\n]*$"
OTHER = r"[^\p{L}\p{N}]+"
#: Words that the equivalent spellings may have made or changed; any other word of a canonical form is in the text as it is.
TOUCHED = r"^(?:and|to)$|licen|acknowledg|organi|favo|behavio|hono|merchant|whil|wil|model|commercial|percent|copyright|holder|owner|connection|version|http"
#: Anchor words that documents are first searched for at most.
ANCHORS = 256
#: The anchor of all texts that hold it, so that there are few.
SHARED_ANCHOR = "warranties"
#: Characters that a run of blocks must share with the beginning of a known text to be digested.
HEAD = 32

_AS_IS = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_BSD_END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_BSD_TWO = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n"
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_END = "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
#: Known texts and statements (fixed values): licence, text.
KNOWN = (
    ("MIT", "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n" + _AS_IS),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n" + _AS_IS),
    ("ISC", _ISC + ", provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _ISC_END),
    ("0BSD", _ISC + ".\n\n" + _ISC_END),
    ("BSD-2-Clause", _BSD_TWO + "\n" + _BSD_END),
    ("BSD-3-Clause", _BSD_TWO + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\n" + _BSD_END),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under CC BY 4.0."),
)


def canonical(text: Column) -> Column:
    """The canonical form of a text; NULL for NULL."""
    out = F.regexp_replace(F.regexp_replace(F.lower(text), COPYRIGHT_LINE, ""), RIGHTS_LINE, "")
    for pattern, spelling in EQUIVALENT:
        out = F.regexp_replace(out, pattern, spelling)
    return F.trim(F.regexp_replace(out, OTHER, " "))


def whole_texts() -> list[tuple[str, str]]:
    """(licence, text) of whole licences, those with an appendix also without it."""
    return [tuple(r) for r in json.loads(resources.files(__package__).joinpath("licence_texts.json").read_text("utf-8"))]


def catalogue(spark: SparkSession, known=None) -> DataFrame:
    """digest, licence, anchor, length, head of every known text (default KNOWN and whole_texts()); of equal texts the licence first in the alphabet.

    anchor is SHARED_ANCHOR or else the longest word of the canonical form that a text must hold as it is to have this form; NULL if there is none.
    length and head are the number of characters of the form and the first HEAD ones.
    """
    known = (*KNOWN, *whole_texts()) if known is None else known
    rows = spark.createDataFrame(list(known), "licence string, text string").withColumn("form", canonical(F.col("text")))
    words = F.filter(F.split("form", " "), lambda w: ~w.rlike(TOUCHED))
    anchor = F.array_max(F.transform(words, lambda w: F.struct(F.length(w).alias("n"), w.alias("word"))))["word"]
    anchor = F.when(F.array_contains(words, SHARED_ANCHOR), F.lit(SHARED_ANCHOR)).otherwise(anchor)
    grouped = rows.where("form <> ''").groupBy(F.sha2("form", 256).alias("digest"))
    head = F.substring("form", 1, HEAD)
    return grouped.agg(
        F.min("licence").alias("licence"), F.first(anchor).alias("anchor"), F.first(F.length("form")).alias("length"), F.first(head).alias("head")
    )


def _runs(forms: list[str | None], lengths: dict[int, list[str]], known: dict[str, str]) -> list[tuple[int, str]]:
    """(place of the first block, licence) of runs of at least two blocks that are known texts, inside no larger one and not the document."""
    places = [i for i, f in enumerate(forms) if f]
    digest = lambda a, b: hashlib.sha256(" ".join(forms[i] for i in places[a:b]).encode("utf-8", "surrogatepass")).hexdigest()
    if len(places) < 2 or digest(0, len(places)) in known:
        return []
    ends = np.cumsum([len(forms[i]) + 1 for i in places])
    starts = np.concatenate(([0], ends[:-1]))
    found, upto = [], 0
    for length, heads in lengths.items():
        last = np.minimum(np.searchsorted(ends, starts + length + 1), len(ends) - 1)
        for a in np.flatnonzero((ends[last] == starts + length + 1) & (last > np.arange(len(ends)))).tolist():
            first = forms[places[a]][:HEAD]
            if any(h.startswith(first) for h in heads) and (licence := known.get(digest(a, int(last[a]) + 1))):
                found.append((a, -int(last[a]), licence))
    out = []
    for a, b, licence in sorted(found):  # of runs that begin together the longest is first
        if -b >= upto:
            out.append((places[a], licence))
            upto = 1 - b
    return out


def _found_runs(rows: DataFrame, keep: list[str], known: DataFrame) -> DataFrame:
    """keep, unit (blocks), place, licence of runs of blocks; ``rows`` has keep and _forms.  Tasks get the digests of ``known`` with their code."""
    names, lengths = {}, {}
    for digest, licence, length, head in known.select("digest", "licence", "length", "head").collect():
        names[digest] = licence
        lengths.setdefault(length, []).append(head)
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            if out is None:
                more = [pa.field("unit", pa.string()), pa.field("place", pa.int64()), pa.field("licence", pa.string())]
                out = Batches(pa.schema([*(batch.schema.field(c) for c in keep), *more]))
            for i, forms in enumerate(batch.column("_forms")):
                for place, licence in _runs(forms.as_py(), lengths, names):
                    yield from out.add((*(batch.column(c)[i].as_py() for c in keep), "blocks", place, licence))
        if out is not None:
            yield from out.flush()

    return rows.mapInArrow(run, f"{schema}, unit string, place long, licence string")


def find(docs: DataFrame, known: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per entire text that is a known licence: keep (default doc_id), unit, place, licence.

    unit is document, blocks (a run of them), block (between empty lines) or line, place counts the blocks or lines of the document from 0.  A text is reported as its largest
    unit: not as a block if it is the whole document, not as a line if it is the whole block.  Runs begin and end with blocks, however the
    known text is cut into blocks.
    NULL and empty texts hold nothing; repeated rows are reported each; further columns are not read.  The catalogue is
    broadcast up to BROADCAST_DIGESTS digests, counted before.
    """
    keep = ["doc_id"] if keep is None else keep
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_text"))
    anchors = [r[0] for r in known.select("anchor").distinct().limit(ANCHORS + 1).collect()]
    if len(anchors) <= ANCHORS and None not in anchors:  # no unit of a document without any anchor can be a known text
        rows = rows.where(F.lower("_text").rlike("|".join(sorted(map(re.escape, anchors))) or r"\z\A."))
    split = rows.withColumn("_split", F.split("_text", r"\n[ \t\r]*\n")).where("size(_split) > 1")
    runs = _found_runs(split.select(*[F.col(f"`{c}`") for c in keep], F.transform("_split", canonical).alias("_forms")), keep, known)
    known = known.select("digest", "licence")
    known = F.broadcast(known) if known.count() <= BROADCAST_DIGESTS else known
    blocks = F.split("_text", r"\n[ \t\r]*\n")
    lines = F.transform(blocks, lambda b: F.split(b, "\n"))
    # one row per unit: a block with one line is only the block, a document with one block only the document
    units = rows.withColumn("_blocks", lines).withColumn(
        "_units",
        F.concat(
            F.array(F.struct(F.lit("document").alias("unit"), F.lit(0).alias("place"), F.col("_text").alias("piece"))),
            F.when(
                F.size("_blocks") > 1,
                F.transform("_blocks", lambda b, i: F.struct(F.lit("block").alias("unit"), i.alias("place"), F.array_join(b, "\n").alias("piece"))),
            ).otherwise(F.array().cast("array<struct<unit:string,place:int,piece:string>>")),
            F.filter(
                F.transform(F.flatten(F.transform("_blocks", lambda b: F.transform(b, lambda x: F.struct(x.alias("piece"), F.size(b).alias("n"))))),
                            lambda x, i: F.struct(F.when(x["n"] > 1, "line").alias("unit"), i.alias("place"), x["piece"].alias("piece"))),
                lambda x: x["unit"].isNotNull(),
            ),
        ),
    )
    each = units.select(*keep, F.explode_outer("_units").alias("u")).select(*keep, "u.unit", "u.place", canonical(F.col("u.piece")).alias("_form"))
    hits = each.where("_form <> ''").withColumn("digest", F.sha2("_form", 256)).join(known, "digest")
    return hits.select(*keep, "unit", F.col("place").cast("long").alias("place"), "licence").unionAll(runs)
