from reviewgrain.llm import licenses


def test_equivalent_texts_and_units(spark):
    mit = licenses.KNOWN[0][1]
    other = "THE MIT LICENCE"
    texts = [
        mit, "Copyright (c) 2020 Somebody\n\n" + mit.upper().replace(",", " ,").replace('"', "“"), "Copyright © 1999-2003 A. B.  All rights reserved.\n" + licenses.KNOWN[1][1],
        "Text.\nreleased under the  MIT Licence\nMore.", "Some words.\n\n" + licenses.KNOWN[3][1].replace("\n\n", "\n") + "\n\nEnd.",
        "A text that is released under the MIT License.", other, None, "", "x" * 100_000,
    ]
    docs = spark.createDataFrame([(i, t, "l") for i, t in enumerate(texts)], "doc_id long, text string, licence string")
    found = sorted((r.doc_id, r.unit, r.place, r.licence) for r in licenses.find(docs, licenses.catalogue(spark)).collect())
    assert found == [(0, "document", 0, "MIT"), (1, "document", 0, "MIT"), (2, "document", 0, "MIT"), (3, "line", 1, "MIT"), (4, "block", 1, "0BSD")]


def test_whole_texts_and_runs_of_blocks(spark):
    whole = dict(reversed(licenses.whole_texts()))  # with appendix
    mit, isc = licenses.KNOWN[1][1], licenses.KNOWN[2][1]
    wanted = ["Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0", "CC0-1.0"]
    texts = [whole[n] for n in wanted]
    texts += ["My project\n\nCopyright 2020 Me\n\n" + mit + "\n\nint main() {}\n\n" + isc.upper() + "\n\nend", "Title\n\n" + whole["GPL-3.0"] + "\n\nmore", mit.replace("software", "code") + "\n\nend"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = licenses.find(docs, licenses.catalogue(spark)).collect()
    assert {(r.doc_id, r.licence) for r in rows if r.unit == "document"} == set(enumerate(wanted))
    assert sorted((r.doc_id, r.place, r.licence) for r in rows if r.unit == "blocks") == [(6, 2, "MIT"), (6, 6, "ISC"), (7, 1, "GPL-3.0")]


def test_odd_rows(spark, odd):
    known = licenses.catalogue(spark)
    assert licenses.find(odd, known).count() == 0 == licenses.find(odd.limit(0), known).count()
    empty = licenses.catalogue(spark, [("X", "...")])
    assert empty.count() == 0 and licenses.find(odd, empty).count() == 0
