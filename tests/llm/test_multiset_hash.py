import hashlib
import random

import pytest

from reviewgrain.llm import multiset_hash as mh
from reviewgrain.llm.queries import QUERIES

COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def plain(rows):
    """The result rows of (id, text) rows, each text hashed anew."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    out = []
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        made = text[: len(text) - half] + after[:half]
        a, b, c = mh.fingerprint(text), mh.fingerprint(made), mh.fingerprint(after)
        out.append((i, len(text), hashlib.sha256(made.encode()).hexdigest(), a.text(), b.text(), a.likeness(b), a.likeness(c)))
    return sorted(out, key=str)


def found(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=str)


def test_paragraphs_add_up():
    text = "one two three four\n\nfive six\nseven"
    whole = mh.fingerprint(text)
    assert whole.text() == mh.fingerprint("\nseven\none two three four\nfive six").text() == mh.parsed(whole.text()).text()
    assert mh.inserted(mh.deleted(whole, "five six"), "eight").text() == mh.fingerprint("one two three four\n\neight\nseven").text()
    assert whole.text() not in {mh.fingerprint(t).text() for t in (text + "\n", text + " ", text.replace("six", "Six"), text + "\nseven", None, "")}
    assert mh.fingerprint(None).text() == mh.fingerprint("").text() and mh.NOTHING.text() == mh.deleted(whole, "seven").__sub__(mh.deleted(whole, "seven")).text()
    assert mh.fingerprint("x\n" * 70_000).likeness(mh.fingerprint("x\n" * 60_000)) > 0.99


def test_likeness_follows_what_is_shared():
    rng = random.Random(3)
    words = [f"w{k}" for k in range(3000)]
    errors = []
    for share in (0.0, 0.25, 0.5, 0.75, 1.0):
        a = [" ".join(rng.choices(words, k=30)) for _ in range(40)]
        keep = int(share * 40)
        b = a[:keep] + [" ".join(rng.choices(words, k=30)) for _ in range(40 - keep)]
        rng.shuffle(b)
        errors.append(abs(mh.fingerprint("\n".join(a)).likeness(mh.fingerprint("\n".join(b))) - share))
    assert max(errors) < 0.3 and sum(errors) / 5 < 0.12 and errors[-1] == 0
    assert mh.fingerprint("").likeness(mh.fingerprint("a b c d")) == 0 and mh.fingerprint("").likeness(mh.fingerprint(None)) == 1


@pytest.mark.parametrize("seed", range(30))
def test_joined_is_the_fingerprint_of_the_joined_text(seed):
    rng, words = random.Random(seed), mh.WordHashes()
    make = lambda: "".join(rng.choices("ab \n", [4, 4, 3, 1 + seed % 3], k=rng.randrange(60)))
    for _ in range(60):
        a, b = make(), make()
        keep, take = rng.randint(0, len(a)), rng.randint(0, len(b))
        got = mh.joined(mh.Paragraphs(a, words), keep, mh.Paragraphs(b, words), take, words)
        assert got.text() == mh.fingerprint(a[:keep] + b[:take]).text()


def test_odd_rows(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert found(mh.edited(odd)) == plain(rows)
    assert mh.edited(odd.limit(0)).columns == COLUMNS and mh.edited(odd.limit(0)).count() == 0
    single = spark.createDataFrame([(5, "a b c\nd")], "doc_id int, text string")
    assert found(mh.edited(single)) == plain([(5, "a b c\nd")]) and mh.edited(single).schema["doc_id"].dataType == single.schema["doc_id"].dataType
    assert found(mh.edited(odd.where("doc_id IS NULL"))) == plain([r for r in rows if r[0] is None])
    same = odd.where("doc_id = 3").unionAll(odd.where("doc_id = 3"))
    assert found(mh.edited(same)) == plain([r for r in rows if r[0] == 3] * 2)
    prints = {r.fingerprint for r in mh.fingerprints(odd.where("text = ''")).collect()}
    assert prints == {mh.fingerprint(None).text()} and mh.fingerprints(odd, keep=["fingerprint", "text"]).count() == odd.count()


def test_query(spark, documents):
    assert found(QUERIES["op11_document_fingerprints"](spark, "/root/testdata/sf0.001")) == plain([(r.doc_id, r.text) for r in documents.collect()])
    rows = QUERIES["op11_document_fingerprints"](spark, "/root/testdata/sf0.001").collect()
    assert sum(r.near_edited for r in rows) / len(rows) > 0.4 > 0.2 > sum(r.near_next for r in rows) / len(rows)
