import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from reviewgrain.llm import byte_bpe
from reviewgrain.llm.queries import QUERIES

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.load_ranks(PATH), special_tokens={})


@pytest.mark.parametrize("leaf", [1, 3, 8])
def test_trees_agree_with_the_library(library, leaf):
    bpe, rng = byte_bpe.TreeBpe(byte_bpe.load_ranks(PATH), PATTERN, leaf), random.Random(leaf)
    bits = ["a", "b", "th", "e", " ", "  ", "\n", "\t", "é", "中", "文字", "😀", "1", "23", "!", "...", "'s", "'ll", "\xa0", "\x1c", "\r\n", "A", "ing", "\u3000"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += ["a" * 3001, "ab" * 1500 + "a", "中" * 999, "=" * 777, "".join(rng.choice("abcde") for _ in range(5000))]
    texts += ["".join(rng.choice(["some", " words", "  ", "\n\n", "é", "!"]) for _ in range(60_000)), " " * 200_000, "x" * 70_000 + " \n y"]
    for text in texts:
        ids = bpe.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text), text[:80]
        assert bpe.decode(ids) == text.encode()


def test_join_gives_the_encoding_of_the_whole():
    bpe, rng = byte_bpe.TreeBpe(byte_bpe.load_ranks(PATH), PATTERN), random.Random(2)
    for _ in range(300):
        whole = "".join(rng.choice("aabcdeinstghr") for _ in range(rng.randint(2, 60))).encode()
        at = rng.randint(0, len(whole))
        assert bpe.join(bpe.merge(whole[:at]), bpe.merge(whole[at:])) == bpe.merge(whole) == bpe._merge_long(whole)


def test_odd_rows(spark, odd):
    rows = byte_bpe.encode(odd, PATH, PATTERN).collect()
    assert len(rows) == odd.count()
    assert {r.n_tokens for r in rows if r.doc_id == 1} == {0} and all(len(r.ids) == 4 * r.n_tokens for r in rows)
    back = byte_bpe.decode(spark.createDataFrame(rows), PATH, PATTERN).collect()
    assert sorted(bytes(r.decoded) for r in back) == sorted((r.text or "").encode() for r in odd.collect())
    assert byte_bpe.encode(odd.limit(0), PATH, PATTERN).count() == 0
    both = byte_bpe.round_trip(odd, PATH, PATTERN, release=True).collect()
    key = lambda r: (str(r.doc_id), bytes(r.ids))
    assert sorted(map(key, both)) == sorted(map(key, rows)) and all(r.n_tokens * 4 == len(r.ids) for r in both)
    assert sorted(bytes(r.decoded) for r in both) == sorted(bytes(r.decoded) for r in back)


def test_query(spark, documents, library):
    found = {r.doc_id: r for r in QUERIES["op8_byte_level_bpe"](spark, "/root/testdata/sf0.001").collect()}
    for row in documents.collect():
        ids = np.array(library.encode_ordinary(row.text or ""), "<u4")
        mine = found.pop(row.doc_id)
        assert (mine.n_tokens, mine.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert mine.decoded_sha256 == hashlib.sha256((row.text or "").encode()).hexdigest()
    assert not found
