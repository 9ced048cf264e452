import random

import numpy as np
import public_tokenizers
import pytest

from reviewgrain.llm import byte_bpe, packing

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def plain(lengths, size):
    """Best fit by looking at every open row."""
    rows, free, last = [], [], []
    for step, i in enumerate(sorted(range(len(lengths)), key=lambda i: -lengths[i])):
        fits = [(free[r], last[r], r) for r in range(len(rows)) if free[r] >= lengths[i]]
        if fits:
            r = min(fits)[2]
        else:
            r = len(rows)
            rows.append([])
            free.append(size)
            last.append(step)
        rows[r].append(i)
        free[r] -= lengths[i]
        last[r] = step
    return rows


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_decreasing(seed):
    rng = random.Random(seed)
    size = rng.choice([1, 7, 16, 100])
    lengths = [rng.randint(1, size) for _ in range(rng.randint(0, 200))]
    assert packing.best_fit_decreasing(lengths, size) == plain(lengths, size)


@pytest.mark.parametrize("unit_ids", [50, 10**6])
def test_rows_hold_all_ids(spark, documents, unit_ids):
    docs = documents.limit(60).coalesce(2)
    size = 64
    rows = packing.pack(docs, PATH, PATTERN, size=size, unit_ids=unit_ids).collect()
    bpe, pieces = byte_bpe.TreeBpe(byte_bpe.load_ranks(PATH), PATTERN), {}
    ids, positions = packing.matrix(rows, "ids", size), packing.matrix(rows, "positions", size)
    for line, r in enumerate(rows):
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_ids <= size and (ids[line, r.n_ids :] == packing.PAD).all()
        for doc, piece, a, b in zip(r.doc_ids, r.pieces, r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            assert positions[line, a:b].tolist() == list(range(b - a))
            pieces[doc, piece] = ids[line, a:b]
    for r in docs.collect():
        want = np.frombuffer(bpe.encode(r.text or ""), "<u4")
        have = [pieces.pop((r.doc_id, k)) for k in range(-(-len(want) // size))]
        assert np.array_equal(np.concatenate(have) if have else want, want)
    assert not pieces


def test_odd_rows(odd, tmp_path):
    rows = packing.pack(odd, PATH, PATTERN)
    assert sum(r.n_ids for r in rows.collect()) == sum(r.n_tokens for r in byte_bpe.encode(odd, PATH, PATTERN).collect())
    assert packing.pack(odd.limit(0), PATH, PATTERN).count() == 0
    packing.write(rows, str(tmp_path / "packed"))
