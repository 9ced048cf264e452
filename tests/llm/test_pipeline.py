import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from reviewgrain.llm import byte_bpe, decontaminate, language_id, line_dedup
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark, documents):
    docs = documents
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(public_tokenizers.path(corpus_pipeline.VOCABULARY)), special_tokens={}
    )
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = corpus_pipeline.store(stage(spark, docs, SF), name)
        after = {r.doc_id: r for r in docs.collect()}
        assert len(after) == docs.count()
        if name != "byte_level_bpe":
            assert docs.columns == documents.columns
        if name == "language_id":
            assert set(after) == {i for i, r in before.items() if language_id.has_letter(r.text)}
            assert all(r.lang == before[i].lang for i, r in after.items())
        elif name == "line_dedup":
            want = brute.without_later_runs([(i, r.text) for i, r in before.items()], line_dedup.MIN_WORDS)
            assert {i: r.text for i, r in after.items()} == {i: t for i, t in want.items() if t.strip() or t == before[i].text}
            assert all(r.n_chars == len(r.text) for r in after.values())
        elif name == "simhash_near_dedup":
            groups = brute.near_groups([(i, r.text) for i, r in before.items()])
            assert set(after) == {part for _, part in groups.values()}
        elif name == "benchmark_decontamination":
            items = spark.read.parquet(f"{SF}/benchmark.parquet")
            gone = {r.doc_id for r in decontaminate.contaminated(spark.createDataFrame(list(before.values()), documents.schema), items).collect()}
            assert set(after) == set(before) - gone and gone
        else:
            for i, r in after.items():
                assert np.frombuffer(bytes(r.ids), "<u4").tolist() == library.encode_ordinary(before[i].text) and r.round_trip
            assert set(after) == set(before)


def test_odd_rows(spark, odd):
    wide = odd.selectExpr("*", "'s' AS source", "1L AS n_chars")
    for docs in (wide, wide.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert out.count() <= docs.count()
            assert name == "byte_level_bpe" or out.columns == docs.columns
