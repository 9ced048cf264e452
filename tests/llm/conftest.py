import os

import pytest

from reviewgrain.llm.shared import importable

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def workers(spark):
    importable(spark)


@pytest.fixture(scope="session")
def documents(spark):
    if not os.path.isdir(SF):
        pytest.skip("given tables are not here")
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture
def odd(spark):
    """NULLs, empty and long texts, repeated rows and columns with names that the operators use themselves."""
    rows = [
        (None, None, None), (None, "the and of " * 30, "en"), (1, "", "en"), (1, "", "en"), (2, "123 456", None),
        (3, "the and of " * 30, "en"), (3, "the and of " * 30, "en"), (4, "x\n" * 5000, "fr"), (5, "y" * 100_000, "en"), (6, " \t\n ", None),
    ]
    schema = "doc_id long, text string, lang string, fingerprint string, ids string, `_text` string, `_key` int, size int, n_lines string, score string"
    return spark.createDataFrame([(*r, "f", "i", "t", 1, 2, "n", "s") for r in rows], schema)
