import os

import duckdb
import pytest

import __spark_entry__ as entry
from reviewgrain.llm.queries import ORACLES, QUERIES
from tools.check import TABLES, compare

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are not here")
@pytest.mark.parametrize("name", list(ORACLES))
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    verdict, _ = compare(spark, con, entry, name, SF)
    assert verdict.startswith("ok"), verdict


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, len(QUERIES) + 1))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
