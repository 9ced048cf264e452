import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="reviewgrain-"))
    return session


@pytest.fixture
def sample(spark):
    """Three reviews; two share a URL, one of them has no title."""
    return spark.createDataFrame(
        [
            (0, "k-7", "Garden chair", "4.0", "Sturdy enough", "2021-01-31", "https://store.example.org/ip/chair/77", "3", "1"),
            (1, "k-8", "Desk lamp", "2.5", "Too dim", "2021-02-28", "https://store.example.org/ip/lamp/88", "0", "4"),
            (2, "k-9", None, "1.0", "Wobbles", "2021-03-01", "https://store.example.org/ip/chair/77", None, "2"),
        ],
        "row_id long, uniq_id string, title string, rating string, review string, review_date string, "
        "pageurl string, review_upvotes string, review_downvotes string",
    )


@pytest.fixture
def column_of(spark):
    """Apply a column rule to literal values and return the results in order."""

    def run(rule, values, kind="string"):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
        return [r[0] for r in rows.orderBy("i").select(rule("c")).collect()]

    return run
