import datetime as dt

from pyspark.sql import functions as F

from reviewgrain.operators import profiling


def test_distinct_counts_do_not_multiply_rows(spark):
    long = "x" * 70
    digest = __import__("hashlib").sha256(long.encode()).hexdigest()
    rows = [
        (1, long, float("nan"), [1.0, None], dt.datetime(1800, 1, 1), None), (1, long + "y", float("nan"), [1.0, None], dt.datetime(2020, 1, 1), None),
        (None, digest[:-1], -0.0, [None, 1.0], None, None), (2, "", 0.0, None, dt.datetime(2020, 1, 1), None), (2, None, None, None, None, None),
    ]
    table = spark.createDataFrame(rows, "`a.b` int, s string, x double, v array<double>, t timestamp_ntz, n string").withColumnRenamed("a.b", "a")
    table = table.withColumn("nothing", F.lit(None))
    plan = profiling.column_info(table)
    assert "Expand" not in plan._jdf.queryExecution().executedPlan().toString()
    got = {r.column: (r.dtype, r.non_null_count, r.null_count, r.unique_count) for r in plan.collect()}
    assert got == {
        "a": ("int", 4, 1, 2), "s": ("string", 4, 1, 4), "x": ("double", 4, 1, 2), "v": ("array<double>", 3, 2, 2), "t": ("timestamp_ntz", 3, 2, 2),
        "n": ("string", 0, 5, 0), "nothing": ("void", 0, 5, 0),
    }
    empty = {r.column: (r.non_null_count, r.unique_count) for r in profiling.column_info(table.limit(0)).collect()}
    assert set(empty.values()) == {(0, 0)}
    assert {r.unique_count for r in profiling.column_info(table.select("a"), exact=False).collect()} == {2}
