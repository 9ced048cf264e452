"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
``python bench.py all`` times every registered query.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import registry  # noqa: E402

HEADLINE = [
    "cl1_clean_text",
    "cl5_median_orders",
    "jn1_merge_by_url",
    "wn1_drop_duplicates",
    "sc4_column_info_lineitem",
    "sx_all_derived",
    "tx5_sentiment_score",
    "tx7_aspect_mentions",
    "tx9_negative_drivers",
    "ag3_sentiment_by_category",
    "ag4_sentiment_by_month",
    "ag6_aspect_summary_by_category",
    "ag8_category_insights",
    "bm1_category_prompts",
    "wb1_extract_pages",
    "ml4_grouped_kmeans",
    "ml6_search",
    "ml8_squared_silhouette",
    "ml11_coherence",
    "ml15_topic_terms",
    "pl1_preprocess",
    "pl4_analyse_categories",
    "pl6_report",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("reviewgrain-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, name: str, sf_dir: str) -> float:
    """Seconds to build the query and compute every row and column of it."""
    start = time.perf_counter()
    registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = list(registry.QUERIES) if sys.argv[1:] == ["all"] else HEADLINE
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    timed(spark, "ag1_rating_counts", sf_dir)  # warm up the JVM
    seconds = {name: timed(spark, name, sf_dir) for name in names}
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
