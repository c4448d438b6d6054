"""Timings of the headline queries: one JSON line, medians in seconds.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of local cores and
BENCH_RUNS the repetitions. The index is built once and timed as `index_build`.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from catalogue.queries import QUERIES, documents  # noqa: E402

HEADLINE = [
    "analyze_standard",
    "analyze_english",
    "match_or",
    "match_hits",
    "multi_best",
    "bool_query",
    "phrase_prefix",
    "query_string",
    "wildcard",
    "highlight",
    "search_many",
    "search_many_best",
    "search_many_phrase",
    "terms_stats",
    "agg_with_query",
    "suggest_many",
    "index_upsert",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("wordmill-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # the first job of a session pays for its start, not for the build
    spark.read.parquet(f"{folder}/region.parquet").count()
    begin = time.perf_counter()
    documents(spark, folder)
    timings = {"index_build": time.perf_counter() - begin}
    for name in HEADLINE:
        taken = []
        for _ in range(runs):
            begin = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - begin)
        timings[name] = statistics.median(taken)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": {name: round(seconds, 3) for name, seconds in timings.items()},
                "sf": Path(folder).name.removeprefix("sf"),
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
