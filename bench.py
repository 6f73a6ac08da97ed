"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.01 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from checks.registry import QUERIES

HEADLINE = [
    "user_risk_score", "top_hate_terms", "hourly_trend", "likes_correlation",
    "negative_terms", "clean_text", "final_records", "lexicon_scores",
    "throughput_windows", "sentiment_windows", "rolling_shares", "json_roundtrip",
    "last_n_per_partition", "stream_throughput", "stream_sentiment", "stream_stages",
]
# Training and Python scoring take long enough to be timed once.
ONCE = ["udf_scores", "ml_hate_scores", "word2vec_synonyms"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split() or [*HEADLINE, *ONCE]
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The first query pays for the start of the session, so one runs before the clock.
    QUERIES["user_risk_score"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings = {}
    for name in names:
        runs = []
        for _ in range(1 if name in ONCE else repeats):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(runs), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "repeats": repeats,
    }))


if __name__ == "__main__":
    main()
