"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINES = [
    "J03_attach_inbound", "A02_account_view", "A07_tag_popularity", "A08_week_rollup", "A17_describe",
    "E04_repost_edges", "E10_contact_edges", "W03_rolling_descriptor", "T03_tokenize", "T06_phrases_fit",
    "T07_phrases_apply", "G10_clustering", "G06_connected_components", "G24_pagerank",
]


def main() -> None:
    from pyspark.sql import SparkSession

    from socigrain.plans import catalog

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog.QUERIES["A15_value_counts"](spark, sf).count()  # JVM and scan warm-up
    times = {}
    for name in names.split(",") if names else HEADLINES:
        started = time.time()
        catalog.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - started, 3)
    spark.stop()
    print(json.dumps({"metric": "total_wall_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf.rstrip("/"))}))


if __name__ == "__main__":
    main()
