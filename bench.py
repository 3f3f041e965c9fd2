"""Time the headline queries on one machine and print one JSON line.

Each query runs once to warm the JVM up and once for the clock, with its whole result written to a sink that drops it.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from shelfmatch.checks.queries import QUERIES

HEADLINE = (
    "match_cascade", "match_exact_address", "match_exact_name", "match_fuzzy_zip", "match_fuzzy_city",
    "match_fuzzy_name_or_address", "match_wide_block", "similar_names_in_tiles", "incremental_match", "normalized_listings",
    "latest_scrape", "upsert", "insert_only_merge", "scrape_file_scan", "scrape_ingest_stream", "zip_lookup",
    "classified_replies", "pending_geocode_requests", "located_stores", "batch_request_lines", "freshness_check",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
