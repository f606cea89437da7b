"""Headline queries, wall time each.  Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from contactloom.plans.catalog import QUERIES

HEADLINE = [
    "clean_names_emails_phones", "decode_custom_fields", "buyer_tier", "event_cities",
    "key_index", "match_actions", "conflict_filtered_updates", "conflict_safe_snapshot", "migrate_all",
    "duplicate_pairs", "merge_survivors", "weekly_windows", "delta_since", "tag_topk",
    "field_coverage", "pipeline_contacts", "validation_status", "run_metrics",
    "contact_mentions", "json_roundtrip", "incremental_sync",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("contactloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the session before timing
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
