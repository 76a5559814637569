"""Time the headline queries and print one JSON line.

BENCH_SF_DIR: data folder (default /root/testdata/sf0.1). BENCH_CPUS: local cores (default 8).
BENCH_QUERIES: comma-separated query names, or "all" for the whole catalogue.
Each query runs fully into the no-op sink; nothing is collected. One untimed run of a small
query starts the JVM's machinery.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from spendlens.plans.queries import QUERIES

HEADLINE = (
    "bronze_fingerprint", "silver_dedupe", "silver_cast_dates", "scd2_merge_merchant", "pit_join",
    "range_join_candidates", "matched_redemptions", "merchant_daily_economics", "offer_daily_economics",
    "offer_funnel", "test_group_spend", "incrementality_enriched", "roas_efficiency", "risk_reasons",
    "top_risk_rows", "checks_cannibalization", "reconciliation", "recon_health", "money_formulas",
    "abuse_velocity", "privacy_lift", "pii_scan", "lineage_summary", "control_matching",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else [n for n in wanted.split(",") if n] or list(HEADLINE)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["top_keys"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
