"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR: tables (default /root/testdata/sf0.1). BENCH_CPUS: local cores (default 8).
BENCH_RUNS: timed runs per query, the median counts (default 3).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from salesloom.plans.star_schema import QUERIES

HEADLINE = [
    "sales_enriched",
    "total_sales_per_customer",
    "top_selling_customers",
    "total_sales_per_city",
    "average_sales_per_weather",
    "average_order_quantity_per_product",
    "top_selling_products",
    "sales_trends_daily",
    "sales_trends_monthly",
    "sales_trends_quarterly",
    "users_with_weather",
    "extract_payload",
    "flatten_customer",
    "customer_ordinal",
    "lookup_enrich",
    "full_refresh_results",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        samples = []
        for run in range(runs + 1):  # the first one warms up
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if run:
                samples.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(samples), 3)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    report = {
        "metric": "sales mart headline queries, sum of medians",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else sf_dir,
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
