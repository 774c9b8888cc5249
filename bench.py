"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from larder.plans import queries as registry

HEADLINE = [
    "dq_rules", "dq_duplicates", "dq_nulls", "clean_order_items", "clean_summary", "join_wide", "join_audit",
    "line_features", "item_features", "customer_rfm", "classify_approx", "classify_exact", "label_comparison",
    "multi_indicator_label", "rfm_segments", "frequent_itemsets", "association_rules", "weekly_demand",
    "forecast_metrics", "forecast_rows", "waste_risk_scores", "recommendations", "key_figures", "daily_revenue",
    "scenario_price", "price_as_of", "stock_roll_forward", "near_duplicate_orders", "event_study", "pattern_checks",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "16g")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or HEADLINE
    registry.run("status_histogram", spark, sf_dir).collect()  # starts the executors
    times, failed = {}, {}
    for name in chosen:
        start = time.perf_counter()
        try:
            registry.run(name, spark, sf_dir).write.format("noop").mode("overwrite").save()
        except Exception as error:  # the other queries are timed all the same
            failed[name] = str(error).splitlines()[0]
            print(f"{name} failed: {failed[name]}", file=sys.stderr, flush=True)
            continue
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_time_headline_queries", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "failed": failed, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
