"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

"etl_star" is the one-off build of the published star (clean, join, deduplicate, write), timed after the same
build on the smallest tables has warmed the JVM; the queries then run over it. Every query is executed in full into a no-op sink: one warm-up run, then the median of three.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from salesloom.plans.mart import mart
from salesloom.plans.registry import callables

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
WARM_DIR = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.001")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "q01_revenue_by_region", "q02_monthly_trend", "q03_top_products", "q04_customer_lifetime_value",
    "q05_repeat_purchases", "q06_return_rate_by_category", "q07_lowest_margin_products", "q08_cohort_retention",
    "q09_next_purchases", "q10_discount_bands", "q11_payment_modes", "q12_worst_products", "q13_daily_sales",
    "w05_w06_customer_journey", "a1_overview", "a2_by_category", "a3_by_region", "a4_by_discount_band",
    "a5_customer_profiles", "a6_region_category", "a7_monthly", "k05_w07_pareto_curve", "b13_b16_previous_periods",
    "b17_b20_period_to_date", "b21_b22_product_ranks", "b23_customer_ranks", "v11_category_matrix",
    "x1_k12_correlations", "i13_kpi_targets", "i20_repeat_returns", "r1_rfm", "f4_seasonal_naive_compat",
    "f5_series_errors_category", "f5_series_errors_product", "f7_horizon_total",
]
# Each makes something once per mart, so it is timed on its first run: 50 K-means starts, a stream over the whole fact, the daily series, the warehouse.
ONCE = ["r2_r3_cluster_scores", "s13_daily_sales_stream", "f2_filled_days", "s04_s14_warehouse"]
# Each publishes an index or ranks on its first run and then reads it; the first run is timed beside.
PUBLISHED = ["w05_w06_customer_journey", "k05_w07_pareto_curve", "b21_b22_product_ranks", "b23_customer_ranks"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS).config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = callables()
    if os.path.isdir(WARM_DIR):
        mart(spark, WARM_DIR).build()
    seconds = {"etl_star": timed(lambda: mart(spark, SF_DIR).build())}
    for name in ONCE:
        seconds[name] = timed(lambda: run(queries[name](spark, SF_DIR)))
        print(f"{name:36s} {seconds[name]:7.3f}", file=sys.stderr, flush=True)
    for name in HEADLINE:
        query = queries[name]
        first = timed(lambda: run(query(spark, SF_DIR)))
        if name in PUBLISHED:
            seconds[f"{name}_first"] = first
        seconds[name] = statistics.median(timed(lambda: run(query(spark, SF_DIR))) for _ in range(RUNS))
        print(f"{name:36s} {seconds[name]:7.3f}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": {k: round(v, 3) for k, v in seconds.items()}, "sf": SF_DIR.rstrip("/").split("sf")[-1],
    }), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
