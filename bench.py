"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line {"metric", "value", "unit", "queries", "sf", ...}. Each query is
run once to warm up, then timed over $BENCH_RUNS runs (median); the value is the sum of
the medians. Results are fully materialised through a no-op sink (``write.format
("noop")``), so every row of every query is computed without driver collection.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewater.plans.queries import REGISTRY  # noqa: E402
from tidewater.session import get_spark  # noqa: E402

HEADLINE = [
    "channel_metrics", "page_uv_metrics", "login_metrics", "keyword_metrics",
    "user_jump", "daily_unique_visitor", "fix_new_flag", "split_dirty",
    "order_wide", "order_metrics", "payment_metrics", "province_order_metrics",
    "spu_order_metrics", "refund_metrics", "cart_user_metrics", "register_metrics",
    "refund_wide", "maintain_dims", "interval_join_10m", "gmv_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=4 * cpus,
                      conf={"spark.driver.memory": "16g"})
    times: dict[str, float] = {}
    for name in names:
        q = REGISTRY[name]
        q(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            q(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
