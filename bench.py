"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8) choose data and cores. Each query runs
once to warm up and then ``BENCH_RUNS`` times; the best run counts. Results go to a no-op sink, so every row is computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from arriero.plans.registry import QUERIES  # noqa: E402
from arriero.session import build_session  # noqa: E402

HEADLINE = [
    "spend_concentration", "spend_concentration_all_months", "dedupe_latest_item", "fact_orders", "fact_items",
    "typed_items_roundtrip", "scd2_history", "run_checks", "parse_positions", "stream_latest_state", "masked_items_job", "warehouse_months",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", cpus, {
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"), "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    took: dict[str, float] = {}
    for name in names:
        best = float("inf")
        for turn in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if turn:
                best = min(best, time.perf_counter() - start)
        took[name] = round(best, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
