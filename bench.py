"""Time the headline queries on whole tables and print one JSON line.

Each query runs over a ``noop`` sink (every row is computed, nothing is collected): once to warm the
JVM up, then three times, of which the median counts. Environment: ``BENCH_SF_DIR``, ``BENCH_CPUS``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from steadyline.plans.registry import QUERIES  # noqa: E402
from steadyline.session import build_session  # noqa: E402

HEADLINE = (
    "headway_mart_default",
    "headway_mart",
    "arrivals_lag",
    "arrivals_pattern",
    "headway",
    "section_summary",
    "freshness_mart",
    "gap_summary",
    "nearest_scheduled",
    "delay_by_timeband",
    "top_unstable_rush",
    "heartbeat_pivot",
    "json_extract",
    "bronze_batch_current",
    "read_position_api",
    "append_log",
    "upsert_current",
    "stream_source",
    "arrivals_incremental",
)


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "steadyline-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            # Call-site capture for error messages; costs a stack walk per column expression.
            "spark.python.sql.dataFrameDebugging.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in HEADLINE:
        seconds(spark, name, sf_dir)
        timings[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(3)), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total of medians",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
