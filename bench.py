"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dryspell.plans.catalog import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

# Every query on the nation binding and the manifests, and the heavier ones with suppliers as units.
BY_SUPPLIER = (
    "runs_rle", "clipped_runs_binned", "events_scored", "eligibility", "source_sensitivity",
    "qa_summary", "web_codes",
)
HEADLINE = [q for q in QUERIES if not q.endswith("_by_supplier")]
HEADLINE += [f"{q}_by_supplier" for q in BY_SUPPLIER]
CHOSEN = os.environ.get("BENCH_QUERIES")
NAMES = CHOSEN.split(",") if CHOSEN else HEADLINE


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("dryspell-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["eligibility"](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    times = {}
    for name in NAMES:
        laps = []
        for _ in range(RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            laps.append(time.perf_counter() - start)
        times[name] = round(sorted(laps)[len(laps) // 2], 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
