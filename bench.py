"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the tables and the cores. Each query
runs once to warm up, then ``BENCH_RUNS`` times; the median counts. Results are
written to the no-op sink, so every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from workload import QUERIES  # noqa: E402

HEADLINE = (
    "counts_single_plain",
    "counts_single_combine",
    "counts_single_many_labels",
    "counts_single_family",
    "counts_multi_plain",
    "counts_multi_family",
    "set_totals",
    "crosstab_x",
    "crosstab_family",
    "crosstab_many_labels",
    "crosstab_multi_lift",
    "rank_distribution_banded",
    "rank_distribution_family",
    "set_combinations",
    "staged_funnel_percent",
    "flow_links_percent",
    "flow_links_many_labels",
    "normalize_yes_no",
    "extract_semver_documents",
    "normalize_text",
    "split_sections",
    "report_index",
    "report_document",
    "report_full",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "total median seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": cpus,
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
