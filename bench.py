"""Wall time of the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3, the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from suite.queries import QUERIES  # noqa: E402

HEADLINE = [
    "bin_stat_price", "bin_stat_equal_width", "bin_stat_two_features", "bin_stat_fixed_edges_left", "psi_by_bin",
    "quantile_edges", "roc_curve_ties", "auc_right", "auc_trapezoid", "ks", "auc_weighted", "class_stats",
    "binary_report", "binary_report_by_date", "bin_stat_by_date", "performance_table", "performance_by_date",
    "nunique", "column_profile", "shrink_types", "usage_report", "first_per_key", "chunk_ids", "export_chunked",
    "clean_text", "assemble_documents",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs):
            started = time.perf_counter()
            # The noop sink runs the whole query without bringing rows to the driver.
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times), 3)
    spark.stop()
    scale = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    result = {"metric": "total median wall time", "value": round(sum(seconds.values()), 3), "unit": "sec"}
    print(json.dumps({**result, "queries": seconds, "sf": float(scale) if scale.replace(".", "").isdigit() else scale}))


if __name__ == "__main__":
    main()
