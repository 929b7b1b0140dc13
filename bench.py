"""Time the headline queries and print one JSON line.

Reads ``BENCH_SF_DIR`` (default sf0.1) on ``local[BENCH_CPUS]``.  Every query is run to
completion into a no-op sink, once to warm up and then timed.  Prices, states and forecasts are made from the
events and stored as Parquet before the clock starts, as a warehouse has them; ``BENCH_FIXTURE=1``
makes them inside every query, as earlier rounds did.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "price_final", "daily_outcome", "forecast_join", "asof_latest", "forecast_1300", "forecast_2000", "features",
    "features_legacy", "quality_report", "run_label", "merge_new_rows", "merge_stats", "merge_partition", "range_page",
    "stream_asof_latest", "report_parse", "archive_unpack", "profile_columns", "describe_numeric", "quantile_bins", "join_alignment",
    "duplicate_keys", "tumble_30m", "load_sorted", "stream_daily_outcome", "asof_join", "stored_asof", "stream_late_outcome",
    "profile_incremental",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    from checks import QUERIES
    from tidemark.session import build_session

    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        "spark.checkpoint.dir": os.environ.get("BENCH_SHARED") or tempfile.mkdtemp(prefix="bench-shared-")})
    spark.sparkContext.setLogLevel("ERROR")
    if not os.environ.get("BENCH_FIXTURE"):
        from checks import base
        from tidemark.session import shared_folder
        base.store_inputs(spark, sf_dir, shared_folder(spark, "bench-inputs"))
    only = sys.argv[1:] or HEADLINE
    took = {}
    for name in only:
        best = None
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = time.perf_counter() - start
        took[name] = round(best, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec",
                      "queries": took, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                      "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
