"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3),
BENCH_QUERIES (comma-separated, default the headline set, ``all`` for every query). Each
query runs once to warm up, then BENCH_RUNS times; the median is reported. Results are
consumed in full by Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from panelforge.runtime import drop_scratch, local_session
from panelforge.workload.queries import QUERIES

HEADLINE = (
    "scan_parquet clean_numeric clean_date dictionary_typing csv_roundtrip_clean safe_ratio "
    "occupancy_trend staffing_vs_occupancy low_staffing_ranking rank_national_state "
    "latest_per_key nearest_join readmission_correlation state_month_avg kpis state_zscore "
    "linear_fit_grid topn_lowest top_states turnover_trend histogram group_corr "
    "manifest_diff mirror_actions tree_paths duplicate_keys incremental_stream "
    "mirror_runs gold_roundtrip bootstrap_plan manifest_state_json mirror_swaps restated_release"
).split()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in names:
        seconds(name)
        times[name] = round(statistics.median(seconds(name) for _ in range(runs)), 3)
        drop_scratch(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_median_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf.rstrip("/")),
                "cpus": cpus,
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
