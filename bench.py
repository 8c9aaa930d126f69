"""Benchmark: each query once to warm up, then timed; prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS change the data, the cores and the
number of timed runs (the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from freshet.checks import QUERIES  # noqa: E402
from freshet.session import local_session  # noqa: E402

# Headline queries: one or more per operator group.
HEADLINE = [
    "flagship_matrix", "node_to_input_sum", "unpivot_nodes", "month_year_matrix", "ingest_wide_nodes",
    "full_merge_by_date", "left_join_override", "splice_by_year", "scenario_compare", "key_set_diff",
    "ratio_policies", "formula_sum", "formula_ratio", "delta_flows", "apportioned_diversion", "share_of_total",
    "cumulative_segments", "model_cube", "supplier_cube", "cube_explode", "pulse_ratio", "monthly_median",
    "seasonal_mean", "junction_ratio", "propagate_delta", "regression_fit", "gate_days_open", "gate_month_stats",
    "mean_flow_calsim2", "total_diverted_calsim2", "proportion_diverted_calsim3", "delta_proportion_diverted_calsim2",
    "proportion_flow_bypasses_calsim3", "gates_overtopped_action_5", "proportion_pulse_flows_calsim3",
    "proportion_flow_natal_calsim3", "node_matrices_calsim3", "regional_disaggregation", "partitioned_roundtrip",
]


def run(spark, sf: str, name: str) -> float:
    start = time.perf_counter()
    # The no-op sink computes every column of every row and collects nothing.
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, "freshet-bench")
    for name in names[:3]:
        run(spark, sf, name)
    times = {}
    for name in names:
        run(spark, sf, name)
        times[name] = round(statistics.median(run(spark, sf, name) for _ in range(runs)), 4)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": Path(sf).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
