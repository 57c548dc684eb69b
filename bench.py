"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from caseloom.plans import QUERIES
from caseloom.session import build_session

HEADLINE = [
    "date_spine_occupancy",
    "star_left_join",
    "fact_metric_rollup",
    "interaction_tracking",
    "conditional_distinct_counts",
    "latest_row",
    "double_rank_dedup",
    "duplicate_flag",
    "family_total_window",
    "nest_children",
    "explode_shared",
    "bridge_dedup_nested",
    "family_profile",
    "form_pivot",
    "html_fields",
    "positional_layout_parse",
    "clean_name",
    "blocked_pairs",
    "fuzzy_dedup",
    "exact_rule_dedup",
    "delta_feedback",
    "incremental_merge",
    "scd2_snapshot",
    "wap_publish",
    "dq_suite",
    "fct_visits",
    "mart_person_tracking",
    "mart_visits_report",
    "mart_provider_units",
]
RUNS = int(os.environ.get("BENCH_RUNS", "1"))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in names:
        runs = []
        for _ in range(RUNS + 1):  # the first run warms up and is not counted
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(runs[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
