"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from checks.registry import CHECKS
from martkit.session import local_session

HEADLINE = [
    "latest_rank", "temporal_join_inner", "temporal_join_left", "asof_latest_order", "latest_row_number",
    "mixed_order_rank", "update_lookup", "flag_matched", "count_distinct_group", "sum_by_month_key",
    "addon_adds", "addon_churns", "order_slice_load", "tv_slice_load", "staging_slice_loads",
    "account_addon_load", "services_per_account", "flag_migrated_events", "base_snapshot",
    "account_plan_base", "commission_revenue", "rewrite_names", "name_usage",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session("bench")
    times: dict[str, float] = {}
    for name in HEADLINE:
        taken = []
        for _ in range(1 + runs):  # the first run warms up and stores the source tables
            start = time.perf_counter()
            # Runs the whole plan and drops the rows, so that no result travels to the driver.
            CHECKS[name].spark(spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total_median_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
