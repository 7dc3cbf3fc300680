"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores. The model tables are derived and
stored before the clock starts, so the figures are those of the operators; ``fixture`` is what that took.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import all_queries  # noqa: E402
from checks.compare import test_session  # noqa: E402
from checks.fixtures import store_model  # noqa: E402
from dayplan.session import scratch_dir  # noqa: E402

HEADLINE = (
    "q_zone_totals", "q_zone_home_work", "q_impute_skims", "q_skim_access_all", "q_tod_features",
    "q_tod_choice", "q_mode_choice", "q_departure_times", "q_activity_plans", "q_nearest_node",
    "q_wlcm_utilities", "q_wlcm", "q_nodes_walk", "q_nodes_small", "q_reachable_drive",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = test_session(os.environ.get("BENCH_CPUS", "8"))
    queries, _ = all_queries()
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor threads
    begin = time.perf_counter()
    store_model(spark, folder, f"{scratch_dir(spark)}/bench-model")
    fixture = round(time.perf_counter() - begin, 3)
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        begin = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "fixture": fixture, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
