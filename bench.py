"""Wall time of the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line.

Arguments name the queries to run; `all` runs every registered one.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from beaconry.bindings import all_queries
from beaconry.session import build_session

HEADLINE = [
    "scan_wide_features", "join_star_facts", "join_theta_levels", "agg_levels", "agg_top_list", "window_group_rank",
    "window_top_k_by_limit", "cohort_feature_population", "group_sticky_assignment", "push_candidate_state",
    "push_daily_selection", "rerank_items", "crowd_package", "feedback_messages", "feedback_app", "delivery_app_slots",
    "report_retention_list", "report_pool_percentiles", "report_warehouse_union", "report_touched_assets",
    "evaluation_funnel", "match_rules_and_term", "match_fund_risk", "sample_monthly", "fn_clean_documents",
    "metric_one_vs_one",
]


def run(spark, build, directory: str) -> float:
    start = time.perf_counter()
    build(spark, directory).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    known = all_queries()
    names = sys.argv[1:] or HEADLINE
    names = list(known) if names == ["all"] else names
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    times = {}
    for name in names:
        runs = sorted(run(spark, known[name], directory) for _ in range(repeat + 1))
        times[name] = round(runs[(len(runs) - 1) // 2], 3)
    found = re.search(r"sf([0-9.]+)", directory)
    print(json.dumps({"metric": "total_wall_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": float(found.group(1)) if found else None}))
    spark.stop()


if __name__ == "__main__":
    main()
