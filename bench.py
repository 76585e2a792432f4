"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of cores, ``BENCH_QUERIES`` a
comma-separated choice (``all`` for every registered query).  Each time covers building the
query, including the tables it writes on the way, and computing every row of its result.  Gold
tables and reports read stored layers; building those, once, is timed as ``stored_layers``.
"""

from __future__ import annotations

import json
import os
import time

from lettera.plans.catalog import QUERIES, Workspace
from lettera.session import local_session

HEADLINE = [
    "silver_pupil", "silver_municipality", "silver_state", "silver_goal",
    "gold_indicator_municipality", "gold_indicator_state", "gold_indicator_total",
    "gold_goal_vs_result_municipality", "gold_goal_vs_result_state",
    "gold_goal_vs_result_total",
    "gold_evolution_municipality", "gold_evolution_state", "gold_evolution_total",
    "gold_ml_features",
    "q1_result_vs_goal", "q2_goal_reached", "q3_distance_by_goal_year",
    "q4_state_ranking", "q5_states_below", "q6_state_spread",
    "q7_national_goal_vs_result", "q8_national_indicator", "q9_national_evolution",
    "additive_parts", "dim_enrich", "dim_enrich_large", "prior_year_context",
    "dedup_rows", "dedup_by_key", "count_distinct", "goal_map_explode", "stream_ingest",
    "latest_goal", "stream_refresh", "write_scope",
]


def chosen() -> list[str]:
    wanted = os.environ.get("BENCH_QUERIES", "")
    if wanted == "all":
        return list(QUERIES)
    return [q for q in wanted.split(",") if q] or HEADLINE


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    QUERIES["additive_parts"](spark, folder).write.format("noop").mode("overwrite").save()

    seconds = {}
    start = time.perf_counter()
    Workspace(spark, folder).layers
    seconds["stored_layers"] = round(time.perf_counter() - start, 3)
    for name in chosen():
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rsplit("/sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
