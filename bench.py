"""Time the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

Every query is run to a sink that discards its rows, once to warm up and then
$BENCH_RUNS times (default 1); the fastest run counts. ``--compare`` times the
rewritten operators against their plain forms instead (benchmarks/plain.py).
"""

from __future__ import annotations

import json
import os
import sys
import time

from strata.plans import registry
from strata.session import local_session

HEADLINE = [
    "backfill_entity", "cumulate_entity", "scd2_backfill", "scd2_incremental", "state_change",
    "membership_edges", "cooccurrence_edges", "daily_activity", "datelist_int", "activity_flags", "monthly_hit_array",
    "host_activity_reduced", "coactivity_users", "growth_accounting_backfill", "retention_curve", "grouping_sets_dashboard",
    "game_leaders", "rolling_trends", "funnel_conversion", "best_stretch", "longest_streak", "bucket_join_report",
    "top_map_for_medal", "geo_enrich", "sessionize", "tumbling_counts", "experiment_readout", "kpi_rollup",
]


def timed(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("strata-bench", os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    if "--compare" in sys.argv:
        from benchmarks.plain import PAIRS

        pairs = {name: (lambda f=f: f(spark, sf), lambda g=g: g(spark, sf)) for name, (f, g) in PAIRS.items()}
        result = {}
        for name, (plain, ours) in pairs.items():
            result[name] = {}
            for label, run in (("plain", plain), ("ours", ours)):
                timed(run)
                result[name][label] = round(min(timed(run) for _ in range(max(runs, 2))), 2)
        print(json.dumps({"compare": result, "sf": sf}))
        return
    chosen = [a for a in sys.argv[1:] if not a.startswith("-")] or HEADLINE
    seconds = {}
    for name in chosen:
        query = registry.QUERIES[name]
        timed(lambda: query(spark, sf))
        seconds[name] = round(min(timed(lambda: query(spark, sf)) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
