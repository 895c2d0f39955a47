"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries":
{name: seconds}, "sf"}.  Each query is executed in full with the ``noop``
sink (no collect); a short untimed warm-up on the smallest data starts the
JVM and the Python workers first.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from encore.plans.queries import QUERIES  # noqa: E402
from encore.session import local_session  # noqa: E402

HEADLINE = [
    "parse_interactions", "zscore_ratings", "train_test_split", "rmse_baseline",
    "similar_items", "item_neighbours_nested", "parse_click_log", "recent_queue",
    "click_candidates", "realtime_scores", "realtime_recs_all_clicks", "realtime_recs_latest",
    "ratings_after_clicks", "user_history", "user_favourites", "user_recs_by_score",
    "user_status", "user_dashboard", "stream_recs_latest", "als_item_factors", "als_rmse",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          app="encore-bench")
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):
        for n in ("similar_items", "realtime_recs_latest"):
            QUERIES[n](spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t0 = time.perf_counter()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
        print(f"{n}: {times[n]}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
