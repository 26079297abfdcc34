"""Headline queries, timed.  Prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (warm runs, default 3).  The first run of a query is reported as cold; its
figure is the median of the warm runs that follow."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from churnpanel.plans.queries import registry
from churnpanel.session import build_session

HEADLINE = [
    "activity_daily", "combat_daily", "pledge_daily", "payment_transform", "level_progress",
    "trade_daily", "trade_item_pivot", "trade_counts", "panel_join", "panel_fill28",
    "panel_impute", "account_squeeze", "sliding7", "corr_spearman", "knn_vote", "score_profit",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        f"local[{cpus}]", "churnpanel-bench",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
           "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-")},
    )
    todo = sys.argv[1:] or HEADLINE
    queries = registry()
    warm: dict[str, float] = {}
    cold: dict[str, float] = {}
    for name in todo:
        took = []
        for _ in range(1 + max(1, runs)):
            start = time.time()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(round(time.time() - start, 3))
        cold[name], warm[name] = took[0], round(statistics.median(took[1:]), 3)
        print(f"{name}: cold {cold[name]} warm {warm[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(warm.values()), 3), "unit": "sec",
        "queries": warm, "cold": cold, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
