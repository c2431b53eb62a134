"""Benchmark the headline dataflows; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list to restrict). Each query runs to completion into
Spark's ``noop`` sink (full execution, nothing collected); model queries
include their fit. Each query runs twice and the faster wall time counts (the
first run also pays JVM JIT and codegen warm-up at this small scale), but for
those in ``ONCE``; the value is the sum over queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cardsight import get_spark  # noqa: E402
from cardsight.plans import catalog  # noqa: E402

HEADLINE = [
    "d1_features",  # D1: 12 window features + 2 flags
    "d2_split_train",  # D2: prequential split, training side
    "d2_split_test",  # D2: test side with the known-fraud anti join
    "d3_three_way_split",  # D3 over the feature table
    "e4_roc",  # E4: ROC curve per dataset
    "e5_roc_auc",  # E5: exact ROC AUC
    "e1_metrics",
    "b3_undersample",
    "b7_folds",
    "j5_knn",  # exact 5-NN among frauds
    "b2_smote",
    "w1_sliding_features",  # D1 by the direct form, beside the block form
    "m1_gbt",  # balanced GBT fit of 200 rounds + validation scoring
]
ONCE: set[str] = set()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    names = only or HEADLINE
    spark = get_spark(
        f"local[{cpus}]",
        app_name="cardsight-bench",
        shuffle_partitions=cpus * 2,
        extra={"spark.driver.memory": "16g"},
    )
    qs = catalog.queries()
    # Warm the JVM (class loading, codegen) on the smallest tables.
    smoke = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(smoke):
        qs["d1_features"](spark, smoke).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        best = None
        for _ in range(1 if name in ONCE else 2):
            t0 = time.time()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            elapsed = time.time() - t0
            best = elapsed if best is None else min(best, elapsed)
        times[name] = round(best, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "headline_dataflows_wall_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )


if __name__ == "__main__":
    main()
