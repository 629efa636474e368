"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  folder of the Parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    runs per query, the fastest counts (default 2)

Every query is built and written in full to the no-op sink; building includes the
jobs that fit statistics and models.
"""

from __future__ import annotations

import json
import os
import time

from orderloom.plans.queries import REGISTRY
from orderloom.session import local_session

HEADLINE = (
    "null_profile",
    "distinct_profile",
    "impute_mean_distinct",
    "latest_review",
    "review_features",
    "order_features",
    "order_items_rollup",
    "payment_rollup",
    "payment_agreement",
    "basetable",
    "basetable_holdout",
    "report_delivery_status",
    "one_hot",
    "tree_predict_top10",
    "logreg_predict",
    "score_output",
)


def seconds(spark, name: str, folder: str) -> float:
    began = time.perf_counter()
    REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "bench")
    seconds(spark, "table_counts", folder)
    times = {
        name: round(min(seconds(spark, name, folder) for _ in range(runs)), 3) for name in HEADLINE
    }
    spark.stop()
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
