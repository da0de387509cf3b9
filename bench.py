"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the number of local cores.
Every query's full result is computed (written to the no-op sink), and its time
includes the jobs that run while the query is built.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from studytrace.checks.queries import QUERIES
from studytrace.session import local_session

HEADLINE = (
    "log_time_slice",
    "users_in_slice",
    "preprocess_log",
    "problem_prior_accuracy",
    "user_problem_prior_accuracy",
    "level4_proficiency",
    "feature_stage",
    "feature_stage_in_blocks",
    "later_slice_features",
    "order_history_scale",
    "train_test_split",
    "sample_prefix",
    "sample_prefix_in_slots",
    "minmax_scaled_scalars",
    "assembled_features",
    "assembled_features_negative_levels",
    "category_codes",
    "correlation_matrix",
    "validation_accepted",
    "seed_rejects",
    "stage_summary",
    "feature_store_roundtrip",
    "benchmark_score",
    "model_scores",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = local_session(cores, cores)
    spark.sparkContext.setLogLevel("ERROR")
    # Start-up and class loading are not part of the first query's time.
    QUERIES["problem_prior_accuracy"](spark, folder).limit(1).collect()

    seconds = {}
    for name in names:
        started = time.perf_counter()
        result = QUERIES[name](spark, folder)
        result.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
