"""Benchmark of the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from cohortspark.queries import QUERIES
from cohortspark.session import local_session

HEADLINE = [
    "pivot_measurements",
    "interval_join_stay",
    "interval_join_fuzzy",
    "episode_detail",
    "code_flags_exists",
    "align_timelines",
    "describe_by",
    "column_medians",
    "ffill_bfill",
    "resample_1h",
    "resample_fill",
    "observation_window",
    "fix_length_series",
    "cohort_flow",
    "label_continuous",
    "kfold",
    "oversample",
    "smote",
    "panel_features_random",
    "auroc",
    "auprc",
    "auc_grid",
    "score_cube",
    "soft_vote",
    "federated_fit",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=cpus, memory="12g")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
