"""Wall seconds of the headline queries, after one warm-up run each. Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wattlane.catalog import QUERIES  # noqa: E402
from wattlane.session import build_session  # noqa: E402

HEADLINE = [
    "clean_flagship", "clean_readings", "clean_readings_grid", "dedupe_first", "dedupe_aggregate",
    "calendar_features", "impute_hierarchy", "impute_ratio", "impute_mode_by_key", "cap_iqr", "quantiles",
    "grid_complete", "grid_fill_labels", "profile_columns", "qa_report", "mean_by_hour", "spearman_matrix",
    "histogram_bins", "boxplot_numbers", "feature_build", "split_three_way", "folds_repeated",
    "regression_metrics", "cv_summary", "checks_report", "ridge_one_feature", "knn_exact", "train_forest",
    "batch_score", "stream_window_mean",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8)
    seconds = {}
    for name in names:
        run(spark, name, sf_dir)
        seconds[name] = round(run(spark, name, sf_dir), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "total_wall_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
