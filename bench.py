"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3:
the median of the runs after one warm-up is reported), BENCH_QUERIES (comma separated).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lumentab.plans import PLANS  # noqa: E402
from lumentab.session import local_session  # noqa: E402

HEADLINE = (
    "rank_score", "describe_all", "position_stats", "null_report", "nunique_report", "dedup_key", "fill_group_median",
    "iqr_filter", "scale_standard", "scale_robust", "label_encode", "binary_encode", "onehot_full", "group_multi",
    "pivot_mean", "histogram_bins", "boxplot_stats", "kde_grid", "corr_pearson", "corr_spearman", "mannwhitney", "avg_rank",
    "returns", "trend_slope", "split_strat3", "kfold_assign", "eval_by_split", "eval_auc", "threshold_sweep",
    "eps_pairs", "label_neighbours", "label_correct", "knn_kdist", "assign_nearest", "fcm_step", "potential_init",
    "silhouette_squared", "dbscan_orders",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "lumentab-bench")
    spark.sparkContext.setLogLevel("ERROR")
    took: dict[str, float] = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            PLANS[name](spark, sf).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
            spark.catalog.clearCache()
        took[name] = round(statistics.median(times[1:] or times), 3)
        print(f"{name}: {took[name]}s", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total_median_query_time", "value": round(sum(took.values()), 3), "unit": "sec",
        "queries": took, "sf": Path(sf).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
