"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = (
    "dominant_values",
    "value_counts",
    "segment_rows",
    "stop_check",
    "posting_categories",
    "all_rules",
    "tier_comparison",
    "signal_freq",
    "coverage_gates",
    "first_rows_per_segment",
    "split_sizes",
    "distance_to_dominant",
    "gower_distances",
    "gower_neighbours",
    "silhouette",
    "merged_segments",
    "split_by_place",
    "segment_catalogue",
    "class_report",
    "assignment_diff",
    "segment_view",
    "trained_cells",
    "batch_assignment",
    "kmeans_best",
    "k_sweep",
    "keyword_clusters",
    "density_clusters",
    "density_clusters_wide",
    "tier_grid",
    "variant_grid",
    "text_baseline_word",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE

    from segloom.plans import registry
    from segloom.runtime import session

    registry.load()
    spark = session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # start the executors
    seconds = {}
    for name in names:
        start = time.perf_counter()
        registry.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    result = {"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": Path(sf).name.removeprefix("sf")}
    print(json.dumps(result))


if __name__ == "__main__":
    main()
