"""Prints one JSON line: seconds of the headline queries, best of the runs after a warm-up."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from strandweave.plans import more, queries as plans

HEADLINE = (
    "unique_best_hit", "multiplicity_filter", "alignment_report", "feature_counts", "feature_overlap_fraction", "nearest_left", "coverage_rle", "window_islands", "ptr_summary", "cluster_intervals",
    "known_junctions", "pairs_in_band", "pair_classes", "pair_distance_hist", "known_variant_band", "weighted_coverage", "kmer_counts", "seed_map_documents", "extend_score",
    "repeat_class", "map_reads", "mapped_unique", "merged_hits_all", "reads_near_regions", "max_scan",
)


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in HEADLINE:
        runs = []
        for _ in range(2):
            began = time.time()
            (plans.QUERIES | more.QUERIES)[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - began)
        took[name] = round(min(runs), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
