"""Times headline queries; prints one JSON line. BENCH_SF_DIR, BENCH_CPUS."""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

from pyspark.sql import SparkSession  # noqa: E402

from methylspark import catalog  # noqa: E402

HEADLINE = [
    "a3_allc_pattern_stats", "a2_context_counts", "a14_pseudobulk_merge", "a15_multigroup_merge", "a16_strand_merge", "a17_binned_track", "f1_unique_multi", "r4_call_string_level",
    "r3_read_methylation", "u4_split_at_cut_sites", "j1_demultiplex", "j9_interval_join", "j12_feature_counts", "c2_best_parts", "c8_contact_dedup", "c11_call_contacts", "c15_contact_matrix",
    "w3_bh_fdr", "w7_dmr_regions", "w8_coverage", "w10_mark_duplicates", "a18_plate_grid", "j4_summary_assembly",
]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    took: dict[str, float] = {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        runs = []
        for _ in range(3):
            began = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - began)
        took[name] = round(statistics.median(runs[1:]), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
