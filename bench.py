"""Time the headline queries and print one JSON line."""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from careline.session import configure  # noqa: E402
from workloads import load  # noqa: E402

HEADLINE = (
    "birads_followup", "birads_followup_group_p", "activation_list", "biopsy_flag",
    "pathology_stage", "ihc_subtype", "ihc_subtype_samples", "ihc_stage", "accuracy_sentinel",
    "validation_sheet", "inconsistency_profile", "derive_returns_exam_codes", "overdue_rate",
    "document_ihc_labels", "document_pathology_labels", "document_marker_counts",
    "document_categories", "document_carcinoma", "dedupe_visit", "row_index_by_key",
    "save_create_or_merge",
)


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("careline-bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    queries, _ = load()
    times = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            queries[name](spark, sf).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken), 3)
        print(f"{name} {[round(t, 2) for t in taken]}", file=sys.stderr)
    print(json.dumps({"metric": "headline queries, median of runs", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
