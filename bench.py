"""Times the headline queries and prints one JSON line. BENCH_SF_DIR: tables (default /root/testdata/sf0.1); BENCH_CPUS: threads (default 8); BENCH_RUNS: runs of each query, of which the median counts (default 3)."""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from quernstone.plans import catalog  # noqa: E402

HEADLINE = [
    "evidence_topk", "regex_rank", "table_header_rank", "semantic_rank_filtered", "rrf_fusion", "labeling_composite", "label_aggregate", "numeric_evidence_top8", "context_budget", "record_attribution", "dedupe_cleanup",
    "endpoint_constraint", "numeric_parse", "standardize_terms", "postprocess_dedupe_merge", "postprocess_summary", "records_csv_projection", "identity_antijoin", "criteria_decision", "paragraph_chunking", "html_light_metadata",
]


def main():
    d, cpus, runs = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8"), int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        took = []
        for _ in range(runs + 1):  # the first run warms up
            began = time.perf_counter()
            catalog.queries()[name](spark, d).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(took[1:]), 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(d.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
