"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR   folder of the tables   (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores            (default 8)

Each query is run to the end into a ``noop`` sink. The document index is built
first and timed on its own; the retrieval queries then reuse it, as an index is
built once and asked often. Model time is the stub's and no model latency.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession

HEADLINE = (
    "c1_chunk_fixed c2_chunk_hierarchical c3_chunk_semantic e7_diff_ingest j4_text_retrieve j4_topk_retrieve r2_retrieve_hybrid "
    "r4_retrieve_cells r5_build_context r6_answer r7_answer_extractive k3_mask_pii k6_apply_policy k10_screening_report k8_policy_findings "
    "p3_extraction_prompt p5_payload_messages x3_extract_claim x5_coverage_rows x6_policy_sections m3_process_documents m7_grounding m8_quality_scores "
    "g3_model_table g5_feedback_rates g8_concat_ordered j7_join_feedback v2_latest_version w2_screen_stream w3_feedback_by_hour"
).split()


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(names: list[str]) -> None:
    from paperloom.checks import QUERIES
    from paperloom.checks.base import document_index

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    spark.range(10_000).selectExpr("sum(id)").collect()  # start the executors
    seconds: dict[str, float] = {}

    def timed(name, work):
        start = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - start, 3)

    if not names:
        timed("index_build", lambda: document_index(spark, sf_dir))
    for name in names or HEADLINE:
        timed(name, lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf_dir.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main(sys.argv[1:])
