"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3).
Each query is built and run in full into a sink that drops the rows; the value is the
median of the runs after one warm-up, summed over all queries.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

from tidemark.plans import QUERIES
from tidemark.session import build_session

HEADLINE = [
    "ob18_before_after_report", "ob0_rule_table", "ob6_words_full", "ob7_words_internal", "ob16_shuffle_column_values",
    "fp1_numeric_encrypt", "fp5_encrypt_columns", "fp8_round_trip_errors", "fp10_aes_digits_encrypt", "ae4_join_on_encrypted_keys",
    "ln1_lineage_edges", "ln3_latest_edges", "ops1_validate_trailers", "ops4_arrival_sla", "sd6_missing_by_file", "sd11_summary_or_missing",
    "txt1_between_markers", "txt3_section_ids", "txt10_assemble", "mp1_run_mapping", "gn7_fake_people",
    "ag3_group_by", "ag4_chain_top_k", "jn1_inner_expression", "jn11_multi_key", "wn1_row_number", "wn2_global_row_number",
    "src3_csv_with_schema", "zip1_zip_lines", "ss4_masked_stream",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    took: dict[str, float] = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        took[name] = round(statistics.median(times[1:]), 3)
        print(f"{name} {times[0]:.2f} {took[name]}", file=sys.stderr)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec",
                      "queries": took, "sf": float(scale.group(1)) if scale else None}))


if __name__ == "__main__":
    main()
