"""Time the headline cases: one JSON line. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lumbre.session import build_session  # noqa: E402
from lumbre.workloads import CASES  # noqa: E402

HEADLINE = [
    "ivr_detail",
    "document_best_row",
    "document_known_row",
    "customer_phone",
    "masiva_lg",
    "info_by_phone_lg",
    "recall_24h",
    "ivr_summary",
    "sink_ctas_summary",
    "merge_duplicates",
    "engagement_label",
    "stratified_split",
    "apply_preprocessing",
    "distinct_per_column",
    "describe",
    "quantiles",
    "histogram_fixed",
    "box_stats_by_group",
    "value_counts",
    "correlation",
    "classification_report",
    "audit_primary_key",
    "audit_foreign_key",
    "image_quality",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1_000_000).selectExpr("id % 7 AS k", "id").groupBy("k").count().collect()
    seconds = {}
    for name in names:
        begin = time.perf_counter()
        CASES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
