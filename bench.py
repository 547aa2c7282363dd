"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores (default all).
Each result is computed in full and thrown away; a query's time is the better of two runs, so that it is
not the JVM warming up that is measured. Whole jobs, which write tables, run once.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from martloom.queries import REGISTRY  # noqa: E402
from martloom.session import session  # noqa: E402

HEADLINE = [
    "flatten_readings",
    "flatten_alerts",
    "flatten_joined_orders",
    "json_shred_ordered",
    "json_objects_ordered",
    "xml_shred",
    "first_match_children",
    "session_facts",
    "ticket_rows",
    "ticket_message_rows",
    "clean_layer",
    "outlier_trim",
    "percentile_bounds",
    "daily_extremes",
    "latest_version",
    "latest_payloads",
    "row_hash_full",
    "row_hash_incremental",
    "upsert_merge",
    "insert_ignore",
    "replace_children",
    "incremental_extract",
    "quality_checks",
    "constraint_checks",
    "user_activity_mart",
    "ticket_efficiency_mart",
    "report_resolution",
    "topic_batch",
]
JOBS = ["stations_to_parquet", "csv_to_extremes", "target_full_then_incremental", "gated_run", "stream_replicate"]


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    REGISTRY[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    conf = {
        "spark.master": f"local[{cpus}]",
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    spark = session("martloom-bench", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or HEADLINE + JOBS
    times = {}
    for name in chosen:
        runs = 1 if name in JOBS else 2
        times[name] = round(min(seconds(spark, name, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    scale = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {"metric": "headline queries, total time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": scale}
        )
    )


if __name__ == "__main__":
    main()
