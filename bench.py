"""Times the headline queries over whole tables and prints one JSON line.

BENCH_SF_DIR picks the tables, BENCH_CPUS the cores, BENCH_QUERIES a comma-separated
list of names (``all`` for every registered query).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparkdesk.plans import all_queries  # noqa: E402
from sparkdesk.session import get_session  # noqa: E402

HEADLINES = (
    "csv_lines", "write_csv", "write_csv_compressed", "write_parquet", "export_stats", "generate_demo", "cell_instant",
    "cell_local_ts", "cell_binary", "cell_uuid", "escape_java", "csv_escape", "json_parse", "json_find", "json_flatten",
    "order_response", "order_decision", "latest_orders", "first_per_key", "insert_if_absent", "violation_summary",
    "caption_context", "caption_tracks", "caption_doc", "pick_track", "unique_names", "ordered_union", "job_fold",
    "job_status", "verify_tokens", "stream_orders", "stream_job_fold",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    queries = all_queries()
    names = list(queries) if chosen == "all" else chosen.split(",") if chosen else HEADLINES
    spark = get_session(
        "sparkdesk-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_orderstatus").count().collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": seconds, "sf": float(scale)}))


if __name__ == "__main__":
    main()
