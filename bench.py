"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 4)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from finflow.plans.catalog import QUERIES  # noqa: E402
from finflow.session import build_session  # noqa: E402

HEADLINE = (
    "txn_05_account_profile",
    "agg_02_avg_min_max_sum",
    "agg_04_count_and_count_distinct",
    "agg_09_drop_duplicates_by_key",
    "jon_01_inner_by_expression",
    "jon_05_full_outer",
    "jon_12_broadcast_join",
    "jon_13_cogroup",
    "win_01_rolling_average",
    "win_02_range_frame",
    "win_03_unbounded_frames",
    "win_07_rank",
    "txn_01_parse_lines",
    "txn_04_clean_finances",
    "udf_03_built_in_equivalent",
    "stm_06_tumbling_window_count",
    "stm_18_state_on_table",
    "stm_18_state_every_window",
    "stm_20_state_of_active_accounts",
    "stm_25_fraud_on_table",
    "stm_25_fraud_stream",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    spark = build_session(
        "finflow-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start-up of the JVM, the scan and the Python workers is not the queries' time.
    spark.read.parquet(f"{folder}/region.parquet").write.format("noop").mode("overwrite").save()
    QUERIES["udf_02_column_udf"](spark, folder).write.format("noop").mode("overwrite").save()

    # Fixed work that no change to the library touches: rounds on other machines compare by it.
    began = time.perf_counter()
    fixed = spark.range(20_000_000).selectExpr("id % 100003 as k", "cast(id * 7919 % 1000003 as double) as v")
    fixed.groupBy("k").agg({"v": "sum", "*": "count"}).write.format("noop").mode("overwrite").save()
    calibration = round(time.perf_counter() - began, 3)

    seconds = {}
    for name in HEADLINE:
        began = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "calibration_sec": calibration,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
