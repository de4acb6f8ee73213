"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from firmlake.operators.latest import latest_success
from firmlake.plans import parsing
from firmlake.session import build_session
from firmlake.workload import QUERIES, interfaces

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
PARSED = ["819", "1058", "822", "851", "1114", "967", "973", "854"]
HEADLINE = [
    "latest_success", "call_report", "call_report_total", "abnormal_examples", "parse_report", "call_plan",
    "new_customers", "branch_list", "white_list", "merge_pages", "resolve_attempts", "replace_records", "replace_key",
    "partition_overwrite", "split_log", "load_report", "count_changes", "trace_ratio",
]


def seconds_for(build) -> float:
    began = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - began, 3)


def parse_times(spark) -> dict[str, float]:
    """Newest successes of a stored log to typed rows; making up the log from the test tables is not timed."""
    times = {}
    for key in PARSED:
        log = interfaces.stored_log(spark, SF_DIR, key, interfaces.PAYLOADS[key], int(CPUS))
        times[f"parse_{key}"] = seconds_for(lambda: parsing.parse(latest_success(log), key))
    return times


def main() -> None:
    spark = build_session(
        "firmlake-bench",
        f"local[{CPUS}]",
        **{
            "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "12g",
            "spark.log.level": "ERROR", "spark.ui.showConsoleProgress": "false",
        },
    )
    seconds_for(lambda: QUERIES[HEADLINE[0]](spark, SF_DIR))  # start-up of the JVM is not part of any query
    seconds = {name: seconds_for(lambda: QUERIES[name](spark, SF_DIR)) for name in HEADLINE}
    seconds |= parse_times(spark)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": SF_DIR}))


if __name__ == "__main__":
    main()
