"""Benchmark of the headline queries.

Runs each query in ``QUERIES`` on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]``; every run executes the
whole plan into the no-op sink (nothing is collected), after one warm-up
run; the per-query value is the median of ``$BENCH_REPEAT`` (default 3)
timed runs.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from histlake.plans.registry import QUERIES as ALL  # noqa: E402
from histlake.session import build_session  # noqa: E402

# The payroll flow end to end, the audit/dashboard flow, text and profile
# jobs, and one streaming replay.
QUERIES = [
    "bronze_keys_tenure", "snapshot_latest", "group_summary", "employee_summary",
    "top_100_compensation", "status_distribution", "scd2_history", "scd2_payroll_history",
    "inactive_keys", "reconcile_counts", "scd1_latest_log", "log_last_run", "log_status_table",
    "work_list", "reference_positions", "html_list_items", "page_date_extract", "sheet_clean",
    "profile_summary", "profile_histogram", "quality_report", "stream_scd2",
]


def run_once(spark, name, sf_dir) -> float:
    t = time.perf_counter()
    df = ALL[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def default_driver_memory() -> str:
    """16g, or 60% of physical memory on a smaller machine."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
        return f"{max(1, min(16, int(total * 0.6 / 2**30)))}g"
    except (ValueError, OSError, AttributeError):
        return "4g"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(f"local[{cpus}]", app="histlake-bench", shuffle_partitions=cpus * 2,
                          conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", default_driver_memory()),
                                "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="histlake-wh-")})
    spark.sparkContext.setLogLevel("ERROR")
    results, errors = {}, {}
    for name in (list(ALL) if only == ["all"] else only or QUERIES):  # the headline list, some, or all
        try:
            run_once(spark, name, sf_dir)  # warm-up (JIT, file listing, metadata)
            times = [run_once(spark, name, sf_dir) for _ in range(repeat)]
            results[name] = round(statistics.median(times), 3)
        except Exception as e:  # noqa: BLE001 - one failing query must not hide the others
            results[name] = None
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    sf_text = os.path.basename(sf_dir).replace("sf", "")
    try:
        sf = float(sf_text)
    except ValueError:
        sf = sf_text
    out = {"metric": "sum_of_median_query_seconds",
           "value": round(sum(v for v in results.values() if v is not None), 3),
           "unit": "sec", "queries": results, "sf": sf}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
