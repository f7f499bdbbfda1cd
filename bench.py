"""Times the headline queries: whole results, written to Spark's no-op sink.

Reads $BENCH_SF_DIR on local[$BENCH_CPUS]; each query is the median of $BENCH_RUNS runs after one
warm-up run of all. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.compare import session  # noqa: E402
from checks.queries import QUERIES  # noqa: E402

HEADLINE = [
    "technicians_employees",
    "timestamp_base",
    "wip_appointments",
    "job_technicians",
    "invoiced_items",
    "sales_master_tracker",
    "tech_dispatch_report",
    "timesheet_summary",
    "gross_pay_items",
    "sold_hours_by_job",
    "installed_estimates_by_job",
    "lead_sales_by_parent",
    "lead_ids_by_parent",
    "paid_hours_by_job",
    "first_per_group",
    "top_n_per_group",
    "distinct_list",
    "lookup_join",
    "lookup_join_split",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = session(cpus)

    def timed(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in names:
        timed(name)
    seconds = {name: round(statistics.median(timed(name) for _ in range(runs)), 3) for name in names}
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": cpus,
        "spark": spark.version,
    }
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
