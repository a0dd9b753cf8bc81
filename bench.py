"""Benchmark the headline report queries.

Runs each report query over the whole stand-in tables at ``$BENCH_SF_DIR``
(default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints ONE JSON
line. Each query is executed in full through the ``noop`` sink (every row is
computed, nothing is collected to the driver). The first pass over the
queries is the cold one (JIT, class loading, file metadata); ``BENCH_REPEAT``
passes (default 3) follow it. Each query reports the median of those;
``value`` is the sum of the medians, ``cold`` has the seconds of the first pass.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "scheme_report",  # R1
    "department_report",  # R2
    "appointment_report",  # R3
    "diagnosis_rows",  # R4
    "diagnosis_by_gender",  # R4 summary
    "clinic_report",  # R5
    "service_time",  # R6
    "service_time_runs",  # R6 printed form
    "completed_visits",  # R7
    "clinic_by_gender",  # R7 summary
    "plan_summary",  # R8
    "cashier_rollup",  # R9
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE

    from clinicflow.registry import QUERIES
    from clinicflow.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus))
    def timed(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    cold = {name: round(timed(name), 3) for name in names}
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "3")))
    passes = [{name: timed(name) for name in names} for _ in range(repeat)]
    times = {name: round(statistics.median(p[name] for p in passes), 3) for name in names}

    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "report_queries_total_sec",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "cold": cold,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
