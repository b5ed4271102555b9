"""Benchmark the headline queries.

Runs each headline query over the tables in $BENCH_SF_DIR (default
/root/testdata/sf0.1) on local[$BENCH_CPUS] and prints ONE JSON line:
{"metric": ..., "value": total_seconds, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed in full with the ``noop`` sink (every row computed,
nothing collected to the driver).  Two passes run over the headline set: a
cold pass (first execution of each plan shape in a fresh JVM: includes
code generation and JIT warm-up) and a warm pass (steady state, as on a
long-running cluster).  ``value`` is the warm total; the cold per-query
times are reported alongside under ``cold``.  BENCH_PASSES=1 runs the cold
pass only; with more than two passes, the warm times are medians of all but
the cold one.  ``gauge`` tells the machine's speed at that time: the median CPU
time of a small loop in milliseconds, between the passes; 1 is usual, 2 is half
as fast.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "silver_transactions",
    "dedupe_latest",
    "fact_upsert",
    "daily_pnl",
    "monthly_balance_sheet",
    "transaction_summary",
    "kpi_vs_previous_period",
    "velocity_1h",
    "fraud_scores",
    "fraud_alerts",
    "dq_results",
    "dq_by_date",
    "fact_join_dims",
    "fraud_rate_alarm",
    "fraud_stream",
]


def gauge(times: int = 99) -> float:
    """Median CPU milliseconds of a loop that needs about one of them on a usual machine."""
    took = []
    for _ in range(times):
        t0 = time.process_time()
        sum(range(50_000))
        took.append((time.process_time() - t0) * 1000)
    return statistics.median(took)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE

    from ledgerline.plans.catalog import QUERIES
    from ledgerline.session import build_session

    passes = int(os.environ.get("BENCH_PASSES", "2"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus), extra={"spark.driver.memory": "16g"})
    QUERIES["null_profile"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start-up

    def run_pass() -> dict[str, float]:
        times: dict[str, float] = {}
        for name in names:
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        return times

    speeds = [gauge()]
    cold = run_pass()
    speeds.append(gauge())
    warms = []
    for _ in range(passes - 1):
        warms.append(run_pass())
        speeds.append(gauge())
    warms = warms or [cold]
    warm = {name: round(statistics.median(w[name] for w in warms), 3) for name in names}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total_wall_warm" if passes > 1 else "headline_queries_total_wall_cold",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "gauge": round(statistics.median(speeds), 2),
                "cold_total": round(sum(cold.values()), 3),
                "cold": cold,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
