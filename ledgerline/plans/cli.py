"""Command line for the jobs: ``python -m ledgerline.plans.cli <job> ...``.

``validate`` exits 0 when every expectation passes and 1 otherwise (DQ12).
On a cluster, submit with ``spark-submit`` and leave ``--master`` unset.
"""

from __future__ import annotations

import argparse
import json
import sys

from ..session import build_session
from ..streaming import fraud_stream
from . import jobs


def main(argv: list[str] | None = None, stop_session: bool = True) -> int:
    p = argparse.ArgumentParser(prog="ledgerline")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="job", required=True)
    g = sub.add_parser("generate")
    g.add_argument("--records", type=int, default=10000)
    g.add_argument("--accounts", type=int, default=1000)
    g.add_argument("--days", type=int, default=90)
    g.add_argument("--output", required=True)
    g.add_argument("--format", default="csv")
    g.add_argument("--seed", type=int, default=42)
    g.add_argument("--end-date", default=None, help="last transaction date (default: today)")
    i = sub.add_parser("ingest")
    i.add_argument("--source", required=True)
    i.add_argument("--bronze", required=True)
    i.add_argument("--quarantine", required=True)
    i.add_argument("--format", default="csv")
    i.add_argument("--checkpoint", default=None, help="remember ingested files here and take only new ones")
    st = sub.add_parser("stream")
    st.add_argument("--source", required=True)
    st.add_argument("--output", required=True)
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--thresholds", default=None, help="JSON file that is read again for every micro-batch")
    st.add_argument("--keep-running", action="store_true", help="wait for new files instead of stopping when all are done")
    t = sub.add_parser("transform")
    t.add_argument("--bronze", required=True)
    t.add_argument("--silver", required=True)
    ld = sub.add_parser("load")
    ld.add_argument("--silver", required=True)
    ld.add_argument("--fact-out", required=True)
    ld.add_argument("--fact-prev", default=None)
    v = sub.add_parser("validate")
    v.add_argument("--input", required=True)
    v.add_argument("--output", required=True)
    v.add_argument("--config", default=None)
    v.add_argument("--dataset", default="transactions")
    v.add_argument("--run-date", default=None)
    a = p.parse_args(argv)

    spark = build_session(a.master, app_name=f"ledgerline-{a.job}")
    if a.job == "generate":
        jobs.generate_job(spark, a.output, a.records, a.accounts, a.days, a.format, seed=a.seed, end_date=a.end_date)
        out: dict = {"written": a.records}
    elif a.job == "ingest" and a.checkpoint:
        for q in jobs.start_ingest_stream(spark, a.source, a.bronze, a.quarantine, a.checkpoint, a.format):
            q.awaitTermination()
        out = {"incremental": True}
    elif a.job == "stream":
        started = fraud_stream.start_fraud_stream(
            spark, a.source, a.output, a.checkpoint, available_now=not a.keep_running, thresholds_path=a.thresholds
        )
        for q in started:
            q.awaitTermination()
        out = {"streamed": True}
    elif a.job == "ingest":
        out = jobs.ingest(spark, a.source, a.bronze, a.quarantine, a.format)
    elif a.job == "transform":
        out = jobs.transform(spark, a.bronze, a.silver)
    elif a.job == "load":
        out = jobs.load(spark, a.silver, a.fact_out, a.fact_prev)
    else:
        out = jobs.validate_job(spark, a.input, a.output, a.dataset, a.config, a.run_date)
    print(json.dumps(out, default=str))
    if stop_session:
        spark.stop()
    return jobs.exit_code(out) if a.job == "validate" else 0


if __name__ == "__main__":
    sys.exit(main())
