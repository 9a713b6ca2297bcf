"""Benchmark the headline queries.

1. ``standin_build``: derive the 35 recruiting source tables from the
   test tables in ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) and
   write them as Parquet to a fresh scratch folder (the production shape
   of the sources);
2. every mart, plus the distinct-action funnel, over those Parquet
   sources, each fully executed into a no-op sink (nothing collected).

``local[$BENCH_CPUS]`` (default 8).  Prints one JSON line; ``value`` is
the sum of the mart timings; the stand-in build is reported as
``setup_sec``.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from recruitflow.operators.counts import funnel_counts  # noqa: E402
from recruitflow.plans.candidate_action_log import candidate_action_log  # noqa: E402
from recruitflow.plans.candidate_basic_info import candidate_basic_info  # noqa: E402
from recruitflow.plans.company_action_log import company_action_log, company_actions  # noqa: E402
from recruitflow.plans.company_action_log_fixed import company_action_log_fixed  # noqa: E402
from recruitflow.plans.company_info import company_info  # noqa: E402
from recruitflow.plans.job_info import job_info  # noqa: E402
from recruitflow.plans.standin_queries import STANDIN_PARAMS as P  # noqa: E402
from recruitflow.session import local_session  # noqa: E402
from recruitflow.sources.layout import write_bucketed  # noqa: E402
from recruitflow.sources.standins import write_standins  # noqa: E402

HEADLINE = {
    "company_info": company_info,
    "job_info": job_info,
    "candidate_action_log": candidate_action_log,
    "company_action_log": company_action_log,
    "company_action_log_fixed": company_action_log_fixed,
    "candidate_basic_info": candidate_basic_info,
    # distinct actions per month and type; the contract merge only repeats rows, so it is skipped
    "company_funnel": lambda t, p: funnel_counts(company_actions(t, p), ["act_type"], "act_id"),
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="recruitflow-bench-")
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")),
                          warehouse_dir=os.path.join(scratch, "wh"))
    # warm-up (JVM, codegen caches): every headline query once on the smallest data set, untimed
    warm = write_standins(spark, "/root/testdata/sf0.001", os.path.join(scratch, "warm"))
    for fn in HEADLINE.values():
        fn(warm, P).write.format("noop").mode("overwrite").save()

    t0 = time.perf_counter()
    tables = write_standins(spark, sf_dir, os.path.join(scratch, "sources"))
    layout = os.environ.get("BENCH_LAYOUT", "files")
    if layout == "bucketed":
        tables = write_bucketed(spark, tables, "bench_sources", int(os.environ.get("BENCH_BUCKETS", "8")))
    setup = round(time.perf_counter() - t0, 3)
    times: dict[str, float] = {}
    for name, fn in HEADLINE.items():
        t0 = time.perf_counter()
        fn(tables, P).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                      "cpus": cpus, "setup_sec": setup, "layout": layout}))


if __name__ == "__main__":
    main()
