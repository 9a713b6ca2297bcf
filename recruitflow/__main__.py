"""Batch job: build the marts from the 35 Parquet sources.

    python -m recruitflow --sources s3://.../recruiting --out s3://.../marts \\
        [--as-of 2018-08-31T20:00:00] [--only company_action_log,company_info]

    (or spark-submit --py-files recruitflow.zip recruitflow/__main__.py ...)

``--as-of`` (naive UTC) defaults to the job's start time, read once here
and passed down as a parameter.  The session is the one the launcher
provides; ``--input-gb``, the size of the sources, sets its shuffle
partitions and the other settings of a large run.  ``--publish`` leaves
the last marts readable until the new ones are whole.
"""

from __future__ import annotations

import argparse
from datetime import date, datetime, timezone

from pyspark.sql import SparkSession

from recruitflow.params import Params
from recruitflow.plans.catalog import write_all
from recruitflow.session import apply_cluster_defaults
from recruitflow.sources.tables import Tables


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> list[str]:
    """Parse arguments, read the sources and write the requested marts."""
    ap = argparse.ArgumentParser(prog="recruitflow")
    ap.add_argument("--sources", required=True, help="folder with one Parquet dataset per source table")
    ap.add_argument("--out", required=True, help="output folder for the marts")
    ap.add_argument("--as-of", help="'now' as naive UTC ISO timestamp (default: job start)")
    ap.add_argument("--since", help="fixed start of the cohort log (default 2017-08-01)")
    ap.add_argument("--contract-since", help="earliest contract start of the company log (default 2016-08-01)")
    ap.add_argument("--input-gb", type=float, help="size of the sources, for the settings of a large run")
    ap.add_argument("--publish", action="store_true",
                    help="write each mart as a new version and switch to it when it is whole")
    ap.add_argument("--by-month", action="store_true",
                    help="dated sources are partitioned by event month (sources.layout.write_by_month)")
    ap.add_argument("--only", help="comma-separated mart names")
    a = ap.parse_args(argv)
    as_of = datetime.fromisoformat(a.as_of) if a.as_of else datetime.now(timezone.utc).replace(tzinfo=None)
    extra = {}
    if a.since:
        extra["since"] = date.fromisoformat(a.since)
    if a.contract_since:
        extra["contract_since"] = date.fromisoformat(a.contract_since)
    p = Params(as_of=as_of, **extra)
    spark = spark or SparkSession.builder.appName("recruitflow").getOrCreate()
    if a.input_gb:
        apply_cluster_defaults(spark, int(a.input_gb * 1e9))
    t = (Tables.from_months if a.by_month else Tables.from_parquet)(spark, a.sources)
    return write_all(t, p, a.out, a.only.split(",") if a.only else None, a.publish)


if __name__ == "__main__":
    main()
