"""Summarise the executed plans of the marts over Parquet sources.

    python tools/plan_report.py [sf_dir]

For each mart: counts of the physical operators that matter at scale and
the filters pushed into each Parquet scan.  Runs the query first so the
report shows the final adaptive plan.
"""
import collections
import os
import re
import sys
import tempfile

sys.path.insert(0, ".")
from recruitflow.plans.standin_queries import STANDIN_PARAMS as P  # noqa: E402
from recruitflow.session import local_session  # noqa: E402
from recruitflow.sources.standins import write_standins  # noqa: E402

OPS = ["SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct",
       "Exchange hashpartitioning", "Exchange rangepartitioning", "BroadcastExchange", "HashAggregate",
       "ObjectHashAggregate", "SortAggregate", "WindowGroupLimit", "Window ", "Generate", "Scan parquet",
       "Scan ExistingRDD", "PythonUDF", "ArrowEvalPython", "BatchEvalPython"]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="recruitflow-plans-")
    spark = local_session(8)
    t = write_standins(spark, sf, os.path.join(scratch, "src"))
    from recruitflow.plans import (candidate_action_log, candidate_basic_info, company_action_log,
                                   company_action_log_fixed, company_info, job_info)
    marts = {"M1 candidate_action_log": candidate_action_log.candidate_action_log,
             "M2 candidate_basic_info": candidate_basic_info.candidate_basic_info,
             "M3 company_info": company_info.company_info,
             "M4 company_action_log": company_action_log.company_action_log,
             "M5 company_action_log_fixed": company_action_log_fixed.company_action_log_fixed,
             "M6 job_info": job_info.job_info}
    for name, fn in marts.items():
        df = fn(t, P)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        counts = collections.Counter()
        for op in OPS:
            counts[op.strip()] = len(re.findall(re.escape(op) + (r"(?!GroupLimit)" if op == "Window " else ""), plan))
        print(f"### {name}\n")
        print("| operator | count |\n| --- | --- |")
        for op, n in counts.items():
            if n:
                print(f"| {op} | {n} |")
        print("\npushed filters per scan:\n")
        seen = set()
        for line in plan.split("\n"):
            m = re.search(r"Location: InMemoryFileIndex\([^)]*\)\[file:[^\]]*/src/([a-z_]+)\].*?"
                          r"PushedFilters: \[(.*?)\]?, ReadSchema: struct<(.*?)(?:>|$)", line)  # fields may be cut "..."
            if not m or (m.group(1), m.group(2)) in seen:
                continue
            seen.add((m.group(1), m.group(2)))
            cols = ", ".join(c.split(":")[0] for c in m.group(3).split(","))
            print(f"* `{m.group(1)}` reads ({cols}); pushed: {m.group(2) or '—'}")
        print()


if __name__ == "__main__":
    main()
