"""Registry of the marts and operators run on the stand-in tables.

Each entry is ``name -> (spark, sf_dir) -> DataFrame``.  All read the test
tables through ``sources.standins`` so their work grows with the data.
Stand-in parameters: "now" is 2001-07-31 20:00 UTC (the JST and UTC
month windows differ: 2000-07-01 vs 2000-06-01), the fixed start is
2000-08-01 and contracts count from 1999-08-01.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from recruitflow.params import Params
from recruitflow.plans.candidate_action_log import candidate_action_log
from recruitflow.plans.candidate_basic_info import candidate_basic_info
from recruitflow.plans.company_action_log import company_action_log
from recruitflow.plans.company_action_log_fixed import company_action_log_fixed
from recruitflow.plans.company_info import company_info
from recruitflow.plans.job_info import job_info
from recruitflow.sources.standins import standin_tables
from recruitflow.sources.tables import Tables

STANDIN_PARAMS = Params(as_of=datetime(2001, 7, 31, 20, 0, 0), since=date(2000, 8, 1),
                        contract_since=date(1999, 8, 1))

Query = Callable[[SparkSession, str], DataFrame]


def _on_standins(fn: Callable[[Tables, Params], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(standin_tables(spark, sf_dir), STANDIN_PARAMS)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


MARTS: dict[str, Query] = {
    "company_info": _on_standins(company_info),
    "job_info": _on_standins(job_info),
    "candidate_action_log": _on_standins(candidate_action_log),
    "company_action_log": _on_standins(company_action_log),
    "company_action_log_fixed": _on_standins(company_action_log_fixed),
    "candidate_basic_info": _on_standins(candidate_basic_info),
}


def all_queries() -> dict[str, Query]:
    """The six marts plus every operator-level query."""
    from recruitflow.plans import operator_queries
    return {**MARTS, **operator_queries.QUERIES}
