"""recruitflow: recruiting-funnel reporting marts on PySpark.

The package turns the raw tables of a job-matching site (candidates,
applications, scout threads, contracts, jobs, logins) into six
analysis-ready DataFrames:

* ``plans.candidate_action_log``        candidate-side event log
* ``plans.candidate_basic_info``        one profile row per candidate
* ``plans.company_info``                latest main contract per company
* ``plans.company_action_log``          company-side event log + contract in force
* ``plans.company_action_log_fixed``    company log from a fixed start, cohort dates
* ``plans.job_info``                    job attributes + employer

Everything is expressed with built-in Spark SQL functions; there is no
Python UDF in any plan.
"""

from recruitflow.params import Params

__all__ = ["Params"]
