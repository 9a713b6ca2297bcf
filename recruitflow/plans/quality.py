"""Data-quality checks stated by the report definitions, as violation DataFrames.

Each function returns the rows that break a stated invariant (empty =
holds).  They are aggregates over the marts, never collected whole.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recruitflow.functions import exprs


def repeated_candidates(candidate_info: DataFrame) -> DataFrame:
    """'One row per candidate' is not guaranteed: first-listed resume
    children can fan a candidate out.  Returns (candidate, rows) with rows > 1."""
    return (candidate_info.groupBy("c_candidate_id").agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def repeated_companies(company_info: DataFrame) -> DataFrame:
    """'One row per company' for the latest-contract mart."""
    return (company_info.groupBy("b_company_id").agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def overlapping_contract_actions(company_log: DataFrame) -> DataFrame:
    """Actions that met more than one contract in force (documented overlaps):
    (act_type, act_id, act_date, company, job, n_contracts)."""
    keys = ["act_type", "act_id", "act_date", "recruiter_company_id", "job_id"]
    return (company_log.where(F.col("b_contract_id").isNotNull())
            .groupBy(*keys).agg(F.countDistinct("b_contract_id").alias("n_contracts"))
            .where(F.col("n_contracts") > 1))


def before_window(log: DataFrame, bound: datetime, date_col: str = "act_date") -> DataFrame:
    """Log rows older than the window bound."""
    return log.where(F.col(date_col) < exprs.ntz(bound))


def owner_rows(df: DataFrame, owner_id: int, company_col: str = "recruiter_company_id") -> DataFrame:
    """Rows attributed to the platform company where the definition excludes it."""
    return df.where(F.col(company_col) == owner_id)


def duplicate_kept_contracts(contracts: DataFrame) -> DataFrame:
    """Kept contracts sharing (company, start) or (company, end): the
    de-duplication promises none.  Returns (key kind, company, date, n)."""
    def dups(kind: str, col: str) -> DataFrame:
        return (contracts.groupBy("b_company_id", F.col(col).alias("b_date"))
                .agg(F.count(F.lit(1)).alias("n_contracts")).where(F.col("n_contracts") > 1)
                .select(F.lit(kind).alias("key_kind"), "b_company_id", "b_date", "n_contracts"))
    return dups("start", "b_contract_start_date").unionByName(dups("end", "b_contract_end_date"))
