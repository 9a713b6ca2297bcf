"""M3 — latest main contract per company (one row per company)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recruitflow.operators.contracts import drop_duplicate_contracts, latest_contract_per_company, main_contracts
from recruitflow.params import Params
from recruitflow.sources.tables import Tables

COLUMNS = ["b_company_id", "b_company_name", "b_company_type", "b_company_area", "b_com_g_business",
           "b_com_business", "b_contract_prd_cd", "b_contract_prd", "b_recent_contract_start_date",
           "b_recent_contract_end_date"]


def clean_contracts(t: Tables, p: Params) -> DataFrame:
    """Main contracts of all company types, duplicate starts removed."""
    return drop_duplicate_contracts(main_contracts(t, p.owner_company_id))


def company_info(t: Tables, p: Params) -> DataFrame:
    """Latest main contract per company with the company's labels (platform excluded)."""
    latest = latest_contract_per_company(clean_contracts(t, p))
    return latest.select(
        "b_company_id", "b_company_name", "b_company_type", "b_company_area", "b_com_g_business", "b_com_business",
        "b_contract_prd_cd", "b_contract_prd",
        F.col("b_contract_start_date").alias("b_recent_contract_start_date"),
        F.col("b_contract_end_date").alias("b_recent_contract_end_date"))
