"""M6 — one row per job: attributes, industry, job group, income, employer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recruitflow.functions import exprs
from recruitflow.operators.contracts import company_dims
from recruitflow.operators.joins import lookup
from recruitflow.params import Params
from recruitflow.sources.tables import Tables


def job_info(t: Tables, p: Params) -> DataFrame:
    """Jobs of existing companies with their labels.

    * industry group: the job's own industry (first listed), else the
      company's group;
    * ``j_business_type`` reproduces the source as written: the company's
      *group* when the job has no known industry, otherwise NULL;
    * employer name: the job's own company name (agent jobs), else the
      posting company's name.
    """
    com = company_dims(t, group_fallback_to_name=False).select(
        F.col("recruiter_company_id").alias("_com_id"), F.col("company_name").alias("_com_name"),
        F.col("company_type_cd").alias("_com_type"), F.col("business_group_name").alias("_com_group"))
    j = t.job.join(com, t.job.recruiter_company_id == com._com_id)
    j = lookup(j, t.mst_job_type, "job_type_cd", "job_type_cd")
    jbt = t.job_business_type.where(F.col("display_no") == 1).select(
        F.col("job_id").alias("_jbt_job"), F.col("business_type_cd").alias("_jbt_code"))
    j = j.join(jbt, j.job_id == jbt._jbt_job, "left")
    mbt = t.mst_business_type.select(F.col("business_type_cd").alias("_mbt_code"),
                                     F.col("business_type_group_cd").alias("_mbt_group"),
                                     F.col("business_type_name").alias("_mbt_name"))
    j = lookup(j, mbt, "_jbt_code", "_mbt_code")
    j = lookup(j, t.mst_area, "main_area_cd", "mst_area_cd")
    jc = t.job_company.select(F.col("job_id").alias("_jc_job"), F.col("company_name").alias("_jc_name"))
    j = j.join(jc, j.job_id == jc._jc_job, "left")
    return j.select(
        F.col("job_id").alias("j_job_id"),
        F.col("job_name").alias("j_job_name"),
        F.col("publish_start_tm").alias("j_publish_start_tm"),
        F.col("job_publish_type_cd").alias("j_publish_type_cd"),
        exprs.industry_group("_mbt_group", F.col("_com_group")).alias("j_business_g_type"),
        F.when(F.col("_mbt_name").isNull(), F.col("_com_group")).alias("j_business_type"),
        exprs.job_group("job_group_type_cd").alias("j_g_job_type"),
        F.col("job_type_name").alias("j_job_type"),
        F.col("employment_type_cd").alias("j_employment_type_cd"),
        F.col("income_lower").alias("j_income_lower"),
        F.col("income_upper").alias("j_income_upper"),
        exprs.income_range("income_lower", "income_upper").alias("j_income_range"),
        exprs.income_median("income_lower", "income_upper").alias("j_income_median"),
        F.coalesce(F.col("_jc_name"), F.col("_com_name")).alias("j_company_name"),
        F.col("area_name").alias("j_main_area_name"),
        F.col("recruiter_company_id").alias("j_recruiter_company_id"),
        F.col("_com_type").alias("j_company_type_cd"),
        F.col("_com_name").alias("j_source_company"))
