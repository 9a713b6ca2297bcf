"""Logins and interest clicks reduced to days."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recruitflow.functions import codes
from recruitflow.sources.tables import Tables


def candidate_login_days(t: Tables, since: datetime | date) -> DataFrame:
    """Distinct (login day, candidate) after the registration day, excluding
    the day a candidate left.

    Logins are reduced to distinct (candidate, day) first — a bot with
    millions of logins becomes a few hundred rows before any join.
    """
    lg = (t.since("candidate_login_history", "login_tm", since)
          .select(F.col("cid").alias("candidate_id"), F.to_date("login_tm").alias("act_date")).distinct())
    reg = t.candidate.select(F.col("candidate_id").alias("_reg_id"), F.to_date("ins_datetime").alias("_reg_day"))
    lg = lg.join(reg, (lg.candidate_id == reg._reg_id) & (reg._reg_day < lg.act_date), "left_semi")
    left_day = t.candidate.where(F.col("candidate_status_cd") == codes.CANDIDATE_LEFT).select(
        "candidate_id", F.to_date("upd_datetime").alias("act_date"))
    return lg.join(left_day, ["candidate_id", "act_date"], "left_anti")


def company_login_days(t: Tables, since: datetime | date, company_type: str, owner_id: int | None = None) -> DataFrame:
    """Recruiter logins reduced to one row per (company, day) with the
    largest login id (a max() per group, partially aggregated map-side)."""
    rll = t.since("recruiter_login_log", "login_tm", since)
    r = t.recruiter.select(F.col("recruiter_id").alias("_r_id"), F.col("recruiter_company_id").alias("_r_cid"))
    rc = t.recruiter_company.where(F.col("company_type_cd") == company_type).select(F.col("recruiter_company_id"))
    if owner_id is not None:
        rc = rc.where(F.col("recruiter_company_id") != owner_id)
    j = rll.join(r, rll.recruiter_id == r._r_id).join(rc, F.col("_r_cid") == rc.recruiter_company_id)
    return j.groupBy("recruiter_company_id", F.to_date("login_tm").alias("act_date")).agg(
        F.max("recruiter_login_log_id").alias("act_id"))


def interest_clicks(t: Tables, since: datetime | date) -> DataFrame:
    """'Interested' clicks since ``since``."""
    return t.since("recruiter_correspond_data", "conversion_tm", since).where(
        F.col("conversion_type_cd") == codes.CONVERSION_INTERESTED)
