"""Contracts: clean-up, duplicate removal, recency rank, days in force."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recruitflow.functions import codes, exprs
from recruitflow.operators.joins import explode_days, lookup
from recruitflow.operators.ranking import asc_nulls_last, first_per_group, first_row, row_number_in_group
from recruitflow.sources.tables import Tables


def company_dims(t: Tables, group_fallback_to_name: bool = True) -> DataFrame:
    """Companies with area name and industry labels.

    Columns: recruiter_company_id, company_name, company_type_cd,
    area_name, business_group_name, business_type_name.  An unknown
    industry group falls back to the industry name, or to NULL when
    ``group_fallback_to_name`` is False.
    """
    rc = t.recruiter_company
    d = lookup(rc, t.mst_area, "area_cd", "mst_area_cd")
    d = lookup(d, t.mst_business_type, "business_type_cd", "business_type_cd")
    fallback = F.col("business_type_name") if group_fallback_to_name else None
    return d.select(
        "recruiter_company_id", "company_name", "company_type_cd", "area_name",
        exprs.industry_group("business_type_group_cd", fallback).alias("business_group_name"),
        "business_type_name")


def main_contracts(t: Tables, owner_id: int, company_type: str | None = None,
                   start_since: date | None = None, with_dims: bool = True) -> DataFrame:
    """Main-plan, non-deleted contracts of real companies (platform excluded).

    Columns use the public ``b_`` names plus ``ins_datetime`` for ordering.
    ``start_since`` filters *before* any ranking, as the source does.
    """
    pr = t.purchase_receipt.where(
        (F.col("product_category_cd") == codes.PRODUCT_MAIN) & (F.col("del_flg") == codes.NOT_DELETED)
        & (F.col("recruiter_company_id") != owner_id))
    if start_since is not None:
        pr = pr.where(F.col("valid_from_date") >= F.lit(start_since))
    comp = company_dims(t) if with_dims else t.recruiter_company.select("recruiter_company_id", "company_type_cd")
    if company_type is not None:
        comp = comp.where(F.col("company_type_cd") == company_type)
    j = pr.join(comp.withColumnRenamed("recruiter_company_id", "_cid"), pr.recruiter_company_id == F.col("_cid"))
    cols = [
        F.col("purchase_receipt_id").alias("b_contract_id"),
        F.col("recruiter_company_id").alias("b_company_id"),
        F.col("product_cd").alias("b_contract_prd_cd"),
        F.col("product_name").alias("b_contract_prd"),
        F.col("valid_from_date").alias("b_contract_start_date"),
        F.col("valid_to_date").alias("b_contract_end_date"),
        F.col("ins_datetime"),
    ]
    if with_dims:
        cols += [F.col("company_name").alias("b_company_name"), F.col("company_type_cd").alias("b_company_type"),
                 F.col("area_name").alias("b_company_area"), F.col("business_group_name").alias("b_com_g_business"),
                 F.col("business_type_name").alias("b_com_business")]
    return j.select(*cols)


def _first_inserted_key() -> list:
    # Earliest inserted first; NULL insert times last; contract id breaks ties.
    return [*asc_nulls_last("ins_datetime"), F.col("b_contract_id")]


def drop_duplicate_contracts(df: DataFrame, by_end_too: bool = False) -> DataFrame:
    """Keep the earliest inserted contract per (company, start) and, with
    ``by_end_too``, also per (company, end) — both choices are made on the
    same input, then applied together.

    Each choice is a min() aggregate per group (partially aggregated on
    the map side, so one huge company is reduced before the shuffle).
    The first carries the whole row; the second is applied with a semi
    join on the contract id (the table's key).
    """
    out = first_row(df, ["b_company_id", "b_contract_start_date"], _first_inserted_key())
    if by_end_too:
        keep_end = first_per_group(df, ["b_company_id", "b_contract_end_date"], _first_inserted_key(),
                                   "b_contract_id")
        out = out.join(keep_end.select("b_contract_id"), "b_contract_id", "left_semi")
    return out


def _recency_order() -> list:
    return [F.col("b_contract_start_date").desc_nulls_first(), F.col("b_contract_id").asc()]


def rank_recent(df: DataFrame, out: str = "b_recent_contract") -> DataFrame:
    """Recency rank per company: 1 = latest start (NULL start ranks first).

    Contracts are de-duplicated first: one per company and start date, so
    the window's groups are bounded by the days of the calendar.
    """
    return row_number_in_group(df, "b_company_id", _recency_order(), out)


def latest_contract_per_company(df: DataFrame) -> DataFrame:
    """Top-1 per company by recency.

    ``row_number() = 1`` is planned by Catalyst with a partial
    WindowGroupLimit: each task keeps its best row per company before the
    shuffle, so a company never reaches one task whole.
    """
    w = Window.partitionBy("b_company_id").orderBy(*_recency_order())
    return df.withColumn("_recent", F.row_number().over(w)).where(F.col("_recent") == 1).drop("_recent")


def contract_days(contracts: DataFrame, calendar: DataFrame, first: date, last: date) -> DataFrame:
    """One row per (contract, calendar day) with the day in ``[start, end]``.

    Days are generated from each contract's own range (clipped to the
    calendar window; contracts spread over tasks by their exploded size),
    then kept only if present in the calendar.  The
    calendar holds at most one row per day of a bounded window, so it is
    broadcast; no nested-loop theta join is planned.
    """
    days = explode_days(contracts, "b_contract_start_date", "b_contract_end_date", "cal_date",
                        clip_lo=first, clip_hi=last, spread_by="b_contract_id")
    return days.join(F.broadcast(calendar), "cal_date", "left_semi")


def calendar(t: Tables, first: date, last: date) -> DataFrame:
    """Distinct days of the daily company table within ``[first, last]``.

    At most ``last - first + 1`` rows: a proven bound for broadcasting.
    """
    d = t.analytical_company_daily_data
    return (d.where((F.col("target_date") >= F.lit(first)) & (F.col("target_date") <= F.lit(last)))
            .select(F.col("target_date").alias("cal_date")).distinct())
