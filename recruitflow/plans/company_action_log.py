"""M4 — company-side action log with the contract in force on the action date.

Twelve branches (contract days, first job publication, auto-scout
segments, login days, scouts sent, footprints, interest clicks,
applications, document-screening passes, first interviews, offers, net
decisions) are unioned, then left-joined to the cleaned, ranked contracts
with ``start <= act_date <= end``.  Overlapping contracts give one row per
contract, as documented by the report; count with distinct ``act_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recruitflow.functions import codes, exprs
from recruitflow.operators import activity, applications, scouts
from recruitflow.operators.contracts import (calendar, contract_days, drop_duplicate_contracts, main_contracts,
                                             rank_recent)
from recruitflow.operators.joins import interval_left_join
from recruitflow.operators.logs import to_schema, union_log
from recruitflow.params import Params
from recruitflow.sources.tables import Tables

ACTION_SCHEMA = T.StructType([
    T.StructField("act_date", T.TimestampNTZType()),
    T.StructField("act_id", T.LongType()),
    T.StructField("act_type", T.StringType()),
    T.StructField("recruiter_company_id", T.LongType()),
    T.StructField("job_id", T.LongType()),
    T.StructField("route_info", T.StringType()),
    T.StructField("replace_income", T.LongType()),
])
CONTRACT_COLUMNS = ["b_contract_id", "b_company_name", "b_company_type", "b_company_area", "b_com_g_business",
                    "b_com_business", "b_contract_prd_cd", "b_contract_prd", "b_contract_start_date",
                    "b_contract_end_date", "b_recent_contract"]
ACT = codes.M4_ACT
CRS = codes.COMPANY_DIRECT
#: Marks an application's row that meets its log (no action by itself).
MEETS_LOG = "log"


def ranked_contracts(t: Tables, p: Params) -> DataFrame:
    """CRS main contracts since ``contract_since``, duplicate starts *and*
    ends removed, with the recency rank kept as a column."""
    c = main_contracts(t, p.owner_company_id, company_type=CRS, start_since=p.contract_since)
    return rank_recent(drop_duplicate_contracts(c, by_end_too=True))


def crs_applications(t: Tables, p: Params) -> DataFrame:
    """Direct-hiring applications (platform excluded) with route; scout lookup windowed."""
    return applications.applications_with_route(t, p.owner_company_id, p.local_bound(), numbered=True,
                                                company_type=CRS, with_json=True)


def days_under_contract(t: Tables, p: Params) -> DataFrame:
    """One row per calendar day per CRS contract in force (end day included)."""
    first, last = p.utc_bound().date(), p.calendar_last_day()
    con = drop_duplicate_contracts(main_contracts(t, p.owner_company_id, company_type=CRS, with_dims=False))
    d = contract_days(con, calendar(t, first, last), first, last)
    return to_schema(d.select(F.col("cal_date").alias("act_date"), F.col("b_company_id").alias("act_id"),
                              F.col("b_company_id").alias("recruiter_company_id")), ACTION_SCHEMA,
                     act_type=ACT["contract"])


def _crs_companies(t: Tables) -> DataFrame:
    """Direct-hiring company ids."""
    return t.recruiter_company.where(F.col("company_type_cd") == CRS).select(
        F.col("recruiter_company_id").alias("_crs"))


def first_publications(t: Tables, p: Params) -> DataFrame:
    """First publication time per job (min over its status log).

    The status log is first reduced to its earliest publication per admin
    record (partial aggregation map-side), then joined and reduced per
    job: a min of mins, exact, and a job with a huge log never reaches
    the join whole.
    """
    log = (t.job_status_change_log.where(F.col("job_status_cd") == codes.JOB_PUBLISHED)
           .groupBy("job_admin_info_id").agg(F.min("ins_datetime").alias("_first")))
    first = (t.job_admin_info.join(log, "job_admin_info_id").groupBy("job_id")
             .agg(F.min("_first").alias("publish_datetime"))
             .where(F.col("publish_datetime") >= exprs.ntz(p.local_bound())))
    j = t.job.join(first, "job_id").join(_crs_companies(t), F.col("recruiter_company_id") == F.col("_crs"), "left_semi")
    return to_schema(j.select(F.col("publish_datetime").alias("act_date"), F.col("job_id").alias("act_id"),
                              "recruiter_company_id", "job_id"), ACTION_SCHEMA, act_type=ACT["publish"])


def auto_scout_segments(t: Tables, p: Params) -> DataFrame:
    """Auto-scout job segments switched to sending, in the window (direct-hiring jobs)."""
    s = t.since("job_segment_info", "ins_datetime", p.local_bound()).where(
        (F.col("scout_type_cd") == codes.SEGMENT_SCOUT_TYPE) & (F.col("job_segment_status_cd") == codes.SEGMENT_SENDING))
    j = (s.join(t.job.select("job_id", "recruiter_company_id"), "job_id")
         .join(_crs_companies(t), F.col("recruiter_company_id") == F.col("_crs"), "left_semi"))
    return to_schema(j.select(F.col("ins_datetime").alias("act_date"), F.col("job_segment_id").alias("act_id"),
                              "recruiter_company_id", "job_id"), ACTION_SCHEMA, act_type=ACT["auto_scout"])


def login_days(t: Tables, p: Params) -> DataFrame:
    """One row per direct-hiring company and login day: the day's largest login id."""
    d = activity.company_login_days(t, p.local_bound(), CRS)
    return to_schema(d, ACTION_SCHEMA, act_type=ACT["login"])


def scout_mails(t: Tables, p: Params) -> DataFrame:
    """Scouts sent (UTC-month window), one row per attached job; the route
    column carries the raw scout class."""
    mt = scouts.scouts_sent(t, p.utc_bound(), company_type=CRS)
    d = mt.select(F.col("scout_sent_tm").alias("act_date"), F.col("message_thread_id").alias("act_id"),
                  "recruiter_company_id", F.col("attached_job_id").alias("job_id"),
                  F.col("scout_s_class").alias("route_info")).distinct()
    return to_schema(d, ACTION_SCHEMA, act_type=ACT["scout"])


def footprints(t: Tables, p: Params) -> DataFrame:
    """Footprints on direct-hiring jobs in the window; company from the footprint row."""
    f = t.since("footprint", "upd_datetime", p.local_bound())
    jobs = t.job.select(F.col("job_id").alias("_j_id"), F.col("recruiter_company_id").alias("_j_cid")).join(
        _crs_companies(t), F.col("_j_cid") == F.col("_crs"), "left_semi")
    # inner join: a job id repeated in ``job`` would repeat the footprint
    j = f.join(jobs, f.job_id == jobs._j_id)
    return to_schema(j.select(F.col("upd_datetime").alias("act_date"), F.col("footprint_key").alias("act_id"),
                              F.col("company_id").alias("recruiter_company_id"), "job_id"), ACTION_SCHEMA,
                     act_type=ACT["footprint"])


def interest_clicks(t: Tables, p: Params) -> DataFrame:
    """Distinct interest clicks on direct-hiring companies in the window."""
    c = activity.interest_clicks(t, p.local_bound()).join(
        _crs_companies(t), F.col("recruiter_company_id") == F.col("_crs"), "left_semi")
    d = c.select(F.col("conversion_tm").alias("act_date"), F.col("id").alias("act_id"), "recruiter_company_id",
                 "job_id").distinct()
    return to_schema(d, ACTION_SCHEMA, act_type=ACT["interest"])


def _progress_branch(df: DataFrame, date_col: str, label: str) -> DataFrame:
    return to_schema(df.select(F.col(date_col).alias("act_date"), F.col("candidate_progress_id").alias("act_id"),
                               "recruiter_company_id", "job_id", "route_info"), ACTION_SCHEMA, act_type=label)


def applied(cp: DataFrame, p: Params) -> DataFrame:
    """Applications inserted in the window."""
    return _progress_branch(cp.where(F.col("ins_datetime") >= exprs.ntz(p.local_bound())), "ins_datetime", ACT["apply"])


def status_branch(cp: DataFrame, t: Tables, p: Params, statuses, label: str) -> DataFrame:
    """Status changes (``statuses``, not deleted) in the window."""
    return _progress_branch(applications.status_events(cp, t, statuses, p.local_bound()), "status_tm", label)


def status_branches(cp: DataFrame, t: Tables, p: Params) -> DataFrame:
    """Screening passes (ITV__ only) and offers in the window, from one join with the status log."""
    e = applications.labelled_status_events(
        cp, t, {ACT["hs"]: codes.STATUS_HS_COMPANY, ACT["offer"]: (codes.STATUS_OFFER,)}, p.local_bound())
    return to_schema(e.select(F.col("status_tm").alias("act_date"), F.col("candidate_progress_id").alias("act_id"),
                              F.col("status_label").alias("act_type"), "recruiter_company_id", "job_id",
                              "route_info"), ACTION_SCHEMA)


def first_interviews(cp: DataFrame, p: Params) -> DataFrame:
    """First-interview dates (JSON epoch ms as a JST date) on or after the window start."""
    d = exprs.interview_set_date("candidate_progress_data_json", p.tz)
    c = cp.where(exprs.has_interview_set("candidate_progress_data_json")).withColumn("_iv", d).where(
        F.col("_iv") >= F.lit(p.local_bound().date()))
    return _progress_branch(c, "_iv", ACT["interview"])


def decisions(cp: DataFrame, t: Tables, p: Params) -> DataFrame:
    """Net decisions in the window with income; company and candidate must exist."""
    d = applications.net_decisions(cp, t, since=p.local_bound(), require_parents=True)
    return to_schema(d.select(F.col("cr_ins_datetime").alias("act_date"), F.col("cr_id").alias("act_id"),
                              "recruiter_company_id", "job_id", "route_info",
                              F.col("cr_income").alias("replace_income")), ACTION_SCHEMA, act_type=ACT["decision"])


def application_actions(cp: DataFrame, t: Tables, p: Params) -> DataFrame:
    """``applied``, ``status_branches``, ``first_interviews`` and ``decisions`` from one pass over the applications.

    As branches of their own each would build the applications, with
    company and route, anew.  An application is repeated for what it says
    itself (applied, interviewed) and once to meet its log: status changes
    and decisions, united before the join.
    """
    iv = exprs.interview_set_date("candidate_progress_data_json", p.tz)
    lo = p.local_bound()

    def own(cond, label, at):
        return F.when(cond, F.struct(F.lit(label).alias("act_type"), at.cast("timestamp_ntz").alias("act_date")))

    rows = F.array_compact(F.array(
        own(F.col("ins_datetime") >= exprs.ntz(lo), ACT["apply"], F.col("ins_datetime")),
        own(exprs.has_interview_set("candidate_progress_data_json") & (iv >= F.lit(lo.date())), ACT["interview"], iv),
        own(F.lit(True), MEETS_LOG, F.lit(None))))
    e = cp.select("candidate_progress_id", "candidate_id", "recruiter_company_id", "job_id", "route_info",
                  F.explode(rows).alias("_own"))
    log = applications.labelled_progress_log(
        t, {ACT["hs"]: codes.STATUS_HS_COMPANY, ACT["offer"]: (codes.STATUS_OFFER,)}, lo)
    log = log.select("_log_pid", F.col("status_label").alias("_type"), F.col("status_tm").alias("_tm"),
                     F.lit(None).cast("bigint").alias("_id"), F.lit(None).cast("bigint").alias("_income"))
    log = log.unionByName(applications.standing_decisions(t, since=lo).select(
        F.col("cr_pid").alias("_log_pid"), F.lit(ACT["decision"]).alias("_type"), F.col("cr_ins_datetime").alias("_tm"),
        F.col("cr_id").alias("_id"), F.col("cr_income").alias("_income")))
    meets = F.col("_own.act_type") == MEETS_LOG
    j = e.join(log, (e.candidate_progress_id == log._log_pid) & meets, "left").where(
        ~meets | F.col("_log_pid").isNotNull())
    # a decision's candidate must exist; its company does, by the join with companies that cp is made of
    ids = t.candidate.select(F.col("candidate_id").alias("_p_candidate")).distinct()
    decided = F.coalesce(F.col("_type") == ACT["decision"], F.lit(False))
    j = j.join(ids, j.candidate_id == ids._p_candidate, "left").where(~decided | F.col("_p_candidate").isNotNull())
    return to_schema(j.select(
        F.when(meets, F.col("_tm")).otherwise(F.col("_own.act_date")).alias("act_date"),
        F.when(decided, F.col("_id")).otherwise(F.col("candidate_progress_id")).alias("act_id"),
        F.when(meets, F.col("_type")).otherwise(F.col("_own.act_type")).alias("act_type"),
        "recruiter_company_id", "job_id", "route_info", F.col("_income").alias("replace_income")), ACTION_SCHEMA)


def company_actions(t: Tables, p: Params) -> DataFrame:
    """The unioned branches before the contract merge."""
    cp = crs_applications(t, p)
    return union_log([
        days_under_contract(t, p),
        first_publications(t, p),
        auto_scout_segments(t, p),
        login_days(t, p),
        scout_mails(t, p),
        footprints(t, p),
        interest_clicks(t, p),
        application_actions(cp, t, p),
    ])


def attach_contracts(actions: DataFrame, contracts: DataFrame, p: Params) -> DataFrame:
    """Left join each action to every contract with ``start <= act_date <= end``.

    A date end compared with a timestamp action means an action after
    00:00 on the contract's last day finds no contract — kept as defined.
    """
    con = contracts.select(F.col("b_company_id").alias("_con_cid"), *CONTRACT_COLUMNS)
    lo = min(p.utc_bound(), p.local_bound()).date()
    return interval_left_join(actions, con, "recruiter_company_id", "_con_cid", "act_date",
                              "b_contract_start_date", "b_contract_end_date", spread_by="b_contract_id", clip_lo=lo)


def company_action_log(t: Tables, p: Params) -> DataFrame:
    """The unioned company actions with every contract in force (see ``attach_contracts``)."""
    out = attach_contracts(company_actions(t, p), ranked_contracts(t, p), p)
    return out.select(*[f.name for f in ACTION_SCHEMA.fields], *CONTRACT_COLUMNS)
