"""M5 — company-side actions since a fixed start, with cohort date and sales score.

Eleven branches; ``date_for_join`` is the cohort date: scout replies take
the *send* date, application-and-later rows take the *apply* date.
Application-based branches are not restricted to direct-hiring companies
(only the scout lookup is), as in the source definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recruitflow.functions import codes, exprs
from recruitflow.operators import activity, applications, scouts
from recruitflow.operators.logs import to_schema, union_log
from recruitflow.params import Params
from recruitflow.sources.tables import Tables

SCHEMA = T.StructType([
    T.StructField("act_date", T.DateType()),
    T.StructField("act_type", T.StringType()),
    T.StructField("candidate_id", T.LongType()),
    T.StructField("recruiter_company_id", T.LongType()),
    T.StructField("job_id", T.LongType()),
    T.StructField("route_info", T.StringType()),
    T.StructField("date_for_join", T.DateType()),
    T.StructField("flw_done_flg", T.StringType()),
    T.StructField("flw_ps_snt_flg", T.StringType()),
    T.StructField("message_thread_id", T.LongType()),
    T.StructField("replace_income", T.LongType()),
    T.StructField("sf_kt_cnt", T.LongType()),
])
ACT = codes.M5_ACT
CRS = codes.COMPANY_DIRECT


def applications_since(t: Tables, p: Params) -> DataFrame:
    """Applications since the fixed start (platform excluded, all company types), route looked up
    among direct-hiring scouts since the same start; labels without the number prefix.
    """
    return applications.applications_with_route(t, p.owner_company_id, p.since, numbered=False,
                                                company_type=None, join_company=True, applied_since=p.since,
                                                thread_company_type=CRS, with_json=True)


def _crs(t: Tables, owner_id: int) -> DataFrame:
    """Direct-hiring company ids except the platform."""
    return (t.recruiter_company.where((F.col("company_type_cd") == CRS) & (F.col("recruiter_company_id") != owner_id))
            .select(F.col("recruiter_company_id").alias("_crs")))


def publications(t: Tables, p: Params) -> DataFrame:
    """Every publication status change (not only the first)."""
    log = t.job_status_change_log.where((F.col("job_status_cd") == codes.JOB_PUBLISHED)
                                        & (F.col("ins_datetime") >= exprs.ntz_day(p.since)))
    j = (log.join(t.job_admin_info, "job_admin_info_id").join(t.job.select("job_id", "recruiter_company_id"), "job_id")
         .join(_crs(t, p.owner_company_id), F.col("recruiter_company_id") == F.col("_crs"), "left_semi"))
    d = F.to_date("ins_datetime")
    return to_schema(j.select(d.alias("act_date"), "recruiter_company_id", "job_id", d.alias("date_for_join")),
                     SCHEMA, act_type=ACT["publish"])


def login_days(t: Tables, p: Params) -> DataFrame:
    """One row per direct-hiring company and login day since the start (platform excluded)."""
    d = activity.company_login_days(t, p.since, CRS, owner_id=p.owner_company_id)
    return to_schema(d.select("act_date", "recruiter_company_id", F.col("act_date").alias("date_for_join")),
                     SCHEMA, act_type=ACT["login"])


def interest_clicks(t: Tables, p: Params) -> DataFrame:
    """Distinct interest clicks per day with the done / scout flags (direct-hiring companies)."""
    c = activity.interest_clicks(t, p.since).where(F.col("recruiter_company_id") != p.owner_company_id).join(
        _crs(t, p.owner_company_id), F.col("recruiter_company_id") == F.col("_crs"), "left_semi")
    d = F.to_date("conversion_tm")
    out = c.select(d.alias("act_date"), "candidate_id", "recruiter_company_id", "job_id",
                   d.alias("date_for_join"), F.col("recruiter_done_flg").alias("flw_done_flg"),
                   F.col("recruiter_scout_flg").alias("flw_ps_snt_flg")).distinct()
    return to_schema(out, SCHEMA, act_type=ACT["interest"])


def scout_mails(t: Tables, p: Params) -> DataFrame:
    """Scouts sent since the start, one row per attached job, cohort = send day."""
    mt = scouts.scouts_sent(t, p.since, company_type=CRS, owner_id=p.owner_company_id, message_since=p.since)
    d = F.to_date("scout_sent_tm")
    out = mt.select(d.alias("act_date"), "candidate_id", "recruiter_company_id",
                    F.col("attached_job_id").alias("job_id"),
                    exprs.scout_label("scout_s_class", numbered=False).alias("route_info"),
                    d.alias("date_for_join"), "message_thread_id").distinct()
    return to_schema(out, SCHEMA, act_type=ACT["scout"])


def scout_replies(t: Tables, p: Params) -> DataFrame:
    """First reply of opened scouts; act_date = reply day, cohort = send day."""
    mt = t.message_thread.where((F.col("create_trigger_type_cd") == codes.THREAD_SCOUT)
                                & F.col("cn_scout_first_view_tm").isNotNull()
                                & (F.col("company_type_cd") == CRS)
                                & (F.col("scout_sent_tm") >= exprs.ntz_day(p.since))
                                & (F.col("recruiter_company_id") != p.owner_company_id))
    rep = scouts.first_replies(t, p.since)
    j = mt.join(rep, mt.message_thread_id == rep._rep_tid)
    out = j.select(F.to_date("reply_tm").alias("act_date"), "candidate_id", "recruiter_company_id",
                   F.col("attached_job_id").alias("job_id"),
                   exprs.scout_label("scout_s_class", numbered=False).alias("route_info"),
                   F.to_date("scout_sent_tm").alias("date_for_join"), "message_thread_id").distinct()
    return to_schema(out, SCHEMA, act_type=ACT["reply"])


def _cohort(df: DataFrame, act_date, label: str, **extra) -> DataFrame:
    """Project an application-based branch: cohort date = apply date.  ``label``
    is the constant act type, unless ``act_type`` is given among ``extra``."""
    cols = [act_date.alias("act_date"), "candidate_id", "recruiter_company_id", "job_id", "route_info",
            F.col("apply_date").alias("date_for_join")] + [c.alias(n) for n, c in extra.items()]
    return to_schema(df.select(*cols), SCHEMA, **({} if "act_type" in extra else {"act_type": label}))


def decisions(cp: DataFrame, t: Tables, p: Params) -> DataFrame:
    """Net decisions (cancelled hires removed) by request day, with income; cohort = apply day."""
    d = applications.net_decisions(cp, t, require_parents=True)
    return _cohort(d, F.to_date("cr_ins_datetime"), ACT["decision"], replace_income=F.col("cr_income"))


def approved_sales(cp: DataFrame, t: Tables, p: Params) -> DataFrame:
    """Approved sales rows (plan-change remarks excluded) with their score.

    The previous record of a correction chain comes from a self join on
    ``previous_id``.
    """
    kt = t.hassei_sales.where(~F.col("sales_remarks").rlike(codes.PLAN_CHANGE_REMARKS)
                              & (F.col("hassei_date") >= F.lit(p.since)))
    prev = t.hassei_sales.select(F.col("hassei_sales_id").alias("_prev_id"),
                                 F.col("sales_product_type_cd").alias("_prev_kind"))
    cr = t.candidate_replace.select(F.col("candidate_replace_id").alias("_cr_id"),
                                    F.col("candidate_progress_id").alias("_cr_pid"),
                                    F.col("candidate_id").alias("_cr_candidate"), F.col("job_id").alias("_cr_job"))
    j = (kt.join(cr, kt.sales_product_id == cr._cr_id)
         .join(prev, kt.previous_id == prev._prev_id, "left")
         .join(cp.select("candidate_progress_id", "recruiter_company_id", "route_info", "apply_date"),
               F.col("_cr_pid") == F.col("candidate_progress_id")))
    score = exprs.sales_score(F.col("sales_price"), F.col("sales_product_type_cd"), F.col("_prev_kind"),
                              F.col("previous_id"))
    out = j.select(F.col("hassei_date").alias("act_date"), F.col("_cr_candidate").alias("candidate_id"),
                   "recruiter_company_id", F.col("_cr_job").alias("job_id"), "route_info",
                   F.col("apply_date").alias("date_for_join"), F.col("sales_price").alias("replace_income"),
                   score.alias("sf_kt_cnt"))
    return to_schema(out, SCHEMA, act_type=ACT["sales"])


def applied(cp: DataFrame) -> DataFrame:
    """Applications by their apply date (cohort = the same date)."""
    return _cohort(cp, F.col("apply_date"), ACT["apply"])


def status_branch(cp: DataFrame, t: Tables, statuses, label: str) -> DataFrame:
    """Status changes (``statuses``, not deleted) by change day; cohort = apply day."""
    return _cohort(applications.status_events(cp, t, statuses), F.to_date("status_tm"), label)


def status_branches(cp: DataFrame, t: Tables) -> DataFrame:
    """Screening passes (ITV__ only) and offers by change day, from one join with the status log."""
    e = applications.labelled_status_events(
        cp, t, {ACT["hs"]: codes.STATUS_HS_COMPANY, ACT["offer"]: (codes.STATUS_OFFER,)})
    return _cohort(e, F.to_date("status_tm"), "", act_type=F.col("status_label"))


def interviews(cp: DataFrame, p: Params) -> DataFrame:
    """First-interview date from the JSON; no window beyond the cohort's."""
    iv = exprs.interview_set_date("candidate_progress_data_json", p.tz)
    return _cohort(cp.where(exprs.has_interview_set("candidate_progress_data_json")), iv, ACT["interview"])


def company_action_log_fixed(t: Tables, p: Params) -> DataFrame:
    """The eleven branches of the fixed-start company log, unioned to ``SCHEMA``."""
    cp = applications_since(t, p)
    return union_log([
        publications(t, p),
        login_days(t, p),
        interest_clicks(t, p),
        scout_mails(t, p),
        scout_replies(t, p),
        applied(cp),
        status_branches(cp, t),
        interviews(cp, p),
        decisions(cp, t, p),
        approved_sales(cp, t, p),
    ])
