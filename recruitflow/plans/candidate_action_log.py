"""M1 — candidate action log: one row per candidate action, trailing window.

Nine branches (registration, login days, interest clicks, scouts sent,
applications, document-screening passes, offers, net decisions, leaving)
share one declared schema and are glued by UNION ALL.  Applications with
their route are computed once and reused by four branches.
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
    T.StructField("candidate_id", T.LongType()),
    T.StructField("act_date", T.TimestampNTZType()),
    T.StructField("act_type", T.StringType()),
    T.StructField("route_info", T.StringType()),
    T.StructField("job_id", T.LongType()),
    T.StructField("recruiter_company_id", T.LongType()),
    T.StructField("message_thread_id", T.LongType()),
    T.StructField("ps_reply_date", T.DateType()),
])
ACT = codes.M1_ACT


def routed_applications(t: Tables, p: Params) -> DataFrame:
    """Applications (platform excluded) with route; scout lookup windowed."""
    return applications.applications_with_route(t, p.owner_company_id, p.local_bound(), numbered=True)


def registrations(t: Tables, p: Params) -> DataFrame:
    """Sign-ups in the window with their acquisition channel as route."""
    c = t.candidate.where(F.col("ins_datetime") >= exprs.ntz(p.local_bound()))
    cpi = t.candidate_personal_info.select(F.col("candidate_id").alias("_pi_id"), "tracking_code")
    j = c.join(cpi, c.candidate_id == cpi._pi_id, "left")
    return to_schema(j.select("candidate_id", F.col("ins_datetime").alias("act_date"),
                              exprs.channel("tracking_code").alias("route_info")), SCHEMA, act_type=ACT["register"])


def login_days(t: Tables, p: Params) -> DataFrame:
    """Login days after the sign-up day, leaving day excluded, in the window."""
    return to_schema(activity.candidate_login_days(t, p.local_bound()), SCHEMA, act_type=ACT["login"])


def interest_days(t: Tables, p: Params) -> DataFrame:
    """Distinct (day, candidate, job, company) interest clicks in the window (platform excluded)."""
    clicks = activity.interest_clicks(t, p.local_bound()).where(F.col("recruiter_company_id") != p.owner_company_id)
    d = clicks.select(F.to_date("conversion_tm").alias("act_date"), "candidate_id", "job_id",
                      "recruiter_company_id").distinct()
    return to_schema(d, SCHEMA, act_type=ACT["interest"])


def scout_mails(t: Tables, p: Params) -> DataFrame:
    """Scouts sent, one row per attached job, with the first reply date of
    opened threads."""
    lo = p.local_bound()
    mt = scouts.scouts_sent(t, lo, owner_id=p.owner_company_id, message_since=lo)
    rep = scouts.opened_scouts_with_reply(t, lo).select(F.col("message_thread_id").alias("_r_tid"), "reply_tm")
    j = mt.join(rep, mt.message_thread_id == rep._r_tid, "left")
    d = j.select(F.to_date("scout_sent_tm").alias("act_date"), "message_thread_id", "candidate_id",
                 exprs.scout_label("scout_s_class").alias("route_info"), F.col("attached_job_id").alias("job_id"),
                 "recruiter_company_id", "reply_tm").distinct()
    return to_schema(d.withColumn("ps_reply_date", F.to_date("reply_tm")), SCHEMA, act_type=ACT["scout"])


def applied(cp: DataFrame, p: Params) -> DataFrame:
    """Applications inserted in the window, with route."""
    a = cp.where(F.col("ins_datetime") >= exprs.ntz(p.local_bound()))
    return to_schema(a.withColumnRenamed("ins_datetime", "act_date"), SCHEMA, act_type=ACT["apply"])


def status_branch(cp: DataFrame, t: Tables, p: Params, statuses, label: str) -> DataFrame:
    """Status changes (``statuses``, not deleted) in the window, with the application's route."""
    e = applications.status_events(cp, t, statuses, p.local_bound())
    return to_schema(e.drop("ins_datetime").withColumnRenamed("status_tm", "act_date"), SCHEMA, act_type=label)


def status_branches(cp: DataFrame, t: Tables, p: Params) -> DataFrame:
    """Screening passes and offers in the window, from one join with the status log."""
    e = applications.labelled_status_events(
        cp, t, {ACT["hs"]: codes.STATUS_HS_CANDIDATE, ACT["offer"]: (codes.STATUS_OFFER,)}, p.local_bound())
    return to_schema(e.drop("ins_datetime").withColumnRenamed("status_tm", "act_date")
                     .withColumnRenamed("status_label", "act_type"), SCHEMA)


def decisions(cp: DataFrame, t: Tables, p: Params) -> DataFrame:
    """Net decisions in the window: cancelled hires removed; candidate from the decision row."""
    d = applications.net_decisions(cp, t, since=p.local_bound())
    d = d.select(F.col("cr_candidate_id").alias("candidate_id"), F.col("cr_ins_datetime").alias("act_date"),
                 "route_info", "job_id", "recruiter_company_id")
    return to_schema(d, SCHEMA, act_type=ACT["decision"])


def leavers(t: Tables, p: Params) -> DataFrame:
    """Candidates who left, dated by their last update, in the window."""
    c = t.candidate.where((F.col("candidate_status_cd") == codes.CANDIDATE_LEFT)
                          & (F.col("upd_datetime") >= exprs.ntz(p.local_bound())))
    return to_schema(c.select("candidate_id", F.col("upd_datetime").alias("act_date")), SCHEMA, act_type=ACT["left"])


def candidate_action_log(t: Tables, p: Params) -> DataFrame:
    """The nine branches of the candidate log, unioned to ``SCHEMA``."""
    cp = routed_applications(t, p)
    return union_log([
        registrations(t, p),
        login_days(t, p),
        interest_days(t, p),
        scout_mails(t, p),
        applied(cp, p),
        status_branches(cp, t, p),
        decisions(cp, t, p),
        leavers(t, p),
    ])
