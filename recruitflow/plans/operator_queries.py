"""Operator-level queries on the stand-in tables, one per inventory item.

Each exposes one building block of the marts on its own, so it can be
checked against the oracle separately:

  route_info            applications with route label (scout lookup join)
  clean_contracts       main contracts, duplicate starts removed
  ranked_contracts      + duplicate ends removed, recency rank kept
  contract_days         calendar days under contract (range join as explode)
  registrations         sign-ups with acquisition channel
  login_days            login days, anti join on the leaving day
  interest_days         interest clicks per day
  scout_sent            scouts sent with first reply date
  status_events         screening passes and offers
  net_decisions         decisions minus cancelled hires (anti join)
  leavers               candidates who left
  first_publish         first publication per job (min per key)
  auto_scout            auto-scout segments
  company_login         one login per company-day (max id)
  company_scouts        scouts sent, company view, UTC window
  footprints            footprints on direct-hiring jobs
  company_interest      interest clicks, company view
  interview_date        first-interview date from JSON epoch ms
  company_actions       the 12 company branches before the contract merge
  all_publish           every publication change
  scout_replies         first replies with send-date cohort
  sales_score           approved sales with score and predecessor
  login_2_7_ratio       distinct login days 2-7 after sign-up / 6
  same_day_interest     interest clicks on the sign-up day
  apply_count           applications per candidate
  hs_count              screening passes per candidate
  scout_counts          scouts received by company type
  candidate_profile     static candidate attributes
  resume_education      de-duplicated first education rows
  company_funnel        distinct actions per month and type (company log)
  candidate_funnel      distinct candidates per month and type (candidate log)
  scout_funnel          scout mails per month and route as distinct threads (one row per attached job)
  company_applied / company_hs / company_offers / company_decisions
                        company-log application branches (C-7, C-8, C-10, C-11)
  fixed_logins / fixed_interest / fixed_scouts / fixed_interviews / fixed_decisions
                        fixed-start log branches (D-1, D-2, D-3, D-7, D-9)
  company_dims          companies with area and industry group (no fallback)
  repeated_candidates   quality: candidates fanned out by resume children
  contract_overlaps     quality: actions meeting more than one contract
"""

from __future__ import annotations

from pyspark.sql import functions as F

from recruitflow.functions import codes
from recruitflow.operators.counts import funnel_counts
from recruitflow.plans import candidate_action_log as m1
from recruitflow.plans import candidate_basic_info as m2
from recruitflow.plans import company_action_log as m4
from recruitflow.plans import company_action_log_fixed as m5
from recruitflow.operators.contracts import company_dims
from recruitflow.plans import quality
from recruitflow.plans.company_info import clean_contracts
from recruitflow.plans.standin_queries import STANDIN_PARAMS as P
from recruitflow.sources.standins import standin_tables


def _q(fn):
    def run(spark, sf_dir):
        return fn(standin_tables(spark, sf_dir))
    run.__doc__ = fn.__doc__
    return run


def _counter(t, agg, col, out, ratio=False):
    spine = t.candidate.select("candidate_id")
    v = F.coalesce(F.col(col), F.lit(0)).cast("bigint")
    return spine.join(agg, "candidate_id", "left").select("candidate_id", (m2.login_ratio(v) if ratio else v).alias(out))


QUERIES = {
    "route_info": _q(lambda t: m1.routed_applications(t, P)),
    "clean_contracts": _q(lambda t: clean_contracts(t, P).drop("ins_datetime")),
    "ranked_contracts": _q(lambda t: m4.ranked_contracts(t, P).drop("ins_datetime")),
    "contract_days": _q(lambda t: m4.days_under_contract(t, P)),
    "registrations": _q(lambda t: m1.registrations(t, P)),
    "login_days": _q(lambda t: m1.login_days(t, P)),
    "interest_days": _q(lambda t: m1.interest_days(t, P)),
    "scout_sent": _q(lambda t: m1.scout_mails(t, P)),
    "status_events": _q(lambda t: (lambda cp: m1.status_branch(cp, t, P, codes.STATUS_HS_CANDIDATE, m1.ACT["hs"])
                                   .unionByName(m1.status_branch(cp, t, P, codes.STATUS_OFFER, m1.ACT["offer"])))(
        m1.routed_applications(t, P))),
    "net_decisions": _q(lambda t: m1.decisions(m1.routed_applications(t, P), t, P)),
    "leavers": _q(lambda t: m1.leavers(t, P)),
    "first_publish": _q(lambda t: m4.first_publications(t, P)),
    "auto_scout": _q(lambda t: m4.auto_scout_segments(t, P)),
    "company_login": _q(lambda t: m4.login_days(t, P)),
    "company_scouts": _q(lambda t: m4.scout_mails(t, P)),
    "footprints": _q(lambda t: m4.footprints(t, P)),
    "company_interest": _q(lambda t: m4.interest_clicks(t, P)),
    "interview_date": _q(lambda t: m4.first_interviews(m4.crs_applications(t, P), P)),
    "company_actions": _q(lambda t: m4.company_actions(t, P)),
    "all_publish": _q(lambda t: m5.publications(t, P)),
    "scout_replies": _q(lambda t: m5.scout_replies(t, P)),
    "sales_score": _q(lambda t: m5.approved_sales(m5.applications_since(t, P), t, P)),
    "login_2_7_ratio": _q(lambda t: _counter(t, m2.login_days_2_7(t), "login_days", "c_login_2_7_ratio", ratio=True)),
    "same_day_interest": _q(lambda t: _counter(t, m2.same_day_interest(t), "flw_1_cnt", "c_flw_1_cnt")),
    "apply_count": _q(lambda t: _counter(t, m2.application_count(t), "apl_cnt", "c_apl_cnt")),
    "hs_count": _q(lambda t: _counter(t, m2.screening_count(t), "hs_cnt", "c_hs_cnt")),
    "scout_counts": _q(lambda t: t.candidate.select("candidate_id").join(m2.scouts_received(t, P), "candidate_id", "left")
                       .select("candidate_id",
                               F.coalesce("crs_ps_cnt", F.lit(0)).cast("bigint").alias("c_crs_ps_cnt"),
                               F.coalesce("ess_ps_cnt", F.lit(0)).cast("bigint").alias("c_ess_ps_cnt"))),
    "candidate_profile": _q(lambda t: m2.profile(t, P)),
    "resume_education": _q(lambda t: m2.education_rows(t)),
    # the contract merge is a left join that only repeats action rows, so distinct actions per
    # (month, type) are the same before it: the funnel skips the as-of join
    "company_funnel": _q(lambda t: funnel_counts(m4.company_actions(t, P), ["act_type"], "act_id")),
    "candidate_funnel": _q(lambda t: funnel_counts(m1.candidate_action_log(t, P), ["act_type"], "candidate_id")),
    "scout_funnel": _q(lambda t: funnel_counts(m1.scout_mails(t, P), ["route_info"], "message_thread_id")),
    "company_applied": _q(lambda t: m4.applied(m4.crs_applications(t, P), P)),
    "company_hs": _q(lambda t: m4.status_branch(m4.crs_applications(t, P), t, P, codes.STATUS_HS_COMPANY,
                                                m4.ACT["hs"])),
    "company_offers": _q(lambda t: m4.status_branch(m4.crs_applications(t, P), t, P, codes.STATUS_OFFER,
                                                    m4.ACT["offer"])),
    "company_decisions": _q(lambda t: m4.decisions(m4.crs_applications(t, P), t, P)),
    "fixed_logins": _q(lambda t: m5.login_days(t, P)),
    "fixed_interest": _q(lambda t: m5.interest_clicks(t, P)),
    "fixed_scouts": _q(lambda t: m5.scout_mails(t, P)),
    "fixed_interviews": _q(lambda t: m5.interviews(m5.applications_since(t, P), P)),
    "fixed_decisions": _q(lambda t: m5.decisions(m5.applications_since(t, P), t, P)),
    "company_dims": _q(lambda t: company_dims(t, group_fallback_to_name=False)),
    "repeated_candidates": _q(lambda t: quality.repeated_candidates(m2.candidate_basic_info(t, P))),
    "contract_overlaps": _q(lambda t: quality.overlapping_contract_actions(m4.company_action_log(t, P))),
}
