"""M2 — candidate profile: static attributes plus five behaviour counters.

Counters (login ratio on days 2-7, same-day interest, applications,
screening passes, scouts received by company type) are aggregated per
candidate *before* meeting the candidate spine, so each is one partial
aggregate + one exchange on ``candidate_id``, and a hyperactive
candidate is reduced map-side instead of landing whole in one task.
Unmatched candidates get 0, as the source's left-join counts give.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recruitflow.functions import codes, exprs
from recruitflow.operators import scouts
from recruitflow.operators.joins import lookup
from recruitflow.params import Params
from recruitflow.sources.tables import Tables

RATIO_TYPE = "decimal(29,11)"
COUNTERS = ["c_login_2_7_ratio", "c_flw_1_cnt", "c_apl_cnt", "c_hs_cnt", "c_crs_ps_cnt", "c_ess_ps_cnt"]


def _reg(t: Tables) -> DataFrame:
    return t.candidate.select(F.col("candidate_id").alias("_reg_id"), F.to_date("ins_datetime").alias("_reg_day"))


def login_days_2_7(t: Tables) -> DataFrame:
    """Distinct login days 2..7 after registration, per candidate."""
    days = t.candidate_login_history.select(F.col("cid"), F.to_date("login_tm").alias("_day"))
    reg = _reg(t)
    # six days at most survive the join, so distinct days are counted after it
    j = days.join(reg, (days.cid == reg._reg_id) & (reg._reg_day < days._day)
                  & (days._day <= F.date_add(reg._reg_day, 6)))
    return j.groupBy(F.col("_reg_id").alias("candidate_id")).agg(F.countDistinct("_day").alias("login_days"))


def login_ratio(n: F.Column) -> F.Column:
    """Distinct login days 2..7 over 6, as an exact decimal.

    The definition casts the count to the dialect's bare ``dec``, which is
    DECIMAL(18,0); DECIMAL(18,0) / DECIMAL(10,0) is DECIMAL(29,11).  (A bare
    Spark ``decimal`` would be DECIMAL(10,0) and give scale 6.)
    """
    return (n.cast("decimal(18,0)") / F.lit(6).cast("decimal(10,0)")).cast(RATIO_TYPE)


def same_day_interest(t: Tables) -> DataFrame:
    """Interest clicks on the registration day, per candidate."""
    clicks = (t.recruiter_correspond_data.where(F.col("conversion_type_cd") == codes.CONVERSION_INTERESTED)
              .groupBy("candidate_id", F.to_date("conversion_tm").alias("_day"))
              .agg(F.count("conversion_tm").alias("_n")))
    reg = _reg(t)
    j = clicks.join(reg, (clicks.candidate_id == reg._reg_id) & (clicks._day == reg._reg_day))
    return j.groupBy("candidate_id").agg(F.sum("_n").alias("flw_1_cnt"))


def application_count(t: Tables) -> DataFrame:
    """All-time applications per candidate (platform company included)."""
    return t.candidate_progress.groupBy("candidate_id").agg(F.count("ins_datetime").alias("apl_cnt"))


def screening_count(t: Tables) -> DataFrame:
    """All-time screening passes (ITV__/MTADJ, not deleted) per candidate."""
    log = (t.candidate_progress_log.where(F.col("candidate_progress_status_cd").isin(*codes.STATUS_HS_CANDIDATE)
                                          & (F.col("del_flg") == codes.NOT_DELETED))
           .groupBy(F.col("candidate_progress_id").alias("_pid")).agg(F.count("ins_datetime").alias("_n")))
    cp = t.candidate_progress.select("candidate_progress_id", "candidate_id")
    return (cp.join(log, cp.candidate_progress_id == log._pid)
            .groupBy("candidate_id").agg(F.sum("_n").alias("hs_cnt")))


def scouts_received(t: Tables, p: Params) -> DataFrame:
    """Distinct scout threads received from direct (CRS) and agent (ESS)
    companies in the trailing window (UTC month)."""
    lo = p.utc_bound()
    ps = scouts.scouts_sent(t, lo, message_since=lo).select(
        "message_thread_id", "scout_sent_tm", "candidate_id", "company_type_cd").distinct()
    tid = F.col("message_thread_id")
    return ps.groupBy("candidate_id").agg(
        F.countDistinct(F.when(F.col("company_type_cd") == codes.COMPANY_DIRECT, tid)).alias("crs_ps_cnt"),
        F.countDistinct(F.when(F.col("company_type_cd") == codes.COMPANY_AGENT, tid)).alias("ess_ps_cnt"))


def first_display(df: DataFrame) -> DataFrame:
    """Only first-listed child rows (``display_no = '1'``)."""
    return df.where(F.col("display_no") == codes.FIRST_DISPLAY).drop("display_no")


def education_rows(t: Tables) -> DataFrame:
    """First-listed education rows, de-duplicated over all their attributes.

    Rows that differ in any attribute are all kept, so a resume can still
    have several (the profile then repeats per row, as in the source).
    """
    return first_display(t.resume_education_background).distinct()


def resume_profile(t: Tables) -> DataFrame:
    """Resumes with their code labels and first-listed children, keyed by
    ``resume_id`` throughout (the children joins are co-partitioned), then
    handed to the candidate spine on ``candidate_id``.

    Joining children to the resume first is the same as joining them after
    ``candidate ⟕ resume``: each child join is strict on resume columns.
    """
    r = t.resume.withColumnRenamed("candidate_id", "_r_cand")
    r = lookup(r, t.cls_education_bg.withColumnRenamed("code_alias", "_edu_alias"), "education_bg_cd", "education_bg_cd")
    r = lookup(r, t.cls_income.withColumnRenamed("code_alias", "_inc_alias"), "income_cd", "income_cd")
    reb = education_rows(t).select(F.col("resume_id").alias("_reb_rid"), F.col("school_master_id").alias("_school"))
    r = r.join(reb, r.resume_id == reb._reb_rid, "left")
    r = lookup(r, t.mst_school_info, "_school", "mst_school_info_id")
    rcomp = first_display(t.resume_company).withColumnRenamed("resume_id", "_rc_rid")
    r = r.join(rcomp, r.resume_id == rcomp._rc_rid, "left")
    rb = first_display(t.resume_business).withColumnRenamed("resume_id", "_rb_rid")
    r = r.join(rb, r.resume_id == rb._rb_rid, "left")
    r = lookup(r, t.mst_business_type, "resume_business_type_cd", "business_type_cd")
    rj = first_display(t.resume_job).withColumnRenamed("resume_id", "_rj_rid")
    r = r.join(rj, r.resume_id == rj._rj_rid, "left")
    r = lookup(r, t.mst_job_type, "resume_job_type_cd", "job_type_cd")
    return r.select(
        "_r_cand", "school_rank_cd", "job_group_type_cd", "job_type_name", "business_type_group_cd",
        "business_type_name", "_inc_alias", "_edu_alias", "job_change_duration_cd", "toeic_score", "toefl_score",
        "company_count", "company_business", "business_content", "appeal_point", "free_text")


def profile(t: Tables, p: Params) -> DataFrame:
    """Static candidate attributes (one row per candidate and resume row combination)."""
    c = t.candidate
    c = c.join(t.candidate_personal_info.withColumnRenamed("candidate_id", "_pi"),
               c.candidate_id == F.col("_pi"), "left")
    c = c.join(t.candidate_rating.withColumnRenamed("candidate_id", "_rt"), c.candidate_id == F.col("_rt"), "left")
    c = lookup(c, t.mst_area, "area_cd", "mst_area_cd")
    rp = resume_profile(t)
    c = c.join(rp, c.candidate_id == rp._r_cand, "left")
    return c.select(
        F.col("candidate_id").alias("c_candidate_id"),
        F.col("ins_datetime").alias("c_reg_datetime"),
        F.col("gender_cd").alias("c_gender_cd"),
        exprs.age("birth_date", p.today_utc()).alias("c_age"),
        F.col("school_rank_cd").alias("c_school_rank_cd"),
        F.col("candidate_rank_cd").alias("c_candidate_rank_cd"),
        exprs.job_group("job_group_type_cd").alias("c_recent_g_job"),
        F.col("job_type_name").alias("c_recent_job"),
        exprs.industry_group("business_type_group_cd", F.col("business_type_name")).alias("c_recent_g_industory"),
        F.col("business_type_name").alias("c_recent_industory"),
        F.col("_inc_alias").alias("c_recent_income"),
        F.col("_edu_alias").alias("c_education_bg"),
        F.col("job_change_duration_cd").alias("c_job_change_duration_cd"),
        exprs.text_length("company_business", "business_content", "appeal_point", "free_text")
        .alias("c_rsume_char_cnt"),
        F.col("candidate_status_cd").alias("c_status_cd"),
        exprs.channel("tracking_code").alias("c_trcd"),
        F.col("area_name").alias("c_area"),
        F.col("toeic_score").alias("c_toeic"),
        F.col("toefl_score").alias("c_toefl"),
        F.col("company_count").alias("c_com_exp_cnt"))


def behaviour(t: Tables, p: Params) -> DataFrame:
    """The five counters for every candidate (0 when nothing matched)."""
    spine = t.candidate.select("candidate_id")
    out = spine
    for agg in (login_days_2_7(t), same_day_interest(t), application_count(t), screening_count(t),
                scouts_received(t, p)):
        out = out.join(agg, "candidate_id", "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    return out.select(
        F.col("candidate_id").alias("_b_id"),
        login_ratio(z("login_days")).alias("c_login_2_7_ratio"),
        z("flw_1_cnt").alias("c_flw_1_cnt"), z("apl_cnt").alias("c_apl_cnt"), z("hs_cnt").alias("c_hs_cnt"),
        z("crs_ps_cnt").alias("c_crs_ps_cnt"), z("ess_ps_cnt").alias("c_ess_ps_cnt"))


def candidate_basic_info(t: Tables, p: Params) -> DataFrame:
    """Profile rows with the five behaviour counters."""
    prof = profile(t, p)
    b = behaviour(t, p)
    return prof.join(b, prof.c_candidate_id == b._b_id, "left").drop("_b_id")
