"""Oracle SQL of the operator-level queries (see plans.operator_queries)."""

from oracle.mart_sql import sql_for

SQL: dict[str, str] = {
    "route_info": sql_for("m1_cp", "SELECT * EXCLUDE (js) FROM m1_cp"),
    "clean_contracts": sql_for("clean_contract", "SELECT * EXCLUDE (entered, recency) FROM clean_contract"),
    "ranked_contracts": sql_for("ranked_contract"),
    "contract_days": sql_for("m4_contract_days"),
    "registrations": sql_for("m1_reg"),
    "login_days": sql_for("m1_login"),
    "interest_days": sql_for("m1_flw"),
    "scout_sent": sql_for("m1_ps"),
    "status_events": sql_for("m1", "FROM m1_hs UNION ALL FROM m1_offer"),
    "net_decisions": sql_for("m1_dec"),
    "leavers": sql_for("m1_left"),
    "first_publish": sql_for("m4_pub"),
    "auto_scout": sql_for("m4_seg"),
    "company_login": sql_for("m4_login"),
    "company_scouts": sql_for("m4_ps"),
    "footprints": sql_for("m4_foot"),
    "company_interest": sql_for("m4_flw"),
    "interview_date": sql_for("m4_iv"),
    "company_actions": sql_for("m4_all"),
    "all_publish": sql_for("m5_pub"),
    "scout_replies": sql_for("m5_rep"),
    "sales_score": sql_for("m5_sales"),
    "login_2_7_ratio": sql_for("m2_login", "SELECT candidate_id, CAST(CAST(n AS DECIMAL(18,0)) / 6 AS DECIMAL(29,11)) "
                                           "AS c_login_2_7_ratio FROM m2_login"),
    "same_day_interest": sql_for("m2_flw", "SELECT candidate_id, n AS c_flw_1_cnt FROM m2_flw"),
    "apply_count": sql_for("m2_progress", "SELECT candidate_id, applied AS c_apl_cnt FROM m2_progress"),
    "hs_count": sql_for("m2_progress", "SELECT candidate_id, screened AS c_hs_cnt FROM m2_progress"),
    "scout_counts": sql_for("m2_ps", "SELECT candidate_id, crs AS c_crs_ps_cnt, ess AS c_ess_ps_cnt FROM m2_ps"),
    "candidate_profile": sql_for("m2", "SELECT * EXCLUDE (c_login_2_7_ratio, c_flw_1_cnt, c_apl_cnt, c_hs_cnt, "
                                       "c_crs_ps_cnt, c_ess_ps_cnt) FROM m2"),
    "resume_education": sql_for("resume_education_background", """
        SELECT DISTINCT resume_id, education_bg_cd, education_name, graduation_year, course_type_cd,
               school_master_id, drop_flg, expected_flg
        FROM resume_education_background WHERE display_no = '1'"""),
    "company_funnel": sql_for("m4", """
        SELECT date_trunc('month', CAST(act_date AS DATE))::DATE AS act_month, act_type,
               count(DISTINCT act_id) AS n_actions
        FROM m4 GROUP BY 1, 2"""),
    "candidate_funnel": sql_for("m1", """
        SELECT date_trunc('month', CAST(act_date AS DATE))::DATE AS act_month, act_type,
               count(DISTINCT candidate_id) AS n_actions
        FROM m1 GROUP BY 1, 2"""),
    "scout_funnel": sql_for("m1_ps", """
        SELECT date_trunc('month', CAST(act_date AS DATE))::DATE AS act_month, route_info,
               count(DISTINCT message_thread_id) AS n_actions
        FROM m1_ps GROUP BY 1, 2"""),
    "company_applied": sql_for("m4_apl"),
    "company_hs": sql_for("m4_hs"),
    "company_offers": sql_for("m4_offer"),
    "company_decisions": sql_for("m4_dec"),
    "fixed_logins": sql_for("m5_login"),
    "fixed_interest": sql_for("m5_flw"),
    "fixed_scouts": sql_for("m5_ps"),
    "fixed_interviews": sql_for("m5_iv"),
    "fixed_decisions": sql_for("m5_dec"),
    "company_dims": sql_for("company", "SELECT * RENAME (industry AS business_group_name) FROM company"),
    "repeated_candidates": sql_for("m2", """
        SELECT c_candidate_id, count(*) AS n_rows FROM m2 GROUP BY c_candidate_id HAVING count(*) > 1"""),
    "contract_overlaps": sql_for("m4", """
        SELECT act_type, act_id, act_date, recruiter_company_id, job_id, count(DISTINCT b_contract_id) AS n_contracts
        FROM m4 WHERE b_contract_id IS NOT NULL
        GROUP BY act_type, act_id, act_date, recruiter_company_id, job_id
        HAVING count(DISTINCT b_contract_id) > 1"""),
}
