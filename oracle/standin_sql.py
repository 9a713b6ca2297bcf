"""DuckDB SQL deriving the 35 stand-in recruiting tables from the test views.

Mirrors ``recruitflow.sources.standins`` (the Spark side); both must
produce the same rows.  Each entry is ``name -> (deps, SELECT ...)``; the
helper ``with_clause`` emits the CTEs a query needs, in dependency order.
"""

from __future__ import annotations

EV = """SELECT *, ts - INTERVAL 23 YEAR AS ts2,
          CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"""

PR = "substr(o_orderpriority, 1, 1)"

STANDIN: dict[str, tuple[tuple[str, ...], str]] = {
    "ev2": ((), EV),
    "recruiter_company": ((), """
        SELECT c_custkey AS recruiter_company_id, c_name AS company_name,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 'ESS' ELSE 'CRS' END AS company_type_cd,
               CAST(c_nationkey AS VARCHAR) AS area_cd, c_mktsegment AS business_type_cd
        FROM customer"""),
    "mst_area": ((), "SELECT CAST(n_nationkey AS VARCHAR) AS mst_area_cd, n_name AS area_name FROM nation"),
    "mst_business_type": ((), """
        SELECT code AS business_type_cd,
               CASE code WHEN 'AUTOMOBILE' THEN 'IA' WHEN 'FURNITURE' THEN 'IB' WHEN 'MACHINERY' THEN 'IC'
                         WHEN 'HOUSEHOLD' THEN 'ID' WHEN 'ECONOMY' THEN 'IE' WHEN 'BUILDING' THEN 'IF'
                         WHEN 'SMALL' THEN 'IG' WHEN 'MEDIUM' THEN 'IH' WHEN 'LARGE' THEN 'IZ' END
                 AS business_type_group_cd,
               lower(code) AS business_type_name
        FROM (SELECT DISTINCT c_mktsegment AS code FROM customer
              UNION ALL SELECT DISTINCT p_type FROM part WHERE p_type <> 'STANDARD')"""),
    "mst_job_type": ((), """
        SELECT noun AS job_type_cd,
               CASE noun WHEN 'gear' THEN 'JA' WHEN 'gizmo' THEN 'JB' WHEN 'widget' THEN 'JC'
                         WHEN 'plate' THEN 'JD' WHEN 'rod' THEN 'JE' WHEN 'anvil' THEN 'JL' ELSE 'JZ' END
                 AS job_group_type_cd,
               'job ' || noun AS job_type_name
        FROM (SELECT DISTINCT split_part(p_name, ' ', 2) AS noun FROM part) WHERE noun <> 'bolt'"""),
    "job": ((), """
        SELECT p_partkey AS job_id, CAST(p_partkey // 2 + 1 AS BIGINT) AS recruiter_company_id, p_name AS job_name,
               CAST(DATE '2000-01-01' + p_size * 7 AS TIMESTAMP) AS publish_start_tm,
               p_brand AS job_publish_type_cd, split_part(p_name, ' ', 2) AS job_type_cd,
               split_part(p_name, ' ', 1) AS employment_type_cd,
               CAST(p_size AS BIGINT) * 100000 AS income_lower,
               CASE WHEN p_type = 'PROMO' THEN NULL
                    ELSE CAST(p_size AS BIGINT) * 100000 + CAST(floor(p_retailprice) AS BIGINT) * 1000 END
                 AS income_upper,
               CAST(p_size AS VARCHAR) AS main_area_cd
        FROM part"""),
    "job_business_type": ((), """
        SELECT p_partkey AS job_id, 1 AS display_no, p_type AS business_type_cd FROM part
        UNION ALL
        SELECT p_partkey, 2, 'AUTOMOBILE' FROM part WHERE p_type = 'LARGE'"""),
    "job_company": ((), "SELECT p_partkey AS job_id, p_brand AS company_name FROM part WHERE p_type = 'PROMO'"),
    "job_admin_info": ((), "SELECT p_partkey * 10 AS job_admin_info_id, p_partkey AS job_id FROM part"),
    "job_status_change_log": ((), """
        SELECT l_partkey * 10 AS job_admin_info_id,
               CASE WHEN l_linestatus = 'O' AND l_shipdate >= TIMESTAMP '2000-06-01 00:00:00' THEN 'PUB'
                    ELSE 'CLS' END AS job_status_cd,
               l_shipdate + to_hours(l_linenumber) AS ins_datetime
        FROM lineitem"""),
    "job_segment_info": ((), """
        SELECT l_orderkey * 10 + l_linenumber AS job_segment_id, l_partkey AS job_id,
               CASE WHEN l_returnflag = 'N' THEN 'S' ELSE 'M' END AS scout_type_cd,
               CASE WHEN l_linestatus = 'F' THEN 'SND' ELSE 'STP' END AS job_segment_status_cd,
               l_shipdate + to_hours(l_linenumber) AS ins_datetime
        FROM lineitem"""),
    "order_job": ((), """
        SELECT l_orderkey, min(l_partkey) AS job_id, CAST(min(p_partkey // 2 + 1) AS BIGINT) AS company_id
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey"""),
    "cp_src": (("order_job",), f"""
        SELECT o_orderkey AS candidate_progress_id, o_custkey AS candidate_id,
               company_id AS recruiter_company_id, job_id,
               o_orderdate + to_hours(o_orderkey % 24) AS ins_datetime,
               CAST(o_orderdate AS DATE) - CAST(o_orderkey % 3 AS INTEGER) AS apply_date,
               CASE WHEN {PR} = '1' THEN 'SPE'
                    WHEN {PR} = '2' THEN CASE WHEN o_orderstatus = 'F' THEN 'SCT' ELSE 'HSC' END
                    WHEN {PR} = '3' THEN 'PSC'
                    WHEN {PR} = '4' THEN CASE WHEN o_orderstatus = 'P' THEN 'REC' ELSE 'APL' END
                    ELSE CASE WHEN o_orderstatus = 'F' THEN NULL ELSE 'PSC' END END
                 AS application_route_type_cd,
               CASE WHEN o_orderstatus = 'F'
                      THEN '{{"firstInterviewSetTime": '
                           || CAST(CAST(CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS BIGINT) * 86400000
                                   + (o_orderkey % 97) * 900000 AS VARCHAR) || '}}'
                    WHEN o_orderstatus = 'O' THEN '{{"firstInterviewSetTime": ""}}'
                    WHEN {PR} = '1' THEN NULL
                    ELSE '{{"other": 1}}' END AS candidate_progress_data_json,
               o_orderpriority
        FROM orders LEFT JOIN order_job ON o_orderkey = l_orderkey"""),
    "candidate_progress": (("cp_src",), """
        SELECT candidate_progress_id, candidate_id, recruiter_company_id, job_id, ins_datetime, apply_date,
               application_route_type_cd, candidate_progress_data_json FROM cp_src"""),
    "candidate_progress_message_info": (("cp_src",), """
        SELECT candidate_progress_id, candidate_progress_id AS message_thread_id
        FROM cp_src WHERE application_route_type_cd = 'PSC'
        UNION ALL
        SELECT candidate_progress_id, candidate_progress_id + 1
        FROM cp_src WHERE application_route_type_cd = 'PSC' AND o_orderpriority = '5-LOW'"""),
    "candidate_progress_log": ((), """
        SELECT l_orderkey AS candidate_progress_id, l_shipdate + to_hours(l_linenumber) AS ins_datetime,
               CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'ITV__'
                    WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'MTADJ'
                    WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'OFFER'
                    WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'HIRNG'
                    WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'ITV__'
                    ELSE 'REJCT' END AS candidate_progress_status_cd,
               CASE WHEN l_discount >= 0.09 THEN 'Y' ELSE 'N' END AS del_flg
        FROM lineitem"""),
    "candidate_replace": (("order_job",), """
        SELECT o_orderkey * 3 + 1 AS candidate_replace_id, o_orderkey AS candidate_progress_id,
               o_custkey + 1 AS candidate_id, job_id + 1 AS job_id, CAST(floor(o_totalprice) AS BIGINT) AS income,
               o_orderdate + INTERVAL 30 DAY + to_hours(o_orderkey % 24) AS ins_datetime
        FROM orders LEFT JOIN order_job ON o_orderkey = l_orderkey
        WHERE o_orderstatus = 'F'"""),
    "message_thread": (("order_job", "recruiter_company"), f"""
        SELECT o_orderkey AS message_thread_id, o_custkey AS candidate_id, company_id AS recruiter_company_id,
               fl.l_partkey AS attached_job_id, rc.company_type_cd,
               CASE WHEN o_orderstatus IN ('F', 'O') THEN 'PSC' ELSE 'MAN' END AS create_trigger_type_cd,
               CASE WHEN {PR} = '1' THEN NULL WHEN {PR} IN ('2', '3') THEN 'FL' ELSE 'SL' END AS scout_s_class,
               o_orderdate - INTERVAL 158 HOUR AS scout_sent_tm,
               CASE WHEN o_totalprice > 100000 THEN o_orderdate - INTERVAL 158 HOUR + INTERVAL 1 DAY END
                 AS cn_scout_first_view_tm
        FROM orders
        LEFT JOIN order_job oj ON o_orderkey = oj.l_orderkey
        JOIN (SELECT l_orderkey AS lk, l_partkey FROM lineitem) fl ON o_orderkey = fl.lk
        LEFT JOIN recruiter_company rc ON oj.company_id = rc.recruiter_company_id"""),
    "message": ((), """
        SELECT l_orderkey AS message_thread_id,
               o_orderdate - INTERVAL 158 HOUR + to_hours((l_linenumber - 1) * 6) AS sent_tm,
               CASE WHEN l_linenumber = 1 OR l_returnflag = 'A' THEN 'TRUE' ELSE 'FALSE' END AS from_recruiter
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "candidate": (("ev2",), """
        SELECT c_custkey AS candidate_id, first_ts AS ins_datetime, last_ts AS upd_datetime,
               CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'LFT' ELSE 'ACT' END AS candidate_status_cd,
               CASE WHEN c_acctbal >= 5000 THEN 'M' ELSE 'F' END AS gender_cd,
               DATE '1950-01-01' + CAST(floor(abs(c_acctbal) * 2) AS INTEGER) AS birth_date,
               CAST(c_nationkey AS VARCHAR) AS area_cd
        FROM customer
        LEFT JOIN (SELECT user_id, min(ts2) AS first_ts, max(ts2) AS last_ts FROM ev2 GROUP BY user_id) r
          ON c_custkey = r.user_id"""),
    "candidate_personal_info": ((), """
        SELECT c_custkey AS candidate_id,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN NULL
                                 WHEN 'BUILDING' THEN 'Organic_' || CAST(c_nationkey AS VARCHAR)
                                 WHEN 'FURNITURE' THEN 'app_ios'
                                 WHEN 'HOUSEHOLD' THEN CASE WHEN c_acctbal < 0 THEN ''
                                                            ELSE 'ads_' || CAST(c_nationkey AS VARCHAR) END
                                 ELSE 'referral' END AS tracking_code
        FROM customer"""),
    "candidate_rating": ((), """
        SELECT c_custkey AS candidate_id, substr(c_mktsegment, 1, 1) AS candidate_rank_cd
        FROM customer WHERE c_acctbal > 0"""),
    "resume": ((), """
        SELECT c_custkey * 2 AS resume_id, c_custkey AS candidate_id, 'E' || right(c_name, 1) AS education_bg_cd,
               substr(c_mktsegment, 1, 2) AS income_cd, substr(c_mktsegment, 1, 3) AS job_change_duration_cd,
               CAST(floor(c_acctbal / 10) AS INTEGER) AS toeic_score, CAST(c_nationkey * 4 AS INTEGER) AS toefl_score,
               CAST(length(c_mktsegment) AS INTEGER) AS company_count
        FROM customer WHERE c_acctbal >= 0
        UNION ALL
        SELECT c_custkey * 2 + 1, c_custkey, 'E9', substr(c_mktsegment, 1, 2), 'LTR', 0, 1, 2
        FROM customer WHERE c_acctbal >= 0 AND c_nationkey % 5 = 0"""),
    "cls_education_bg": ((), """
        SELECT education_bg_cd, 'edu ' || education_bg_cd AS code_alias
        FROM (SELECT DISTINCT 'E' || right(c_name, 1) AS education_bg_cd FROM customer)
        WHERE education_bg_cd <> 'E9'"""),
    "cls_income": ((), """
        SELECT income_cd, 'inc ' || income_cd AS code_alias
        FROM (SELECT DISTINCT substr(c_mktsegment, 1, 2) AS income_cd FROM customer)"""),
    "resume_education_background": ((), f"""
        SELECT o_custkey * 2 AS resume_id, o_orderstatus AS education_bg_cd,
               'school ' || o_orderstatus AS education_name,
               CAST(CASE WHEN o_orderstatus = 'F' THEN 2001 ELSE 2005 END AS INTEGER) AS graduation_year,
               'GEN' AS course_type_cd,
               CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS BIGINT) AS school_master_id,
               'N' AS drop_flg, CASE WHEN o_orderstatus = 'O' THEN 'Y' ELSE 'N' END AS expected_flg,
               CASE WHEN {PR} = '1' THEN '1' ELSE '2' END AS display_no
        FROM orders WHERE {PR} IN ('1', '2')"""),
    "mst_school_info": ((), """
        SELECT mst_school_info_id, 'S' || CAST(mst_school_info_id AS VARCHAR) AS school_rank_cd
        FROM (SELECT DISTINCT CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS BIGINT)
                AS mst_school_info_id FROM orders)
        WHERE mst_school_info_id < 3"""),
    "resume_company": ((), """
        SELECT c_custkey * 2 AS resume_id, '1' AS display_no, c_mktsegment AS company_business,
               CASE WHEN c_acctbal > 5000 THEN c_name END AS business_content,
               CAST(NULL AS VARCHAR) AS appeal_point,
               CASE WHEN c_nationkey < 5 THEN 'free ' || c_name END AS free_text
        FROM customer WHERE c_acctbal >= 0 AND c_nationkey < 20
        UNION ALL
        SELECT c_custkey * 2, '2', 'second', NULL, NULL, NULL
        FROM customer WHERE c_acctbal >= 0 AND c_nationkey = 0"""),
    "resume_business": ((), """
        SELECT c_custkey * 2 AS resume_id, '1' AS display_no, c_mktsegment AS resume_business_type_cd
        FROM customer WHERE c_acctbal >= 0"""),
    "resume_job": ((), """
        SELECT c_custkey * 2 AS resume_id, '1' AS display_no,
               CASE WHEN c_nationkey < 5 THEN 'gear' WHEN c_nationkey < 10 THEN 'widget'
                    WHEN c_nationkey < 15 THEN 'rod' WHEN c_nationkey < 20 THEN 'ring' ELSE 'bolt' END
                 AS resume_job_type_cd
        FROM customer WHERE c_acctbal >= 0"""),
    "candidate_login_history": (("ev2",), "SELECT user_id AS cid, ts2 AS login_tm FROM ev2 WHERE event_type = 'view'"),
    "recruiter_correspond_data": (("ev2",), """
        SELECT event_id AS id, user_id AS candidate_id, CAST(floor(value) AS BIGINT) AS recruiter_company_id,
               k AS job_id, ts2 AS conversion_tm,
               CASE WHEN event_type = 'click' THEN 'FLW' ELSE 'APL' END AS conversion_type_cd,
               CASE WHEN value >= 100 THEN 'Y' ELSE 'N' END AS recruiter_done_flg,
               CASE WHEN value >= 200 THEN 'Y' ELSE 'N' END AS recruiter_scout_flg
        FROM ev2 WHERE event_type IN ('click', 'purchase')"""),
    "recruiter_login_log": (("ev2",), """
        SELECT event_id AS recruiter_login_log_id, user_id AS recruiter_id, ts2 AS login_tm
        FROM ev2 WHERE event_type = 'signup'"""),
    "recruiter": ((), "SELECT c_custkey AS recruiter_id, c_custkey * 2 AS recruiter_company_id FROM customer"),
    "footprint": (("ev2",), """
        SELECT event_id AS footprint_key, CAST(floor(value) AS BIGINT) AS company_id, k AS job_id,
               ts2 AS upd_datetime
        FROM ev2 WHERE event_type = 'error'"""),
    "purchase_receipt": ((), f"""
        SELECT o_orderkey AS purchase_receipt_id, o_custkey AS recruiter_company_id, {PR} AS product_cd,
               o_orderpriority AS product_name,
               CASE WHEN o_orderstatus = 'P' THEN 'OPT' ELSE 'MAI' END AS product_category_cd,
               CASE WHEN o_totalprice < 20000 THEN 'Y' ELSE 'N' END AS del_flg,
               CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'O' THEN NULL
                    ELSE CAST(o_orderdate AS DATE) END AS valid_from_date,
               CAST(o_orderdate AS DATE) + CAST({PR} AS INTEGER) * 30 AS valid_to_date,
               CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O' THEN NULL
                    ELSE o_orderdate END AS ins_datetime,
               o_orderdate + INTERVAL 1 DAY AS upd_datetime
        FROM orders"""),
    "analytical_company_daily_data": ((), "SELECT CAST(o_orderdate AS DATE) AS target_date FROM orders"),
    "hassei_sales": ((), f"""
        SELECT o_orderkey AS hassei_sales_id,
               CASE WHEN {PR} = '1' OR o_totalprice > 300000 THEN NULL ELSE o_orderkey - 1 END AS previous_id,
               o_orderkey AS sales_product_id,
               CASE {PR} WHEN '1' THEN 'REP' WHEN '2' THEN 'OFF' WHEN '3' THEN 'BOR' WHEN '4' THEN 'RDC'
                         ELSE 'OTH' END AS sales_product_type_cd,
               CASE WHEN o_totalprice < 50000 THEN NULL ELSE CAST(floor(o_totalprice) AS BIGINT) END AS sales_price,
               CASE WHEN o_totalprice < 150000 THEN 'N' ELSE 'Y' END AS sales_enable_flg,
               CASE WHEN o_orderstatus = 'F' THEN
                      CASE WHEN o_totalprice < 100000 THEN 'ご利用プラン変更'
                           WHEN o_totalprice < 200000 THEN 'ご利用プラ'
                           WHEN o_totalprice < 300000 THEN NULL
                           ELSE 'standard' END
                    ELSE 'standard' END AS sales_remarks,
               CAST(o_orderdate AS DATE) + 40 AS hassei_date
        FROM orders"""),
}


def with_clause(ctes: dict[str, tuple[tuple[str, ...], str]], needed: list[str]) -> str:
    """``WITH`` clause holding ``needed`` and their dependencies, in order."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in ctes[n][0]:
            visit(d)
        order.append(n)

    for n in needed:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({ctes[n][1]})" for n in order)
