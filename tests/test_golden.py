"""Golden rows: marts on tiny hand-built tables, expected output worked out by hand."""
from datetime import date, datetime

from recruitflow.params import Params
from recruitflow.plans.candidate_action_log import candidate_action_log
from recruitflow.plans.company_info import company_info

D, TS = date, datetime
# 20:00 UTC on 31 Aug 2018 = 05:00 JST on 1 Sep: the JST window starts 2017-08-01
P = Params(as_of=TS(2018, 8, 31, 20, 0))


def test_candidate_action_log_golden(tiny):
    t = tiny(
        candidate=[(10, TS(2017, 9, 1, 10), TS(2018, 1, 1), "ACT", "M", D(1990, 1, 1), "13"),
                   (11, TS(2017, 7, 31, 23), TS(2018, 2, 3, 9), "LFT", "F", D(1991, 1, 1), "13")],
        candidate_personal_info=[(10, "ads_x"), (11, None)],
        candidate_login_history=[(10, TS(2017, 9, 1, 12)),                           # registration day: out
                                 (10, TS(2017, 9, 2, 8)), (10, TS(2017, 9, 2, 9)),   # one day
                                 (11, TS(2018, 2, 2, 7)),
                                 (11, TS(2018, 2, 3, 7))],                           # leaving day: out
        recruiter_correspond_data=[(1, 10, 5, 100, TS(2017, 10, 1, 10), "FLW", "N", "N"),
                                   (2, 10, 5, 100, TS(2017, 10, 1, 15), "FLW", "N", "N"),  # same day
                                   (3, 10, 1, 100, TS(2017, 10, 2), "FLW", "N", "N"),      # platform
                                   (4, 10, 5, 100, TS(2017, 10, 3), "APL", "N", "N")],     # not interest
        message_thread=[(50, 10, 5, 100, "CRS", "PSC", "FL", TS(2017, 11, 1, 9), TS(2017, 11, 2)),
                        (50, 10, 5, 101, "CRS", "PSC", "FL", TS(2017, 11, 1, 9), TS(2017, 11, 2)),
                        (51, 10, 1, 100, "CRS", "PSC", "SL", TS(2017, 11, 1, 9), None)],
        message=[(50, TS(2017, 11, 1, 9), "TRUE"), (50, TS(2017, 11, 3, 10), "FALSE"),
                 (50, TS(2017, 11, 5), "FALSE"), (51, TS(2017, 11, 1, 9), "TRUE")],
        candidate_progress=[(200, 10, 5, 100, TS(2017, 12, 1, 10), D(2017, 12, 1), "PSC", None),
                            (201, 10, 1, 100, TS(2017, 12, 1), D(2017, 12, 1), "APL", None),
                            (202, 10, 6, 102, TS(2017, 7, 15), D(2017, 7, 15), "APL", None)],
        candidate_progress_message_info=[(200, 50)],
        candidate_progress_log=[(200, TS(2017, 12, 10), "ITV__", "N"), (200, TS(2017, 12, 20), "OFFER", "N"),
                                (202, TS(2017, 12, 11), "MTADJ", "N"), (202, TS(2017, 12, 12), "OFFER", "Y"),
                                (202, TS(2018, 1, 10), "HIRNG", "N")],
        candidate_replace=[(300, 200, 10, 100, 5000000, TS(2018, 1, 5)),
                           (301, 202, 10, 102, 4000000, TS(2018, 1, 6))],
    )
    PS = "1_興味があるPS"
    want = {
        (10, TS(2017, 9, 1, 10), "0_登録", "ads", None, None, None, None),
        (10, TS(2017, 9, 2), "1_ログイン", None, None, None, None, None),
        (11, TS(2018, 2, 2), "1_ログイン", None, None, None, None, None),
        (10, TS(2017, 10, 1), "2_興味がある", None, 100, 5, None, None),
        (10, TS(2017, 11, 1), "3_PS送信", PS, 100, 5, 50, D(2017, 11, 3)),
        (10, TS(2017, 11, 1), "3_PS送信", PS, 101, 5, 50, D(2017, 11, 3)),
        (10, TS(2017, 12, 1, 10), "4_応募", PS, 100, 5, None, None),
        (10, TS(2017, 12, 10), "5_HS", PS, 100, 5, None, None),
        (10, TS(2017, 12, 11), "5_HS", "通常応募", 102, 6, None, None),
        (10, TS(2017, 12, 20), "6_内定", PS, 100, 5, None, None),
        (10, TS(2018, 1, 5), "7_決定", PS, 100, 5, None, None),
        (11, TS(2018, 2, 3, 9), "8_退会", None, None, None, None, None),
    }
    rows = [tuple(r) for r in candidate_action_log(t, P).collect()]
    assert len(rows) == len(want)
    assert set(rows) == want


def test_company_info_golden(tiny):
    def pr(i, cid, start, end, ins, cat="MAI", deleted="N"):
        return (i, cid, f"P{i}", f"plan {i}", cat, deleted, start, end, ins, ins)

    t = tiny(
        recruiter_company=[(5, "co5", "CRS", "13", "AUTO"), (6, "co6", "ESS", "99", "XX"), (1, "owner", "CRS", "13", "AUTO")],
        mst_area=[("13", "Tokyo")],
        mst_business_type=[("AUTO", "IA", "auto"), ("XX", "ZZ", "other industry")],
        purchase_receipt=[pr(1, 5, D(2017, 1, 1), D(2017, 6, 30), TS(2017, 1, 1)),
                          pr(2, 5, D(2018, 1, 1), D(2018, 6, 30), TS(2018, 1, 2)),
                          pr(3, 5, D(2018, 1, 1), D(2018, 3, 31), TS(2018, 1, 1)),    # same start, earlier: wins
                          pr(4, 5, D(2018, 5, 1), D(2018, 9, 30), TS(2018, 4, 1), deleted="Y"),
                          pr(5, 6, None, D(2018, 1, 31), TS(2017, 1, 1)),              # NULL start ranks first
                          pr(6, 6, D(2018, 2, 1), D(2018, 4, 30), TS(2018, 1, 1)),
                          pr(7, 1, D(2018, 2, 1), D(2018, 4, 30), TS(2018, 1, 1))],
    )
    rows = {tuple(r) for r in company_info(t, P).collect()}
    assert rows == {
        (5, "co5", "CRS", "Tokyo", "IT・インターネット・ゲーム・通信", "auto", "P3", "plan 3", D(2018, 1, 1), D(2018, 3, 31)),
        (6, "co6", "ESS", None, "other industry", "other industry", "P5", "plan 5", None, D(2018, 1, 31)),
    }


def test_company_action_log_golden(tiny):
    from recruitflow.plans.company_action_log import company_action_log

    def pr(i, cid, start, end, ins):
        return (i, cid, f"P{i}", f"plan {i}", "MAI", "N", start, end, ins, ins)

    t = tiny(
        recruiter_company=[(5, "co5", "CRS", "13", "AUTO"), (6, "co6", "ESS", "13", "AUTO")],
        purchase_receipt=[pr(1, 5, D(2018, 1, 1), D(2018, 1, 31), TS(2018, 1, 1)),
                          pr(2, 5, D(2018, 1, 31), D(2018, 2, 2), TS(2018, 1, 2))],   # overlaps on 31 Jan
        analytical_company_daily_data=[(D(2018, 1, 30),), (D(2018, 1, 31),), (D(2018, 2, 1),), (D(2018, 2, 3),),
                                       (D(2018, 2, 1),)],
        job=[(100, 5, "job", None, None, None, None, None, None, None)],
        footprint=[(900, 5, 100, TS(2018, 1, 31, 5))],       # after 00:00 on contract 1's last day
        recruiter=[(1, 5), (2, 5)],
        recruiter_login_log=[(10, 1, TS(2018, 2, 1, 9)), (11, 2, TS(2018, 2, 1, 10))],
    )
    got = sorted((r.act_date, r.act_id, r.act_type, r.b_contract_id, r.b_recent_contract)
                 for r in company_action_log(t, P).collect())
    day = "0_契約中"
    assert got == sorted([
        (TS(2018, 1, 30), 5, day, 1, 2),
        (TS(2018, 1, 31), 5, day, 1, 2), (TS(2018, 1, 31), 5, day, 1, 2),   # two contracts in force ...
        (TS(2018, 1, 31), 5, day, 2, 1), (TS(2018, 1, 31), 5, day, 2, 1),   # ... each meets both contracts
        (TS(2018, 2, 1), 5, day, 2, 1),
        (TS(2018, 1, 31, 5), 900, "5_足あと", 2, 1),
        (TS(2018, 2, 1), 11, "3_ログイン", 2, 1),
    ])


def test_candidate_basic_info_counters_golden(tiny):
    from decimal import Decimal

    from recruitflow.plans.candidate_basic_info import candidate_basic_info

    t = tiny(
        candidate=[(10, TS(2018, 1, 1, 10), None, "ACT", "M", D(1990, 9, 1), "13"),
                   (11, None, None, "ACT", "F", D(1990, 8, 31), "13")],
        candidate_login_history=[(10, TS(2018, 1, 1, 12)), (10, TS(2018, 1, 2, 8)), (10, TS(2018, 1, 2, 9)),
                                 (10, TS(2018, 1, 7, 23)), (10, TS(2018, 1, 8, 1)), (11, TS(2018, 1, 3))],
        recruiter_correspond_data=[(1, 10, 5, 100, TS(2018, 1, 1, 11), "FLW", "N", "N"),
                                   (2, 10, 5, 101, TS(2018, 1, 1, 12), "FLW", "N", "N"),
                                   (3, 10, 5, 102, TS(2018, 1, 1, 13), "APL", "N", "N"),
                                   (4, 10, 5, 103, TS(2018, 1, 2, 13), "FLW", "N", "N")],
        candidate_progress=[(200, 10, 5, 100, TS(2018, 1, 3), D(2018, 1, 3), "APL", None),
                            (201, 10, 1, 100, TS(2018, 1, 4), D(2018, 1, 4), "APL", None)],
        candidate_progress_log=[(200, TS(2018, 1, 5), "ITV__", "N"), (200, TS(2018, 1, 6), "MTADJ", "N"),
                                (200, TS(2018, 1, 7), "OFFER", "N"), (200, TS(2018, 1, 8), "ITV__", "Y")],
        message_thread=[(60, 10, 5, 100, "CRS", "PSC", "FL", TS(2018, 1, 5), None),
                        (60, 10, 5, 101, "CRS", "PSC", "FL", TS(2018, 1, 5), None),
                        (61, 10, 6, 100, "ESS", "PSC", "FL", TS(2018, 1, 6), None),
                        (62, 10, 5, 100, "CRS", "PSC", "FL", TS(2017, 6, 30), None),   # before the UTC window
                        (63, 10, 5, 100, "CRS", "PSC", "FL", TS(2018, 1, 7), None)],   # no recruiter message
        message=[(60, TS(2018, 1, 5), "TRUE"), (61, TS(2018, 1, 6), "TRUE"), (62, TS(2017, 6, 30), "TRUE"),
                 (63, TS(2018, 1, 7, 1), "TRUE")],
    )
    got = {r.c_candidate_id: (r.c_age, r.c_login_2_7_ratio, r.c_flw_1_cnt, r.c_apl_cnt, r.c_hs_cnt,
                              r.c_crs_ps_cnt, r.c_ess_ps_cnt, r.c_rsume_char_cnt, r.c_trcd)
           for r in candidate_basic_info(t, P).collect()}
    assert got == {
        10: (27, Decimal("0.33333333333"), 2, 2, 2, 1, 1, 0, "Organic"),
        11: (28, Decimal("0E-11"), 0, 0, 0, 0, 0, 0, "Organic"),
    }


def test_company_action_log_fixed_golden(tiny):
    from recruitflow.plans.company_action_log_fixed import company_action_log_fixed

    t = tiny(
        recruiter_company=[(5, "co5", "CRS", "13", "AUTO"), (6, "co6", "ESS", "13", "AUTO")],
        candidate=[(10, TS(2017, 1, 1), None, "ACT", "M", None, "13")],
        candidate_progress=[(200, 10, 6, 100, TS(2017, 9, 1, 10), D(2017, 8, 31), "APL", None),   # agent company kept
                            (201, 10, 5, 100, TS(2017, 7, 31), D(2017, 7, 31), "APL", None)],     # before the start
        candidate_replace=[(300, 200, 10, 100, 500, TS(2017, 10, 1, 13))],
        hassei_sales=[(399, None, 999, "RDC", 10, "Y", "x", D(2017, 10, 1)),                      # only a predecessor
                      (400, 399, 300, "OFF", 1000, "Y", "x", D(2017, 11, 1)),                     # OFF after RDC -> 0
                      (401, None, 300, "BOR", 2000, "Y", "ご利用プラ", D(2017, 11, 1)),              # plan change: out
                      (402, None, 300, "REP", None, "Y", "y", D(2017, 11, 2)),                    # no price -> 0
                      (403, None, 300, "OFF", 10, "Y", "z", D(2017, 7, 31))],                     # before the start
        message_thread=[(50, 10, 5, 100, "CRS", "PSC", "FL", TS(2017, 9, 1, 9), TS(2017, 9, 2))],
        message=[(50, TS(2017, 9, 1, 9), "TRUE"), (50, TS(2017, 9, 3, 10), "FALSE")],
    )
    PS, APL = "興味があるPS", "通常応募"
    want = sorted([
        (D(2017, 9, 1), "PS送信", 10, 5, 100, PS, D(2017, 9, 1), None, None, 50, None, None),
        (D(2017, 9, 3), "PS返信", 10, 5, 100, PS, D(2017, 9, 1), None, None, 50, None, None),
        (D(2017, 8, 31), "応募", 10, 6, 100, APL, D(2017, 8, 31), None, None, None, None, None),
        (D(2017, 10, 1), "決定", 10, 6, 100, APL, D(2017, 8, 31), None, None, None, 500, None),
        (D(2017, 11, 1), "SF決定", 10, 6, 100, APL, D(2017, 8, 31), None, None, None, 1000, 0),
        (D(2017, 11, 2), "SF決定", 10, 6, 100, APL, D(2017, 8, 31), None, None, None, None, 0),
    ], key=repr)
    got = sorted((tuple(r) for r in company_action_log_fixed(t, P).collect()), key=repr)
    assert got == want


def test_job_info_golden(tiny):
    from decimal import Decimal

    from recruitflow.plans.job_info import job_info

    def job(i, cid, jtype, lo, hi, area):
        return (i, cid, f"j{i}", TS(2018, 1, 1), "P1", jtype, "full", lo, hi, area)

    t = tiny(
        recruiter_company=[(5, "co5", "CRS", "13", "AUTO"), (6, "agent6", "ESS", "99", "XX")],
        mst_area=[("13", "Tokyo"), ("27", "Osaka")],
        mst_business_type=[("AUTO", "IA", "auto"), ("XX", "ZZ", "other"), ("MED", "IG", "medical")],
        mst_job_type=[("gear", "JA", "job gear"), ("ring", "JZ", "job ring")],
        job=[job(100, 5, "gear", 4567890, 8000000, "27"),
             job(101, 6, "ring", 3000000, None, "99"),
             job(102, 7, "gear", 1, 2, "13"),            # company unknown: dropped
             job(103, 5, "bolt", 2000000, 3000000, "13")],
        job_business_type=[(100, 1, "MED"), (100, 2, "XX"), (101, 1, "UNKNOWN")],
        job_company=[(101, "client co")],
    )
    got = {r.j_job_id: (r.j_business_g_type, r.j_business_type, r.j_g_job_type, r.j_job_type, r.j_income_range,
                        r.j_income_median, r.j_company_name, r.j_main_area_name, r.j_company_type_cd,
                        r.j_source_company)
           for r in job_info(t, P).collect()}
    IA = "IT・インターネット・ゲーム・通信"
    assert got == {
        100: ("医薬・医療・バイオ・メディカル", None, "営業", "job gear", "456万円-800万円", Decimal("6283945.000000"),
              "co5", "Osaka", "CRS", "co5"),
        101: (None, None, None, "job ring", None, None, "client co", None, "ESS", "agent6"),
        103: (IA, IA, None, None, "200万円-300万円", Decimal("2500000.000000"), "co5", "Tokyo", "CRS", "co5"),
    }


def test_application_actions_equal_their_branches(tiny):
    """One pass over the applications gives the rows of four branches, repeated and missing keys included."""
    from recruitflow.plans import company_action_log as m4
    from recruitflow.operators.logs import union_log
    late, iv = TS(2018, 6, 1, 3), '{"firstInterviewSetTime": %d}' % (1_530_000_000_000)
    t = tiny(
        recruiter_company=[(5, "a", "CRS", "13", "IT"), (6, "b", "ESS", "13", "IT"), (1, "own", "CRS", "13", "IT")],
        candidate=[(7, None, None, "ACT", "M", None, "13"), (7, None, None, "ACT", "M", None, "13")],
        candidate_progress=[(1, 7, 5, 100, late, None, "PSC", iv), (1, 7, 5, 101, late, None, "APL", None),
                            (2, 8, 5, 100, TS(2010, 1, 1), None, "APL", iv), (3, None, 5, None, late, None, None, iv),
                            (None, 7, 5, 100, late, None, "APL", '{"firstInterviewSetTime": ""}'),
                            (4, 7, 6, 100, late, None, "APL", iv), (5, 7, 1, 100, late, None, "APL", iv),
                            (6, 7, 5, 100, None, None, "APL", '{"firstInterviewSetTime": "x"}'),
                            (7, 7, 5, 100, TS(2010, 1, 1), None, "APL", None)],
        candidate_progress_message_info=[(1, 50), (1, None)],
        message_thread=[(50, 7, 5, 100, "CRS", "PSC", "FL", late, None)],
        candidate_progress_log=[(i, late, s, "N") for i in (1, 2, 3, 6, 7, None) for s in ("ITV__", "OFFER", "OFFER")]
        + [(7, late, "HIRNG", "N"), (6, late, "OFFER", "Y"), (6, TS(2010, 1, 1), "OFFER", "N"), (6, None, "OFFER", "N")],
        candidate_replace=[(10 + (i or 0), i, 7, 100, 500 + (i or 0), late) for i in (1, 1, 2, 3, 6, 7, None)]
        + [(90, 6, 7, 100, None, TS(2010, 1, 1)), (None, 6, 7, 100, None, late)])
    cp = m4.crs_applications(t, P)
    apart = union_log([m4.applied(cp, P), m4.status_branches(cp, t, P), m4.first_interviews(cp, P), m4.decisions(cp, t, P)])
    got, want = (sorted(map(str, df.collect())) for df in (m4.application_actions(cp, t, P), apart))
    assert got == want and {r.act_type for r in apart.collect()} == {m4.ACT[k] for k in ("apply", "hs", "offer", "interview", "decision")}
    plan = m4.company_actions(t, P)._jdf.queryExecution().optimizedPlan().toString()
    # the route of an application is looked up once, not once a branch
    assert plan.count("HSC") == 1
