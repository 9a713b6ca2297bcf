"""Marts end to end on stand-in tables: oracle equality, invariants, plan shape."""
import re


import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from oracle.queries import all_sql
from recruitflow.plans.standin_queries import STANDIN_PARAMS as P
from recruitflow.plans.standin_queries import all_queries
from tools.compare import digest, duck, duck_rows, spark_rows

SF = "/root/testdata/sf0.001"
QUERIES = all_queries()
ORACLE = all_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    c1, r1 = spark_rows(QUERIES[name](spark, SF))
    c2, r2 = duck_rows(con, ORACLE[name])
    assert sorted(c1) == sorted(c2)
    assert digest(c1, r1) == digest(c2, r2)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "b_company_id"


def test_company_info_one_row_per_company_without_owner(spark):
    df = QUERIES["company_info"](spark, SF)
    assert df.count() == df.select("b_company_id").distinct().count()
    assert df.where(F.col("b_company_id") == P.owner_company_id).count() == 0


def test_kept_contracts_unique_start_and_end(spark):
    df = QUERIES["ranked_contracts"](spark, SF)
    n = df.count()
    assert n == df.select("b_company_id", "b_contract_start_date").distinct().count()
    assert n == df.select("b_company_id", "b_contract_end_date").distinct().count()
    assert df.where(F.col("b_contract_start_date") < F.lit(P.contract_since)).count() == 0


def test_candidate_log_window(spark):
    df = QUERIES["candidate_action_log"](spark, SF)
    lo = df.agg(F.min("act_date")).first()[0]
    assert lo >= P.local_bound()


def test_company_log_overlaps_only_add_rows(spark):
    actions = QUERIES["company_actions"](spark, SF)
    log = QUERIES["company_action_log"](spark, SF)
    assert log.count() >= actions.count()
    keys = ["act_type", "act_id", "act_date", "recruiter_company_id", "job_id"]
    assert log.select(*keys).distinct().count() == actions.select(*keys).distinct().count()


def test_fixed_log_since(spark):
    df = QUERIES["company_action_log_fixed"](spark, SF)
    assert df.where(F.col("act_type") == "SF決定").where(F.col("act_date") < F.lit(P.since)).count() == 0
    assert df.where(F.col("act_type") == "PS返信").where(F.col("date_for_join") > F.col("act_date")).count() == 0


def test_candidate_info_covers_every_candidate(spark):
    df = QUERIES["candidate_basic_info"](spark, SF)
    from recruitflow.sources.standins import standin_tables
    n_cand = standin_tables(spark, SF).candidate.count()
    assert df.select("c_candidate_id").distinct().count() == n_cand
    assert df.where(F.col("c_apl_cnt").isNull() | F.col("c_login_2_7_ratio").isNull()).count() == 0


BAD_OPS = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", ["company_info", "job_info", "candidate_action_log", "company_action_log",
                                  "company_action_log_fixed", "candidate_basic_info"])
def test_plan_has_no_udf_or_nested_loop(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for op in BAD_OPS:
        assert op not in plan, op


def test_plan_uses_anti_join_and_day_explode(spark):
    plan = QUERIES["candidate_action_log"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan
    plan = QUERIES["company_action_log"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" in plan and "LeftAnti" in plan  # contract days (C-0) explode their range


def test_window_filter_reaches_scan(spark, tmp_path):
    from recruitflow.plans.candidate_action_log import login_days
    from recruitflow.sources.standins import write_standins
    t = write_standins(spark, SF, str(tmp_path / "src"))
    plan = login_days(t, P)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(login_tm,", plan)
    assert "ReadSchema: struct<cid:bigint,login_tm:timestamp_ntz>" in plan


def test_views_run_no_job(spark):
    """Registering the marts only builds plans."""
    from recruitflow.plans.catalog import register_views
    from recruitflow.sources.standins import standin_tables
    tracker = spark.sparkContext.statusTracker()
    t = standin_tables(spark, SF)
    before = set(tracker.getJobIdsForGroup(None))
    register_views(spark, t, P)
    assert set(tracker.getJobIdsForGroup(None)) == before


def test_quality_checks_hold(spark):
    from recruitflow.plans import quality
    from recruitflow.plans.company_action_log import ranked_contracts
    from recruitflow.sources.standins import standin_tables
    t = standin_tables(spark, SF)
    assert quality.owner_rows(QUERIES["candidate_action_log"](spark, SF).where(
        F.col("act_type").isin("2_興味がある", "3_PS送信", "4_応募", "5_HS", "6_内定", "7_決定")),
        P.owner_company_id).count() == 0
    assert quality.owner_rows(QUERIES["company_info"](spark, SF), P.owner_company_id, "b_company_id").count() == 0
    assert quality.duplicate_kept_contracts(ranked_contracts(t, P)).count() == 0
    assert quality.repeated_companies(QUERIES["company_info"](spark, SF)).count() == 0
    assert quality.before_window(QUERIES["candidate_action_log"](spark, SF), P.local_bound()).count() == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_row_caps(spark, name):
    """Every registered query runs over whole tables: no LIMIT in its plan or its oracle SQL."""
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "GlobalLimit" not in plan and "LocalLimit" not in plan
    assert not re.search(r"\bLIMIT\b", ORACLE[name], re.IGNORECASE)
