"""Bucketed sources remove the shuffles of co-located joins and aggregates; sources by month are read in part."""
import re

import pytest

from recruitflow.operators import activity, scouts
from recruitflow.plans import candidate_action_log, company_action_log
from recruitflow.plans.candidate_action_log import scout_mails
from recruitflow.plans.standin_queries import STANDIN_PARAMS as P
from recruitflow.sources.layout import write_bucketed, write_by_month
from recruitflow.sources.standins import standin_tables
from recruitflow.sources.tables import Tables


@pytest.fixture(scope="module")
def layouts(spark, tmp_path_factory):
    src = standin_tables(spark, "/root/testdata/sf0.001")
    plain_dir = str(tmp_path_factory.mktemp("plain"))
    for n, df in src.items():
        df.write.parquet(f"{plain_dir}/{n}")
    return Tables.from_parquet(spark, plain_dir), write_bucketed(spark, src, "rf_bucketed", 8)


@pytest.fixture
def shuffle_shape(spark):
    """Keep the shuffle form of every join (no automatic broadcast, no AQE)."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled",
            "spark.sql.requireAllClusterKeysForCoPartition")
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_bucketed_sources_colocate(layouts, shuffle_shape):
    plain, bucketed = layouts
    for build in (lambda t: scouts.opened_scouts_with_reply(t, P.local_bound()),
                  lambda t: activity.candidate_login_days(t, P.local_bound())):
        a, b = build(plain), build(bucketed)
        assert _exchanges(b) < _exchanges(a)
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_bucketed_subset_key_copartition_same_rows(spark, layouts, shuffle_shape):
    """Reusing thread-id buckets for the (thread, send time) semi join keeps the result."""
    plain, bucketed = layouts
    want = sorted(map(tuple, scout_mails(plain, P).collect()))
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    relaxed = scout_mails(bucketed, P)
    assert _exchanges(relaxed) < _exchanges(scout_mails(plain, P))
    assert sorted(map(tuple, relaxed.collect())) == want and len(want) > 0


@pytest.fixture(scope="module")
def by_month(spark, layouts, tmp_path_factory):
    return write_by_month(spark, layouts[0], str(tmp_path_factory.mktemp("months")))


def _scans(df):
    """The scans of a plan that prune months."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"PartitionFilters: \[[^\]]*event_month#\d+ >= 20\d\d-\d\d-01", plan)


def test_windows_prune_months(layouts, by_month):
    plain, _ = layouts
    for build, tables in ((candidate_action_log.login_days, 1), (scout_mails, 3), (company_action_log.footprints, 1),
                          (company_action_log.auto_scout_segments, 1), (company_action_log.scout_mails, 2),
                          (company_action_log.interest_clicks, 1), (company_action_log.login_days, 1)):
        a, b = build(plain, P), build(by_month, P)
        assert len(_scans(b)) == tables and not _scans(a), build
        assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_months_keep_every_row(spark, layouts, by_month, tmp_path):
    plain, _ = layouts
    for name in ("message_thread", "candidate_progress", "job"):
        assert by_month[name].columns == plain[name].columns
        assert sorted(map(str, by_month[name].collect())) == sorted(map(str, plain[name].collect()))
    # another column than the event time's is filtered, not pruned
    opened = by_month.since("message_thread", "cn_scout_first_view_tm", P.local_bound())
    assert not _scans(opened) and opened.count() == plain.since(
        "message_thread", "cn_scout_first_view_tm", P.local_bound()).count() > 0


def test_months_with_nulls_and_a_hot_month(spark, tiny, tmp_path):
    from datetime import datetime
    days = [None] * 3_000 + [datetime(2018, 5, 1)] * 3_000 + [datetime(2018, 6, d) for d in range(1, 31)]
    t = tiny(candidate_login_history=[(i, d) for i, d in enumerate(days)])
    m = write_by_month(spark, t, str(tmp_path / "m"))
    assert m.candidate_login_history.count() == len(days)
    assert m.since("candidate_login_history", "login_tm", datetime(2018, 6, 2)).count() == 29
    assert m.since("candidate_login_history", "login_tm", datetime(2018, 5, 1)).count() == 3_030
    assert m.message.count() == 0  # an empty source


def test_log_from_months_equals_log(layouts, by_month):
    for mart in (candidate_action_log.candidate_action_log, company_action_log.company_action_log):
        want = sorted(map(str, mart(layouts[0], P).collect()))
        assert sorted(map(str, mart(by_month, P).collect())) == want and want
