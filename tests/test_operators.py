"""Operators on tiny in-memory tables (edge rows of FIXTURES.md §4)."""
from datetime import date, datetime



from recruitflow.operators import activity, applications, contracts, joins, scouts
from recruitflow.operators.counts import funnel_counts
from recruitflow.params import Params

P = Params(as_of=datetime(2018, 8, 31, 20, 0))
D, TS = date, datetime


def pr(i, cid, start, end, ins, cat="MAI", deleted="N"):
    return (i, cid, "P", "plan", cat, deleted, start, end, ins, ins)


def companies(*ids, ctype="CRS"):
    return [(i, f"co{i}", ctype, "13", "AUTO") for i in ids]


def test_contract_dedupe_and_rank(tiny):
    t = tiny(recruiter_company=companies(1, 5, 6),
             purchase_receipt=[
                 pr(10, 5, D(2017, 1, 1), D(2017, 6, 30), TS(2017, 1, 1, 9)),
                 pr(11, 5, D(2017, 1, 1), D(2017, 7, 31), TS(2017, 1, 1, 8)),   # same start, inserted earlier
                 pr(12, 5, D(2017, 2, 1), D(2017, 7, 31), TS(2017, 1, 2)),      # same end as 11, later
                 pr(13, 5, D(2017, 3, 1), D(2017, 9, 30), None),                # NULL insert time
                 pr(14, 5, D(2017, 3, 1), D(2017, 9, 30), TS(2017, 3, 1)),      # same start as 13 -> wins
                 pr(15, 5, D(2018, 1, 1), D(2018, 3, 1), TS(2018, 1, 1), deleted="Y"),
                 pr(16, 5, D(2018, 1, 1), D(2018, 3, 1), TS(2018, 1, 1), cat="OPT"),
                 pr(17, 1, D(2018, 1, 1), D(2018, 3, 1), TS(2018, 1, 1)),       # platform owner
                 pr(18, 6, D(2016, 7, 31), D(2016, 9, 1), TS(2016, 7, 1)),
                 pr(19, 6, D(2016, 8, 1), D(2016, 9, 2), TS(2016, 7, 2)),
                 pr(20, 6, D(2016, 8, 2), D(2016, 9, 2), TS(2016, 7, 1)),       # same end as 19, earlier
             ])
    m = contracts.main_contracts(t, 1)
    starts = {r.b_contract_id for r in contracts.drop_duplicate_contracts(m).collect()}
    assert starts == {11, 12, 14, 18, 19, 20}
    both = {r.b_contract_id for r in contracts.drop_duplicate_contracts(m, by_end_too=True).collect()}
    assert both == {11, 14, 18, 20}
    since = contracts.main_contracts(t, 1, start_since=D(2016, 8, 1))
    assert {r.b_contract_id for r in contracts.drop_duplicate_contracts(since, by_end_too=True).collect()} == \
        {11, 14, 20}
    latest = {r.b_company_id: r.b_contract_id
              for r in contracts.latest_contract_per_company(contracts.drop_duplicate_contracts(m)).collect()}
    assert latest == {5: 14, 6: 20}
    ranks = {r.b_contract_id: r.b_recent_contract for r in contracts.rank_recent(
        contracts.drop_duplicate_contracts(m, by_end_too=True)).collect()}
    assert ranks == {14: 1, 11: 2, 20: 1, 18: 2}


def test_day_sequence_guard(spark):
    df = spark.createDataFrame([(1, D(2018, 1, 5), D(2018, 1, 3)), (2, D(2018, 1, 5), D(2018, 1, 5)),
                                (3, None, D(2018, 1, 5)), (4, D(2018, 1, 1), D(2018, 1, 3))], "i int, a date, b date")
    out = joins.explode_days(df, "a", "b", "d", clip_lo=D(2018, 1, 2))
    assert sorted((r.i, r.d) for r in out.collect()) == [(2, D(2018, 1, 5)), (4, D(2018, 1, 2)), (4, D(2018, 1, 3))]


import pytest


def test_interval_left_join_boundaries(spark):
    acts = spark.createDataFrame([
        (1, 7, TS(2018, 1, 31, 0, 0)),   # midnight of the last day: matches
        (2, 7, TS(2018, 1, 31, 5, 0)),   # after midnight of 100's last day: only 101
        (3, 7, TS(2018, 2, 1, 0, 0)),    # end = next start: both contracts
        (4, 7, TS(2018, 2, 15, 10, 0)),  # one contract
        (5, 8, TS(2018, 2, 15, 10, 0)),  # company without contracts
        (6, None, TS(2018, 2, 15)),      # NULL key
    ], "a int, company bigint, at timestamp_ntz")
    cons = spark.createDataFrame([(7, 100, D(2018, 1, 1), D(2018, 1, 31)), (7, 101, D(2018, 1, 31), D(2018, 2, 1)),
                                  (7, 102, D(2018, 2, 1), D(2018, 2, 28))], "cid bigint, k int, s date, e date")
    out = joins.interval_left_join(acts, cons, "company", "cid", "at", "s", "e", spread_by="k", clip_lo=D(2018, 1, 1))
    got = sorted((r.a, r.k) for r in out.collect())
    assert got == [(1, 100), (1, 101), (2, 101), (3, 101), (3, 102), (4, 102), (5, None), (6, None)]
    assert set(out.columns) == {"a", "company", "at", "k", "s", "e"}


def test_contract_days_inclusive_end_and_calendar_gap(tiny, spark):
    t = tiny(recruiter_company=companies(5), analytical_company_daily_data=[(D(2018, 1, d),) for d in (1, 2, 4, 5, 5)],
             purchase_receipt=[pr(1, 5, D(2017, 12, 30), D(2018, 1, 2), TS(2017, 1, 1)),
                               pr(2, 5, D(2018, 1, 4), D(2018, 1, 4), TS(2017, 1, 1)),
                               pr(3, 5, D(2018, 1, 6), D(2018, 1, 5), TS(2017, 1, 1))])
    con = contracts.main_contracts(t, 1, with_dims=False)
    cal = contracts.calendar(t, D(2018, 1, 1), D(2018, 1, 31))
    got = sorted((r.b_contract_id, r.cal_date.day)
                 for r in contracts.contract_days(con, cal, D(2018, 1, 1), D(2018, 1, 31)).collect())
    assert got == [(1, 1), (1, 2), (2, 4)]


def test_login_days_anti_join(tiny):
    t = tiny(candidate=[(1, TS(2018, 1, 10, 9), TS(2018, 1, 20, 8), "LFT", "M", D(1990, 1, 1), "13"),
                        (2, TS(2018, 1, 10, 9), TS(2018, 1, 20, 8), "ACT", "M", D(1990, 1, 1), "13")],
             candidate_login_history=[(1, TS(2018, 1, 10, 12)), (1, TS(2018, 1, 11, 1)), (1, TS(2018, 1, 11, 9)),
                                      (1, TS(2018, 1, 20, 7)), (2, TS(2018, 1, 20, 7)), (99, TS(2018, 1, 12))])
    got = sorted((r.candidate_id, r.act_date.day) for r in activity.candidate_login_days(t, TS(2018, 1, 1)).collect())
    assert got == [(1, 11), (2, 20)]


def test_scouts_sent_semi_join_and_replies(tiny):
    t = tiny(message_thread=[(1, 7, 5, 100, "CRS", "PSC", "FL", TS(2018, 1, 1, 9), TS(2018, 1, 2)),
                             (1, 7, 5, 101, "CRS", "PSC", "FL", TS(2018, 1, 1, 9), TS(2018, 1, 2)),
                             (2, 8, 5, 100, "CRS", "PSC", "SL", TS(2018, 1, 1, 9), None),
                             (3, 9, 5, 100, "ESS", "MAN", "SL", TS(2018, 1, 1, 9), None)],
             message=[(1, TS(2018, 1, 1, 9), "TRUE"), (1, TS(2018, 1, 1, 9), "TRUE"), (1, TS(2018, 1, 3), "FALSE"),
                      (1, TS(2018, 1, 2), "FALSE"), (2, TS(2018, 1, 1, 10), "TRUE"), (2, TS(2018, 1, 5), "FALSE"),
                      (3, TS(2018, 1, 1, 9), "TRUE")])
    sent = scouts.scouts_sent(t, TS(2017, 12, 1))
    assert sorted((r.message_thread_id, r.attached_job_id) for r in sent.collect()) == [(1, 100), (1, 101)]
    rep = {r._rep_tid: r.reply_tm for r in scouts.first_replies(t, TS(2017, 12, 1)).collect()}
    assert rep == {1: TS(2018, 1, 2), 2: TS(2018, 1, 5)}
    opened = scouts.opened_scouts_with_reply(t, TS(2017, 12, 1)).collect()
    assert [(r.message_thread_id, r.reply_tm) for r in opened] == [(1, TS(2018, 1, 2))]


def test_net_decisions_and_status_events(tiny):
    t = tiny(candidate_progress=[(1, 7, 5, 100, TS(2018, 1, 1), D(2018, 1, 1), "APL", None),
                                 (2, 7, 5, 100, TS(2018, 1, 1), D(2018, 1, 1), "APL", None),
                                 (3, 7, 5, 100, TS(2018, 1, 1), D(2018, 1, 1), "APL", None)],
             candidate_replace=[(11, 1, 7, 100, 500, TS(2018, 2, 1)), (12, 2, 7, 100, 500, TS(2018, 2, 1)),
                                (13, 3, 7, 100, 500, TS(2018, 2, 1))],
             candidate_progress_log=[(1, TS(2018, 3, 1), "HIRNG", "N"), (2, TS(2018, 3, 1), "HIRNG", "Y"),
                                     (3, TS(2018, 1, 5), "ITV__", "N"), (3, TS(2018, 1, 6), "MTADJ", "N"),
                                     (3, TS(2018, 1, 7), "OFFER", "Y")],
             recruiter_company=companies(5), candidate=[(7, None, None, "ACT", "M", None, "13")])
    cp = applications.applications_with_route(t, 1, TS(2017, 1, 1))
    assert sorted(r.cr_id for r in applications.net_decisions(cp, t).collect()) == [12, 13]
    assert sorted(r.cr_id for r in applications.net_decisions(cp, t, require_parents=True).collect()) == [12, 13]
    hs = applications.status_events(cp, t, ("ITV__", "MTADJ")).collect()
    assert sorted(r.status_tm.day for r in hs) == [5, 6]
    assert applications.status_events(cp, t, "OFFER").count() == 0


def test_route_lookup_window_and_fanout(tiny):
    t = tiny(candidate_progress=[(1, 7, 5, 100, TS(2018, 1, 1), D(2018, 1, 1), "PSC", None),
                                 (2, 7, 5, 100, TS(2018, 1, 1), D(2018, 1, 1), "PSC", None)],
             candidate_progress_message_info=[(1, 50), (1, 51), (2, 52)],
             message_thread=[(50, 7, 5, 100, "CRS", "PSC", "FL", TS(2018, 1, 1), None),
                             (51, 7, 5, 100, "CRS", "PSC", "SL", TS(2018, 1, 1), None),
                             (52, 7, 5, 100, "CRS", "PSC", "FL", TS(2016, 1, 1), None)])  # older than window
    cp = applications.applications_with_route(t, 1, TS(2017, 8, 1))
    assert sorted((r.candidate_progress_id, r.route_info) for r in cp.collect()) == \
        [(1, "1_興味があるPS"), (1, "2_その他PS"), (2, "Other")]


def test_applications_without_a_thread_do_not_meet_in_one_task(spark, tiny):
    """No message info, or one without a thread id: such rows have no key to be dealt by, and are most of the table."""
    from collections import Counter

    from pyspark.sql import functions as F
    n = 2_000
    t = tiny(candidate_progress=[(i, 7, 5, 100, TS(2018, 1, 1), D(2018, 1, 1), "PSC" if i % 4 == 0 else "APL", None)
                                 for i in range(n)],
             candidate_progress_message_info=[(i, None if i % 8 else i + 1) for i in range(0, n, 4)] + [(0, None)],
             message_thread=[(i + 1, 7, 5, 100, "CRS", "PSC", "FL", TS(2018, 1, 1), None) for i in range(0, n, 16)])
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        cp = applications.applications_with_route(t, 1, TS(2017, 8, 1))
        tasks = Counter(r[0] for r in cp.select(F.spark_partition_id()).collect())
        labels = Counter(r.route_info for r in cp.collect())
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert len(tasks) == 8 and max(tasks.values()) < n / 4
    # application 0 has two message-info rows; threads of every 16th application are known
    assert sum(labels.values()) == n + 1 and labels["1_興味があるPS"] == 125 and labels["Other"] == 376


def test_company_login_days_max_id(tiny):
    t = tiny(recruiter=[(1, 5), (2, 5), (3, 6)], recruiter_company=companies(5) + companies(6, ctype="ESS"),
             recruiter_login_log=[(10, 1, TS(2018, 1, 1, 9)), (11, 2, TS(2018, 1, 1, 10)), (12, 3, TS(2018, 1, 1)),
                                  (13, 1, TS(2018, 1, 2))])
    got = sorted((r.recruiter_company_id, r.act_date.day, r.act_id)
                 for r in activity.company_login_days(t, TS(2017, 1, 1), "CRS").collect())
    assert got == [(5, 1, 11), (5, 2, 13)]


def test_funnel_counts_distinct(spark):
    df = spark.createDataFrame([(TS(2018, 1, 1), "a", 1), (TS(2018, 1, 2), "a", 1), (TS(2018, 1, 3), "a", 2),
                                (TS(2018, 2, 1), "b", 1)], "act_date timestamp_ntz, act_type string, act_id bigint")
    got = sorted((r.act_month.month, r.act_type, r.n_actions)
                 for r in funnel_counts(df, ["act_type"], "act_id").collect())
    assert got == [(1, "a", 2), (2, "b", 1)]


def test_explode_days_spreads_intervals(spark):
    df = spark.createDataFrame([(i, D(2018, 1, 1), D(2018, 1, 10)) for i in range(70)] + [(99, None, D(2018, 1, 2))],
                               "i int, a date, b date").coalesce(1)
    out = joins.explode_days(df, "a", "b", "d", spread_by="i")
    assert out.rdd.getNumPartitions() == 8          # the session's shuffle partitions
    assert out.count() == 700
    plain = joins.explode_days(df, "a", "b", "d")
    assert plain.rdd.getNumPartitions() == 1 and plain.count() == 700


def test_interval_join_of_a_hot_company_with_far_ends_spreads(spark):
    """One company with 4,000 contracts, many of them ending in 2037: no task generates a large share."""
    from pyspark.sql import functions as F
    cons = spark.range(4000).select(
        F.lit(7).cast("bigint").alias("cid"), F.col("id").alias("k"),
        F.expr("date_add(date'2017-01-01', cast(id % 365 as int))").alias("s"),
        F.expr("if(id % 2 = 0, date'2037-12-31', date'2018-02-01')").alias("e")).coalesce(1)
    acts = spark.createDataFrame([(i, 7, TS(2018, 1 + i % 6, 3)) for i in range(12)], "a int, company bigint, at timestamp_ntz")
    out = joins.interval_left_join(acts, cons, "company", "cid", "at", "s", "e", spread_by="k", clip_lo=D(2018, 1, 1))
    assert out.count() == 2 * 4000 + 10 * 2000
    parts = (cons.repartition(8, "k").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect())
    assert max(r["count"] for r in parts) < 2 * 4000 / 8


def test_write_log_spreads_rows_with_null_first_id(spark):
    from pyspark.sql import functions as F

    from recruitflow.sources import sinks
    df = spark.range(20000).select(F.lit(D(2018, 1, 5)).alias("act_date"), F.lit(None).cast("bigint").alias("candidate_id"),
                                   (F.col("id") % 700).alias("recruiter_company_id"), F.col("id").alias("job_id"))
    out = sinks.ranged(df, "act_date", 8)
    n = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(n) == 8 and max(n) < 2 * 20000 / 8


def test_labelled_status_events(tiny):
    t = tiny(candidate_progress=[(1, 7, 5, 100, TS(2018, 1, 1), D(2018, 1, 1), "APL", None)],
             candidate_progress_log=[(1, TS(2018, 1, 5), "ITV__", "N"), (1, TS(2018, 1, 6), "MTADJ", "N"),
                                     (1, TS(2018, 1, 7), "OFFER", "N"), (1, TS(2018, 1, 8), "OFFER", "Y"),
                                     (1, TS(2017, 1, 7), "OFFER", "N"), (1, TS(2018, 1, 9), "HIRNG", "N")],
             recruiter_company=companies(5))
    cp = applications.applications_with_route(t, 1, TS(2017, 1, 1))
    e = applications.labelled_status_events(cp, t, {"hs": ("ITV__", "MTADJ"), "offer": ("OFFER",)}, TS(2018, 1, 1))
    assert sorted((r.status_label, r.status_tm.day) for r in e.collect()) == [("hs", 5), ("hs", 6), ("offer", 7)]
    with pytest.raises(AssertionError):
        applications.labelled_status_events(cp, t, {"a": ("OFFER",), "b": ("OFFER",)})


def test_apply_cluster_defaults(spark):
    from recruitflow.session import apply_cluster_defaults
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.skewJoin.enabled",
            "spark.sql.requireAllClusterKeysForCoPartition", "spark.sql.files.maxPartitionBytes",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
            "spark.sql.adaptive.enabled", "spark.sql.adaptive.coalescePartitions.enabled")
    old = {k: spark.conf.get(k) for k in keys}
    try:
        apply_cluster_defaults(spark, 100 * 2**40, bucketed_sources=True)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "409600"
        assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
        assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "false"
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
