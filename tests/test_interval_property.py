"""Property test: the as-of interval join equals a brute-force evaluation."""
from datetime import date, datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from recruitflow.operators.joins import interval_left_join

BASE = date(2018, 1, 1)
day = st.integers(min_value=0, max_value=100)
maybe_day = st.one_of(st.none(), day)
contract = st.tuples(st.integers(0, 3), maybe_day, maybe_day)
action = st.tuples(st.one_of(st.none(), st.integers(0, 3)), day, st.sampled_from([0, 5, 23]))


def d(n):
    return None if n is None else BASE + timedelta(days=n)


def brute(acts, cons):
    out = []
    for i, (k, dd, h) in enumerate(acts):
        at = datetime.combine(d(dd), datetime.min.time()) + timedelta(hours=h)
        hits = [j for j, (ck, s, e) in enumerate(cons)
                if k is not None and ck == k and s is not None and e is not None
                and datetime.combine(d(s), datetime.min.time()) <= at <= datetime.combine(d(e), datetime.min.time())]
        out += [(i, j) for j in hits] or [(i, None)]
    return sorted(out, key=lambda x: (x[0], -1 if x[1] is None else x[1]))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(acts=st.lists(action, min_size=1, max_size=12), cons=st.lists(contract, max_size=8))
def test_interval_join_matches_brute_force(spark, acts, cons):
    a = spark.createDataFrame(
        [(i, k, datetime.combine(d(dd), datetime.min.time()) + timedelta(hours=h)) for i, (k, dd, h) in enumerate(acts)],
        "i int, k bigint, at timestamp_ntz")
    c = spark.createDataFrame([(j, k, d(s), d(e)) for j, (k, s, e) in enumerate(cons)],
                              "j int, ck bigint, s date, e date")
    got = interval_left_join(a, c, "k", "ck", "at", "s", "e", spread_by="j", clip_lo=BASE)
    rows = sorted(((r.i, r.j) for r in got.collect()), key=lambda x: (x[0], -1 if x[1] is None else x[1]))
    assert rows == brute(acts, cons)
