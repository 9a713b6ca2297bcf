"""Scalar traps: window bounds, channel, route, JSON epoch dates, age, income, score."""
from datetime import date, datetime

from pyspark.sql import functions as F

from recruitflow.functions import codes, exprs
from recruitflow.params import Params


def one(spark, col, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_bounds_jst_vs_utc_at_month_end():
    p = Params(as_of=datetime(2018, 8, 31, 20, 0))  # 05:00 JST on 1 Sep
    assert p.local_bound() == datetime(2017, 8, 1)
    assert p.utc_bound() == datetime(2017, 7, 1)


def test_bounds_same_mid_month():
    p = Params(as_of=datetime(2018, 3, 15, 3, 0))
    assert p.local_bound() == p.utc_bound() == datetime(2017, 2, 1)
    assert Params(as_of=datetime(2018, 1, 10)).local_bound() == datetime(2016, 12, 1)


def test_channel(spark):
    got = one(spark, exprs.channel("c"), [(None,), ("",), ("Organic_x",), ("app_x",), ("x_y",), ("plain",)], "c string")
    assert got == ["Organic", "", "Organic", "Organic", "x", "plain"]


def test_route_info(spark):
    rows = [("SPE", None), ("SCT", None), ("HSC", None), ("APL", None), ("REC", None), ("PSC", "FL"),
            ("PSC", "SL"), ("PSC", None), ("XXX", "FL"), (None, None)]
    got = one(spark, exprs.route_info("r", "c"), rows, "r string, c string")
    assert got == ["公募・特集", "DM", "DM", "通常応募", "レコメンド応募", "1_興味があるPS", "2_その他PS", "Other", "Other", "Other"]
    got = one(spark, exprs.route_info("r", "c", numbered=False), [("PSC", "FL"), ("PSC", "SL")], "r string, c string")
    assert got == ["興味があるPS", "その他PS"]


def test_scout_label_null_is_other(spark):
    assert one(spark, exprs.scout_label("c"), [("FL",), ("SL",), (None,)], "c string") == \
        ["1_興味があるPS", "2_その他PS", "2_その他PS"]


def test_interview_date_boundaries(spark):
    k = codes.INTERVIEW_SET_KEY
    ms_1459 = 1514818799999  # 2018-01-01 14:59:59.999Z -> 23:59:59.999 JST, 1 Jan
    ms_1500 = 1514818800000  # 15:00Z -> 00:00 JST, 2 Jan
    rows = [(f'{{"{k}": {ms_1459}}}',), (f'{{"{k}": {ms_1500}}}',), (f'{{"{k}": ""}}',), ('{"x": 1}',), (None,),
            ("{not json",), (f'{{"{k}": "abc"}}',)]
    got = one(spark, exprs.interview_set_date("j", "Asia/Tokyo"), rows, "j string")
    assert got == [date(2018, 1, 1), date(2018, 1, 2), None, None, None, None, None]
    has = one(spark, exprs.has_interview_set("j"), rows, "j string")
    assert has == [True, True, False, None, None, None, True]


def test_local_time_keeps_ntz(spark):
    df = spark.createDataFrame([(datetime(2018, 1, 31, 16, 0),)], "t timestamp_ntz")
    r = df.select(exprs.local_time("t", "Asia/Tokyo").alias("x")).collect()[0].x
    assert r == datetime(2018, 2, 1, 1, 0)


def test_age_birthday_and_leap_year(spark):
    today = date(2018, 3, 1)
    rows = [(date(1990, 3, 1),), (date(1990, 3, 2),), (date(1992, 2, 29),), (date(1990, 12, 31),)]
    got = one(spark, exprs.age("b", today), rows, "b date")
    # day-of-year comparison, as defined (1992-02-29 is day 60 = 2018-03-01's day 60)
    assert got == [28, 27, 26, 27]


def test_text_length_nulls_count_as_empty(spark):
    got = one(spark, exprs.text_length("a", "b"), [("ab", None), (None, None), ("x", "yz")], "a string, b string")
    assert got == [2, 0, 3]


def test_income_range_and_median(spark):
    df = spark.createDataFrame([(4567890, 8000000), (None, 100), (3000000, None)], "lo bigint, hi bigint")
    r = df.select(exprs.income_range("lo", "hi").alias("r"), exprs.income_median("lo", "hi").alias("m")).collect()
    assert r[0].r == "456万円-800万円" and float(r[0].m) == 6283945.0
    assert r[1].r is None and r[1].m is None and r[2].r is None


def test_sales_score_arms(spark):
    rows = [(None, "REP", None, None, "Y"), (10, "REP", None, None, "Y"), (10, "OFF", "RDC", 1, "Y"),
            (10, "OFF", "BOR", 1, "Y"), (10, "BOR", None, 1, "Y"), (10, "BOR", None, None, "Y"),
            (10, "RDC", None, None, "N"), (10, "RDC", None, None, "Y"), (10, "OTH", None, None, "Y")]
    df = spark.createDataFrame(rows, "price bigint, kind string, prev string, pid bigint, en string")
    got = [r[0] for r in df.select(exprs.sales_score(F.col("price"), F.col("kind"), F.col("prev"), F.col("pid"))).collect()]
    assert got == [0, 1, 0, -1, 1, 0, 0, 0, 0]


def test_plan_change_regex_matches_without_last_char(spark):
    rows = [(None,), ("ご利用プラン変更",), ("ご利用プラ",), ("通常",)]
    df = spark.createDataFrame(rows, "r string").where(~F.col("r").rlike(codes.PLAN_CHANGE_REMARKS))
    assert [r.r for r in df.collect()] == ["通常"]
