"""Stand-in recruiting tables derived from the TPC-H-style test tables.

The test data has no recruiting tables, so each of the 35 sources is
derived here, with Spark, from ``customer part orders lineitem events
nation``.  Every derived table grows with the inputs (no fixed rows, no
sampling).  The DuckDB oracle derives the very same tables with SQL (see
``oracle.standin_sql``); both sides must stay in step.

Mapping (entity <- test table):
  company, candidate, recruiter     <- customer
  job                               <- part (company from the part key)
  application, scout thread         <- orders (+ its lines)
  status log, messages, job log     <- lineitem
  logins, clicks, footprints        <- events, shifted back 23 years
  contracts, calendar, sales        <- orders
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recruitflow.sources.tables import SOURCE_SCHEMAS, Tables

EVENT_SHIFT = "INTERVAL 23 YEARS"
BASE_TABLES = ("customer", "part", "orders", "lineitem", "events", "nation")


def _hours(n: Column) -> Column:
    return F.make_dt_interval(hours=n.cast("int"))


def _days(n: int) -> Column:
    return F.make_dt_interval(days=F.lit(n))


def _digit(c: str) -> Column:
    return F.substring(F.col(c), 1, 1)


def _company(job: str = "p_partkey") -> Column:
    """The company of a job: two jobs each, so companies grow with the jobs."""
    return F.floor(F.col(job) / 2).cast("bigint") + 1


def _fit(df: DataFrame, name: str) -> DataFrame:
    schema = SOURCE_SCHEMAS[name]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def build(base: dict[str, DataFrame]) -> Tables:
    """Derive the 35 sources from the base test tables (lazy plans)."""
    cu, pa, o, li, ev, na = (base[n] for n in BASE_TABLES)
    ev = ev.withColumn("ts2", F.col("ts") - F.expr(EVENT_SHIFT)).withColumn(
        "k", F.get_json_object("props", "$.k").cast("bigint"))
    t: dict[str, DataFrame] = {}

    # ---------------------------------------------------------- companies / dims
    t["recruiter_company"] = cu.select(
        F.col("c_custkey").alias("recruiter_company_id"), F.col("c_name").alias("company_name"),
        F.when(F.col("c_mktsegment") == "BUILDING", "ESS").otherwise("CRS").alias("company_type_cd"),
        F.col("c_nationkey").cast("string").alias("area_cd"), F.col("c_mktsegment").alias("business_type_cd"))
    t["mst_area"] = na.select(F.col("n_nationkey").cast("string").alias("mst_area_cd"), F.col("n_name").alias("area_name"))
    codes = (cu.select(F.col("c_mktsegment").alias("code")).distinct()
             .unionAll(pa.where(F.col("p_type") != "STANDARD").select(F.col("p_type").alias("code")).distinct()))
    grp = F.col("code")
    t["mst_business_type"] = codes.select(
        grp.alias("business_type_cd"),
        F.when(grp == "AUTOMOBILE", "IA").when(grp == "FURNITURE", "IB").when(grp == "MACHINERY", "IC")
        .when(grp == "HOUSEHOLD", "ID").when(grp == "ECONOMY", "IE").when(grp == "BUILDING", "IF")
        .when(grp == "SMALL", "IG").when(grp == "MEDIUM", "IH").when(grp == "LARGE", "IZ")
        .alias("business_type_group_cd"),
        F.lower(grp).alias("business_type_name"))
    noun = F.split_part(F.col("p_name"), F.lit(" "), F.lit(2))
    nouns = pa.select(noun.alias("noun")).distinct().where(F.col("noun") != "bolt")
    n = F.col("noun")
    t["mst_job_type"] = nouns.select(
        n.alias("job_type_cd"),
        F.when(n == "gear", "JA").when(n == "gizmo", "JB").when(n == "widget", "JC").when(n == "plate", "JD")
        .when(n == "rod", "JE").when(n == "anvil", "JL").otherwise("JZ").alias("job_group_type_cd"),
        F.concat(F.lit("job "), n).alias("job_type_name"))

    # ---------------------------------------------------------- jobs
    t["job"] = pa.select(
        F.col("p_partkey").alias("job_id"), _company().alias("recruiter_company_id"),
        F.col("p_name").alias("job_name"),
        F.date_add(F.lit(date(2000, 1, 1)), F.col("p_size") * 7).cast("timestamp_ntz").alias("publish_start_tm"),
        F.col("p_brand").alias("job_publish_type_cd"), noun.alias("job_type_cd"),
        F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)).alias("employment_type_cd"),
        (F.col("p_size").cast("bigint") * 100000).alias("income_lower"),
        F.when(F.col("p_type") == "PROMO", F.lit(None).cast("bigint"))
        .otherwise(F.col("p_size").cast("bigint") * 100000 + F.floor("p_retailprice").cast("bigint") * 1000)
        .alias("income_upper"),
        F.col("p_size").cast("string").alias("main_area_cd"))
    t["job_business_type"] = pa.select(
        F.col("p_partkey").alias("job_id"), F.lit(1).alias("display_no"), F.col("p_type").alias("business_type_cd")
    ).unionAll(pa.where(F.col("p_type") == "LARGE").select(
        F.col("p_partkey").alias("job_id"), F.lit(2).alias("display_no"), F.lit("AUTOMOBILE").alias("business_type_cd")))
    t["job_company"] = pa.where(F.col("p_type") == "PROMO").select(
        F.col("p_partkey").alias("job_id"), F.col("p_brand").alias("company_name"))
    t["job_admin_info"] = pa.select((F.col("p_partkey") * 10).alias("job_admin_info_id"), F.col("p_partkey").alias("job_id"))
    line_ts = F.col("l_shipdate") + _hours(F.col("l_linenumber"))
    t["job_status_change_log"] = li.select(
        (F.col("l_partkey") * 10).alias("job_admin_info_id"),
        F.when((F.col("l_linestatus") == "O") & (F.col("l_shipdate") >= F.lit("2000-06-01 00:00:00").cast("timestamp_ntz")),
               "PUB").otherwise("CLS").alias("job_status_cd"),
        line_ts.alias("ins_datetime"))
    t["job_segment_info"] = li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("job_segment_id"), F.col("l_partkey").alias("job_id"),
        F.when(F.col("l_returnflag") == "N", "S").otherwise("M").alias("scout_type_cd"),
        F.when(F.col("l_linestatus") == "F", "SND").otherwise("STP").alias("job_segment_status_cd"),
        line_ts.alias("ins_datetime"))

    # ---------------------------------------------------------- applications
    # the least company is that of the least job; with one aggregate every reader plans the same shuffle
    order_job = (li.join(pa.select("p_partkey"), li.l_partkey == pa.p_partkey)
                 .groupBy("l_orderkey").agg(F.min("l_partkey").alias("job_id"))
                 .withColumn("company_id", _company("job_id")))
    ojo = o.join(order_job, o.o_orderkey == order_job.l_orderkey, "left")
    pr = _digit("o_orderpriority")
    st = F.col("o_orderstatus")
    route = (F.when(pr == "1", "SPE")
             .when(pr == "2", F.when(st == "F", "SCT").otherwise("HSC"))
             .when(pr == "3", "PSC")
             .when(pr == "4", F.when(st == "P", "REC").otherwise("APL"))
             .otherwise(F.when(st == "F", F.lit(None).cast("string")).otherwise("PSC")))
    epoch_day = F.unix_date(F.to_date("o_orderdate")).cast("bigint")
    ms = epoch_day * 86400000 + (F.col("o_orderkey") % 97) * 900000
    js = (F.when(st == "F", F.concat(F.lit('{"firstInterviewSetTime": '), ms.cast("string"), F.lit("}")))
          .when(st == "O", F.lit('{"firstInterviewSetTime": ""}'))
          .when(pr == "1", F.lit(None).cast("string"))
          .otherwise(F.lit('{"other": 1}')))
    cp = ojo.select(
        F.col("o_orderkey").alias("candidate_progress_id"), F.col("o_custkey").alias("candidate_id"),
        F.col("company_id").alias("recruiter_company_id"), F.col("job_id"),
        (F.col("o_orderdate") + _hours(F.col("o_orderkey") % 24)).alias("ins_datetime"),
        F.date_sub(F.to_date("o_orderdate"), F.col("o_orderkey").cast("int") % 3).alias("apply_date"), route.alias("application_route_type_cd"),
        js.alias("candidate_progress_data_json"), F.col("o_orderpriority"))
    t["candidate_progress"] = cp
    psc = cp.where(F.col("application_route_type_cd") == "PSC")
    t["candidate_progress_message_info"] = psc.select(
        "candidate_progress_id", F.col("candidate_progress_id").alias("message_thread_id")
    ).unionAll(psc.where(F.col("o_orderpriority") == "5-LOW").select(
        "candidate_progress_id", (F.col("candidate_progress_id") + 1).alias("message_thread_id")))
    t["candidate_progress_log"] = li.select(
        F.col("l_orderkey").alias("candidate_progress_id"), line_ts.alias("ins_datetime"),
        F.when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"), "ITV__")
        .when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O"), "MTADJ")
        .when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"), "OFFER")
        .when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), "HIRNG")
        .when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"), "ITV__")
        .otherwise("REJCT").alias("candidate_progress_status_cd"),
        F.when(F.col("l_discount") >= 0.09, "Y").otherwise("N").alias("del_flg"))
    t["candidate_replace"] = ojo.where(st == "F").select(
        (F.col("o_orderkey") * 3 + 1).alias("candidate_replace_id"), F.col("o_orderkey").alias("candidate_progress_id"),
        (F.col("o_custkey") + 1).alias("candidate_id"), (F.col("job_id") + 1).alias("job_id"),
        F.floor("o_totalprice").cast("bigint").alias("income"),
        (F.col("o_orderdate") + _days(30) + _hours(F.col("o_orderkey") % 24)).alias("ins_datetime"))

    # ---------------------------------------------------------- scout threads / messages
    sent = F.col("o_orderdate") - F.expr("INTERVAL 158 HOURS")
    thread_base = o.join(order_job, o.o_orderkey == order_job.l_orderkey, "left").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderdate",
        F.col("company_id"))
    lines = li.select(F.col("l_orderkey").alias("lk"), "l_partkey")
    th = (thread_base.join(lines, thread_base.o_orderkey == lines.lk)
          .join(t["recruiter_company"].select("recruiter_company_id", "company_type_cd"),
                F.col("company_id") == F.col("recruiter_company_id"), "left"))
    t["message_thread"] = th.select(
        F.col("o_orderkey").alias("message_thread_id"), F.col("o_custkey").alias("candidate_id"),
        F.col("company_id").alias("recruiter_company_id"), F.col("l_partkey").alias("attached_job_id"),
        F.col("company_type_cd"),
        F.when(st.isin("F", "O"), "PSC").otherwise("MAN").alias("create_trigger_type_cd"),
        F.when(pr == "1", F.lit(None).cast("string")).when(pr.isin("2", "3"), "FL").otherwise("SL").alias("scout_s_class"),
        sent.alias("scout_sent_tm"),
        F.when(F.col("o_totalprice") > 100000, sent + _days(1)).alias("cn_scout_first_view_tm"))
    lo_ = li.join(o.select("o_orderkey", "o_orderdate"), li.l_orderkey == o.o_orderkey)
    t["message"] = lo_.select(
        F.col("l_orderkey").alias("message_thread_id"),
        (sent + _hours((F.col("l_linenumber") - 1) * 6)).alias("sent_tm"),
        F.when((F.col("l_linenumber") == 1) | (F.col("l_returnflag") == "A"), "TRUE").otherwise("FALSE")
        .alias("from_recruiter"))

    # ---------------------------------------------------------- candidates
    reg = ev.groupBy("user_id").agg(F.min("ts2").alias("first_ts"), F.max("ts2").alias("last_ts"))
    cr = cu.join(reg, cu.c_custkey == reg.user_id, "left")
    t["candidate"] = cr.select(
        F.col("c_custkey").alias("candidate_id"), F.col("first_ts").alias("ins_datetime"),
        F.col("last_ts").alias("upd_datetime"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", "LFT").otherwise("ACT").alias("candidate_status_cd"),
        F.when(F.col("c_acctbal") >= 5000, "M").otherwise("F").alias("gender_cd"),
        F.date_add(F.lit(date(1950, 1, 1)), F.floor(F.abs(F.col("c_acctbal")) * 2).cast("int")).alias("birth_date"),
        F.col("c_nationkey").cast("string").alias("area_cd"))
    seg, nk = F.col("c_mktsegment"), F.col("c_nationkey").cast("string")
    t["candidate_personal_info"] = cu.select(
        F.col("c_custkey").alias("candidate_id"),
        F.when(seg == "AUTOMOBILE", F.lit(None).cast("string"))
        .when(seg == "BUILDING", F.concat(F.lit("Organic_"), nk))
        .when(seg == "FURNITURE", F.lit("app_ios"))
        .when(seg == "HOUSEHOLD", F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(F.concat(F.lit("ads_"), nk)))
        .otherwise(F.lit("referral")).alias("tracking_code"))
    t["candidate_rating"] = cu.where(F.col("c_acctbal") > 0).select(
        F.col("c_custkey").alias("candidate_id"), F.substring("c_mktsegment", 1, 1).alias("candidate_rank_cd"))
    rs = cu.where(F.col("c_acctbal") >= 0)
    rid = (F.col("c_custkey") * 2).alias("resume_id")
    t["resume"] = rs.select(
        rid, F.col("c_custkey").alias("candidate_id"),
        F.concat(F.lit("E"), F.right(F.col("c_name"), F.lit(1))).alias("education_bg_cd"),
        F.substring("c_mktsegment", 1, 2).alias("income_cd"),
        F.substring("c_mktsegment", 1, 3).alias("job_change_duration_cd"),
        F.floor(F.col("c_acctbal") / 10).cast("int").alias("toeic_score"),
        (F.col("c_nationkey") * 4).cast("int").alias("toefl_score"),
        F.length("c_mktsegment").cast("int").alias("company_count"))
    second = rs.where(F.col("c_nationkey") % 5 == 0)  # some candidates have a second resume
    t["resume"] = t["resume"].unionAll(second.select(
        F.col("c_custkey") * 2 + 1, F.col("c_custkey"), F.lit("E9"), F.substring("c_mktsegment", 1, 2),
        F.lit("LTR"), F.lit(0), F.lit(1), F.lit(2)))
    edu = cu.select(F.concat(F.lit("E"), F.right(F.col("c_name"), F.lit(1))).alias("education_bg_cd")).distinct()
    t["cls_education_bg"] = edu.where(F.col("education_bg_cd") != "E9").select(
        "education_bg_cd", F.concat(F.lit("edu "), F.col("education_bg_cd")).alias("code_alias"))
    inc = cu.select(F.substring("c_mktsegment", 1, 2).alias("income_cd")).distinct()
    t["cls_income"] = inc.select("income_cd", F.concat(F.lit("inc "), F.col("income_cd")).alias("code_alias"))
    school = F.when(st == "F", 1).when(st == "O", 2).otherwise(3).cast("bigint")
    t["resume_education_background"] = o.where(pr.isin("1", "2")).select(
        (F.col("o_custkey") * 2).alias("resume_id"), st.alias("education_bg_cd"),
        F.concat(F.lit("school "), st).alias("education_name"),
        F.when(st == "F", 2001).otherwise(2005).cast("int").alias("graduation_year"),
        F.lit("GEN").alias("course_type_cd"), school.alias("school_master_id"), F.lit("N").alias("drop_flg"),
        F.when(st == "O", "Y").otherwise("N").alias("expected_flg"),
        F.when(pr == "1", "1").otherwise("2").alias("display_no"))
    t["mst_school_info"] = o.select(school.alias("mst_school_info_id")).distinct().where(
        F.col("mst_school_info_id") < 3).select(
        "mst_school_info_id", F.concat(F.lit("S"), F.col("mst_school_info_id").cast("string")).alias("school_rank_cd"))
    t["resume_company"] = rs.where(F.col("c_nationkey") < 20).select(
        rid, F.lit("1").alias("display_no"), F.col("c_mktsegment").alias("company_business"),
        F.when(F.col("c_acctbal") > 5000, F.col("c_name")).alias("business_content"),
        F.lit(None).cast("string").alias("appeal_point"),
        F.when(F.col("c_nationkey") < 5, F.concat(F.lit("free "), F.col("c_name"))).alias("free_text")
    ).unionAll(rs.where(F.col("c_nationkey") == 0).select(
        rid, F.lit("2").alias("display_no"), F.lit("second").alias("company_business"),
        F.lit(None).cast("string").alias("business_content"), F.lit(None).cast("string").alias("appeal_point"),
        F.lit(None).cast("string").alias("free_text")))
    t["resume_business"] = rs.select(rid, F.lit("1").alias("display_no"), seg.alias("resume_business_type_cd"))
    nkey = F.col("c_nationkey")
    t["resume_job"] = rs.select(
        rid, F.lit("1").alias("display_no"),
        F.when(nkey < 5, "gear").when(nkey < 10, "widget").when(nkey < 15, "rod").when(nkey < 20, "ring")
        .otherwise("bolt").alias("resume_job_type_cd"))

    # ---------------------------------------------------------- events
    t["candidate_login_history"] = ev.where(F.col("event_type") == "view").select(
        F.col("user_id").alias("cid"), F.col("ts2").alias("login_tm"))
    t["recruiter_correspond_data"] = ev.where(F.col("event_type").isin("click", "purchase")).select(
        F.col("event_id").alias("id"), F.col("user_id").alias("candidate_id"),
        F.floor("value").cast("bigint").alias("recruiter_company_id"), F.col("k").alias("job_id"),
        F.col("ts2").alias("conversion_tm"),
        F.when(F.col("event_type") == "click", "FLW").otherwise("APL").alias("conversion_type_cd"),
        F.when(F.col("value") >= 100, "Y").otherwise("N").alias("recruiter_done_flg"),
        F.when(F.col("value") >= 200, "Y").otherwise("N").alias("recruiter_scout_flg"))
    t["recruiter_login_log"] = ev.where(F.col("event_type") == "signup").select(
        F.col("event_id").alias("recruiter_login_log_id"), F.col("user_id").alias("recruiter_id"),
        F.col("ts2").alias("login_tm"))
    t["recruiter"] = cu.select(F.col("c_custkey").alias("recruiter_id"),
                               (F.col("c_custkey") * 2).alias("recruiter_company_id"))
    t["footprint"] = ev.where(F.col("event_type") == "error").select(
        F.col("event_id").alias("footprint_key"), F.floor("value").cast("bigint").alias("company_id"),
        F.col("k").alias("job_id"), F.col("ts2").alias("upd_datetime"))

    # ---------------------------------------------------------- contracts / calendar / sales
    od = F.to_date("o_orderdate")
    t["purchase_receipt"] = o.select(
        F.col("o_orderkey").alias("purchase_receipt_id"), F.col("o_custkey").alias("recruiter_company_id"),
        pr.alias("product_cd"), F.col("o_orderpriority").alias("product_name"),
        F.when(st == "P", "OPT").otherwise("MAI").alias("product_category_cd"),
        F.when(F.col("o_totalprice") < 20000, "Y").otherwise("N").alias("del_flg"),
        F.when((F.col("o_orderpriority") == "5-LOW") & (st == "O"), F.lit(None).cast("date")).otherwise(od)
        .alias("valid_from_date"),
        F.date_add(od, pr.cast("int") * 30).alias("valid_to_date"),
        F.when((F.col("o_orderpriority") == "4-NOT SPECIFIED") & (st == "O"), F.lit(None).cast("timestamp_ntz"))
        .otherwise(F.col("o_orderdate")).alias("ins_datetime"),
        (F.col("o_orderdate") + _days(1)).alias("upd_datetime"))
    t["analytical_company_daily_data"] = o.select(od.alias("target_date"))
    price = F.col("o_totalprice")
    t["hassei_sales"] = o.select(
        F.col("o_orderkey").alias("hassei_sales_id"),
        F.when((pr == "1") | (price > 300000), F.lit(None).cast("bigint")).otherwise(F.col("o_orderkey") - 1)
        .alias("previous_id"),
        F.col("o_orderkey").alias("sales_product_id"),
        F.when(pr == "1", "REP").when(pr == "2", "OFF").when(pr == "3", "BOR").when(pr == "4", "RDC")
        .otherwise("OTH").alias("sales_product_type_cd"),
        F.when(price < 50000, F.lit(None).cast("bigint")).otherwise(F.floor(price).cast("bigint")).alias("sales_price"),
        F.when(price < 150000, "N").otherwise("Y").alias("sales_enable_flg"),
        F.when(st == "F", F.when(price < 100000, "ご利用プラン変更").when(price < 200000, "ご利用プラ")
               .when(price < 300000, F.lit(None).cast("string")).otherwise("standard"))
        .otherwise("standard").alias("sales_remarks"),
        F.date_add(od, 40).alias("hassei_date"))

    return Tables({name: _fit(df, name) for name, df in t.items()})


# Wall-clock timestamp columns of the test tables (kept as TIMESTAMP_NTZ whatever the
# session's Parquet inference setting is).
_NTZ_COLUMNS = {"orders": ("o_orderdate",), "lineitem": ("l_shipdate",), "events": ("ts",)}


def load_base(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Read the base test tables (timestamps pinned to TIMESTAMP_NTZ)."""
    out = {}
    for n in BASE_TABLES:
        df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet")
        for c in _NTZ_COLUMNS.get(n, ()):
            if dict(df.dtypes)[c] != "timestamp_ntz":
                df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
        out[n] = df
    return out


def standin_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """All 35 recruiting sources as lazy plans over the test tables in ``sf_dir``."""
    return build(load_base(spark, sf_dir))


def write_standins(spark: SparkSession, sf_dir: str, out_dir: str) -> Tables:
    """Materialise the 35 stand-in tables as Parquet under ``out_dir`` and
    return them read back with their declared schemas (the production
    shape of the sources: stored tables, scanned with pushdown)."""
    t = standin_tables(spark, sf_dir)
    for name, df in t.items():
        df.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/{name}")
    return Tables.from_parquet(spark, out_dir)
