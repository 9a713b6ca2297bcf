"""The 35 source tables: declared schemas and a loader.

A ``Tables`` object is a mapping ``name -> DataFrame``.  Production use
reads one Parquet dataset per table with the declared schema (no schema
inference, so column pruning and filter pushdown reach the scan).
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recruitflow.functions import exprs

B, S, TS, D, I = T.LongType(), T.StringType(), T.TimestampNTZType(), T.DateType(), T.IntegerType()


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


SOURCE_SCHEMAS: dict[str, T.StructType] = {
    "candidate": _schema(("candidate_id", B), ("ins_datetime", TS), ("upd_datetime", TS), ("candidate_status_cd", S),
                         ("gender_cd", S), ("birth_date", D), ("area_cd", S)),
    "candidate_personal_info": _schema(("candidate_id", B), ("tracking_code", S)),
    "candidate_login_history": _schema(("cid", B), ("login_tm", TS)),
    "candidate_progress": _schema(("candidate_progress_id", B), ("candidate_id", B), ("recruiter_company_id", B),
                                  ("job_id", B), ("ins_datetime", TS), ("apply_date", D),
                                  ("application_route_type_cd", S), ("candidate_progress_data_json", S)),
    "candidate_progress_message_info": _schema(("candidate_progress_id", B), ("message_thread_id", B)),
    "message_thread": _schema(("message_thread_id", B), ("candidate_id", B), ("recruiter_company_id", B),
                              ("attached_job_id", B), ("company_type_cd", S), ("create_trigger_type_cd", S),
                              ("scout_s_class", S), ("scout_sent_tm", TS), ("cn_scout_first_view_tm", TS)),
    "message": _schema(("message_thread_id", B), ("sent_tm", TS), ("from_recruiter", S)),
    "recruiter_correspond_data": _schema(("id", B), ("candidate_id", B), ("recruiter_company_id", B), ("job_id", B),
                                         ("conversion_tm", TS), ("conversion_type_cd", S),
                                         ("recruiter_done_flg", S), ("recruiter_scout_flg", S)),
    "candidate_progress_log": _schema(("candidate_progress_id", B), ("ins_datetime", TS),
                                      ("candidate_progress_status_cd", S), ("del_flg", S)),
    "candidate_replace": _schema(("candidate_replace_id", B), ("candidate_progress_id", B), ("candidate_id", B),
                                 ("job_id", B), ("income", B), ("ins_datetime", TS)),
    "candidate_rating": _schema(("candidate_id", B), ("candidate_rank_cd", S)),
    "mst_area": _schema(("mst_area_cd", S), ("area_name", S)),
    "resume": _schema(("resume_id", B), ("candidate_id", B), ("education_bg_cd", S), ("income_cd", S),
                      ("job_change_duration_cd", S), ("toeic_score", I), ("toefl_score", I), ("company_count", I)),
    "cls_education_bg": _schema(("education_bg_cd", S), ("code_alias", S)),
    "cls_income": _schema(("income_cd", S), ("code_alias", S)),
    "resume_education_background": _schema(("resume_id", B), ("education_bg_cd", S), ("education_name", S),
                                           ("graduation_year", I), ("course_type_cd", S), ("school_master_id", B),
                                           ("drop_flg", S), ("expected_flg", S), ("display_no", S)),
    "mst_school_info": _schema(("mst_school_info_id", B), ("school_rank_cd", S)),
    "resume_company": _schema(("resume_id", B), ("display_no", S), ("company_business", S),
                              ("business_content", S), ("appeal_point", S), ("free_text", S)),
    "resume_business": _schema(("resume_id", B), ("display_no", S), ("resume_business_type_cd", S)),
    "mst_business_type": _schema(("business_type_cd", S), ("business_type_group_cd", S), ("business_type_name", S)),
    "resume_job": _schema(("resume_id", B), ("display_no", S), ("resume_job_type_cd", S)),
    "mst_job_type": _schema(("job_type_cd", S), ("job_group_type_cd", S), ("job_type_name", S)),
    "purchase_receipt": _schema(("purchase_receipt_id", B), ("recruiter_company_id", B), ("product_cd", S),
                                ("product_name", S), ("product_category_cd", S), ("del_flg", S),
                                ("valid_from_date", D), ("valid_to_date", D), ("ins_datetime", TS),
                                ("upd_datetime", TS)),
    "recruiter_company": _schema(("recruiter_company_id", B), ("company_name", S), ("company_type_cd", S),
                                 ("area_cd", S), ("business_type_cd", S)),
    "analytical_company_daily_data": _schema(("target_date", D)),
    "job": _schema(("job_id", B), ("recruiter_company_id", B), ("job_name", S), ("publish_start_tm", TS),
                   ("job_publish_type_cd", S), ("job_type_cd", S), ("employment_type_cd", S),
                   ("income_lower", B), ("income_upper", B), ("main_area_cd", S)),
    "job_admin_info": _schema(("job_admin_info_id", B), ("job_id", B)),
    "job_status_change_log": _schema(("job_admin_info_id", B), ("job_status_cd", S), ("ins_datetime", TS)),
    "job_segment_info": _schema(("job_segment_id", B), ("job_id", B), ("scout_type_cd", S),
                                ("job_segment_status_cd", S), ("ins_datetime", TS)),
    "recruiter_login_log": _schema(("recruiter_login_log_id", B), ("recruiter_id", B), ("login_tm", TS)),
    "recruiter": _schema(("recruiter_id", B), ("recruiter_company_id", B)),
    "footprint": _schema(("footprint_key", B), ("company_id", B), ("job_id", B), ("upd_datetime", TS)),
    "hassei_sales": _schema(("hassei_sales_id", B), ("previous_id", B), ("sales_product_id", B),
                            ("sales_product_type_cd", S), ("sales_price", B), ("sales_enable_flg", S),
                            ("sales_remarks", S), ("hassei_date", D)),
    "job_business_type": _schema(("job_id", B), ("display_no", I), ("business_type_cd", S)),
    "job_company": _schema(("job_id", B), ("company_name", S)),
}


#: Event time of the sources that grow by the day: what reports window on, and what a layout by month follows.
EVENT_TIMES: dict[str, str] = {
    "candidate_login_history": "login_tm",
    "candidate_progress": "ins_datetime",
    "candidate_progress_log": "ins_datetime",
    "candidate_replace": "ins_datetime",
    "footprint": "upd_datetime",
    "job_segment_info": "ins_datetime",
    "message": "sent_tm",
    "message_thread": "scout_sent_tm",
    "recruiter_correspond_data": "conversion_tm",
    "recruiter_login_log": "login_tm",
}
#: Partition column of that layout: the first day of the event's month.
EVENT_MONTH = "event_month"


class Tables(Mapping[str, DataFrame]):
    """Read-only mapping of source name -> DataFrame (attribute access too).

    ``by_month``: sources with an additional ``EVENT_MONTH`` column that
    they are partitioned by; as members of the mapping they come without it.
    """

    def __init__(self, frames: Mapping[str, DataFrame], by_month: Mapping[str, DataFrame] | None = None):
        self._by_month = dict(by_month or {})
        self._frames = {**frames, **{n: df.drop(EVENT_MONTH) for n, df in self._by_month.items()}}
        missing = set(SOURCE_SCHEMAS) - set(self._frames)
        if missing:
            raise KeyError(f"missing source tables: {sorted(missing)}")

    def __getitem__(self, name: str) -> DataFrame:
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        try:
            return self._frames[name]
        except KeyError as e:
            raise AttributeError(name) from e

    def __iter__(self):
        return iter(self._frames)

    def __len__(self) -> int:
        return len(self._frames)

    def since(self, name: str, column: str, bound: datetime | date) -> DataFrame:
        """Rows of a source with ``column`` at or after ``bound``.

        Spark derives no partition predicate from a filter on a timestamp;
        where the source is laid out by the month of ``column``, the bound's
        month prunes its partitions too.
        """
        rows = self._frames[name]
        if name in self._by_month and EVENT_TIMES[name] == column:
            month = date(bound.year, bound.month, 1)
            rows = self._by_month[name].where(F.col(EVENT_MONTH) >= F.lit(month)).drop(EVENT_MONTH)
        return rows.where(F.col(column) >= exprs.ntz_bound(bound))

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str) -> "Tables":
        """One Parquet dataset per table under ``root/<name>``, declared schema."""
        return cls({n: spark.read.schema(s).parquet(f"{root.rstrip('/')}/{n}") for n, s in SOURCE_SCHEMAS.items()})

    @classmethod
    def from_months(cls, spark: SparkSession, root: str) -> "Tables":
        """As ``from_parquet``, the sources of ``EVENT_TIMES`` partitioned by month (``layout.write_by_month``)."""
        month = T.StructField(EVENT_MONTH, D)
        read = {n: spark.read.schema(T.StructType([*s.fields, month]) if n in EVENT_TIMES else s)
                .parquet(f"{root.rstrip('/')}/{n}") for n, s in SOURCE_SCHEMAS.items()}
        return cls({n: df for n, df in read.items() if n not in EVENT_TIMES},
                   {n: df for n, df in read.items() if n in EVENT_TIMES})

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str | None = None) -> "Tables":
        """Tables of the session catalog (optionally in ``database``), cast to the declared types."""
        prefix = f"{database}." if database else ""
        return cls({n: spark.table(prefix + n) for n in SOURCE_SCHEMAS}).conformed()

    def conformed(self) -> "Tables":
        """Select and cast every table to its declared schema."""
        out = {}
        for n, s in SOURCE_SCHEMAS.items():
            out[n] = self._frames[n].select(*[self._frames[n][f.name].cast(f.dataType).alias(f.name) for f in s.fields])
        return Tables(out)
