"""Source layouts: buckets for co-located joins, months for pruned windows.

Buckets: large sources are written once with ``bucketBy`` on the key their joins
and aggregates use (sorted within buckets); read back through the
catalog, Spark knows their partitioning, so a join or aggregate on the
bucket key of two tables with the same bucket count needs no exchange,
e.g. first replies (message by thread), opened scouts with reply
(thread ⋈ first reply) and login days (logins reduced per candidate-day,
semi-joined to candidates).

Months: the sources with an event time are partitioned by its month, and
``Tables.since`` gives every window's bound to the partition column too, so
a report over 13 months lists and reads the files of 13 months.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from recruitflow.sources.tables import EVENT_MONTH, EVENT_TIMES, Tables

BUCKET_KEYS: dict[str, str] = {
    "candidate": "candidate_id",
    "candidate_personal_info": "candidate_id",
    "candidate_rating": "candidate_id",
    "candidate_login_history": "cid",
    "candidate_progress": "candidate_progress_id",
    "candidate_progress_message_info": "candidate_progress_id",
    "candidate_progress_log": "candidate_progress_id",
    "candidate_replace": "candidate_progress_id",
    "message_thread": "message_thread_id",
    "message": "message_thread_id",
    "resume_education_background": "resume_id",
    "resume_company": "resume_id",
    "resume_business": "resume_id",
    "resume_job": "resume_id",
}


def write_bucketed(spark: SparkSession, t: Tables, database: str, num_buckets: int) -> Tables:
    """Write every source as a catalog table in ``database``; the large ones
    bucketed (and sorted) by their key.  Returns the tables read back."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, df in t.items():
        w = df.write.mode("overwrite").format("parquet")
        key = BUCKET_KEYS.get(name)
        if key:
            w = w.bucketBy(num_buckets, key).sortBy(key)
        w.saveAsTable(f"{database}.{name}")
    return Tables.from_catalog(spark, database)


def write_by_month(spark: SparkSession, t: Tables, root: str) -> Tables:
    """Write every source under ``root``, those of ``EVENT_TIMES`` partitioned by event month; read back.

    Rows are ranged over month, time and all columns, so a heavy month (or
    the rows without a time, a partition of their own) is written by several
    tasks and a task opens few partitions.
    """
    for name, df in t.items():
        path = f"{root.rstrip('/')}/{name}"
        at = EVENT_TIMES.get(name)
        if at is None:
            df.write.mode("overwrite").parquet(path)
        else:
            (df.withColumn(EVENT_MONTH, F.trunc(F.to_date(at), "MM"))
             .repartitionByRange(EVENT_MONTH, at, F.xxhash64(*df.columns))
             .write.mode("overwrite").partitionBy(EVENT_MONTH).parquet(path))
    return Tables.from_months(spark, root)
