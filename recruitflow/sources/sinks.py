"""Sinks: the marts are result sets; persisted, they are partitioned by month."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: File that names the version in force, beside the folder of versions.
POINTER = "_current"
VERSIONS = "_versions"


def with_act_month(log: DataFrame, date_col: str = "act_date") -> DataFrame:
    """Add ``act_month`` = first day of the action's month."""
    return log.withColumn("act_month", F.trunc(F.to_date(F.col(date_col)), "MM"))


def ranged(out: DataFrame, date_col: str = "act_date", num_partitions: int | None = None) -> DataFrame:
    """Rows in ranges of (month, ids, date)."""
    out = with_act_month(out, date_col)
    keys = [F.col(c) for c in ("act_month", "act_id", "candidate_id", "recruiter_company_id", "job_id", date_col)
            if c in out.columns]
    return out.repartitionByRange(num_partitions, *keys) if num_partitions else out.repartitionByRange(*keys)


def write_log(log: DataFrame, path: str, date_col: str = "act_date", mode: str = "overwrite",
              num_partitions: int | None = None, only_months_present: bool = False) -> None:
    """Write an action log as Parquet partitioned by ``act_month``.

    ``overwrite`` leaves exactly ``log`` in the folder: months that left the
    window or became empty go.  With ``only_months_present`` months that
    ``log`` does not hold are left as they are (to refresh a part).

    Rows are range-partitioned on the month and all ids and dates before
    writing, so a heavy month is split over many balanced tasks also
    where its first id is NULL in every row, and each task holds a
    contiguous slice: it writes files for one or two month folders only.
    Readers filtering on a date range prune whole month folders.
    """
    parted = ranged(log, date_col, num_partitions)
    (parted.write.mode(mode)
     .option("partitionOverwriteMode", "dynamic" if only_months_present else "static")
     .partitionBy("act_month").parquet(path))


def write_entity(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write an entity mart (one row per id) as plain Parquet."""
    df.write.mode(mode).parquet(path)


def _files(spark: SparkSession, path: str):
    """Hadoop path and its file context (rename with overwrite is one step there)."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    conf = spark._jsc.hadoopConfiguration()
    return at, hadoop.FileContext.getFileContext(at.getFileSystem(conf).makeQualified(at).toUri(), conf)


def current_version(spark: SparkSession, path: str) -> str | None:
    """Folder of the version in force under ``path``; None before the first."""
    at, files = _files(spark, f"{path.rstrip('/')}/{POINTER}")
    if not files.util().exists(at):
        return None
    stream = files.open(at)
    try:
        name = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return f"{path.rstrip('/')}/{VERSIONS}/{name}"


def _switch(spark: SparkSession, path: str, version: str) -> None:
    """Point ``path`` to ``version``: a pointer file written aside replaces the old one in one rename."""
    base = path.rstrip("/")
    hadoop = spark._jvm.org.apache.hadoop.fs
    aside, files = _files(spark, f"{base}/.{POINTER}-{version}")
    out = aside.getFileSystem(spark._jsc.hadoopConfiguration()).create(aside, True)
    out.write(bytearray(version.encode()))
    out.close()
    option = getattr(hadoop, "Options$Rename")
    how = spark._sc._gateway.new_array(option, 1)
    how[0] = option.OVERWRITE
    files.rename(aside, hadoop.Path(f"{base}/{POINTER}"), how)


def _forget(spark: SparkSession, path: str, keep: set[str]) -> None:
    """Delete versions other than ``keep``, those of failed jobs too."""
    at, _ = _files(spark, f"{path.rstrip('/')}/{VERSIONS}")
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(at):
        if status.getPath().getName() not in keep:
            fs.delete(status.getPath(), True)


def publish(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Write a version of a dataset with ``write(folder)``, then make it the one that readers see.

    The version is a folder of its own; only when all of it is written
    does the pointer file name it, in one rename.  A job that fails
    leaves the last version in force, and a reader never sees a part of
    one.  The version before stays for readers that have already begun;
    older ones and those of failed jobs go.  One job at a time may
    publish to a path.
    """
    before, version = current_version(spark, path), uuid.uuid4().hex
    folder = f"{path.rstrip('/')}/{VERSIONS}/{version}"
    write(folder)
    _switch(spark, path, version)
    _forget(spark, path, {version} | ({before.rsplit("/", 1)[1]} if before else set()))
    return folder


def publish_log(log: DataFrame, path: str, date_col: str = "act_date", num_partitions: int | None = None,
                only_months_present: bool = False) -> str:
    """``write_log`` as a published version.

    With ``only_months_present`` the version holds the months of ``log``
    and, from the version before, the other months as they are.
    """
    spark = log.sparkSession

    def write(folder: str) -> None:
        write_log(log, folder, date_col, "errorifexists", num_partitions)
        before = current_version(spark, path)
        if only_months_present and before:
            month = spark.read.parquet(folder).select("act_month").distinct()
            old = spark.read.parquet(before)
            kept = old.join(month, old["act_month"].eqNullSafe(month["act_month"]), "left_anti").drop("act_month")
            write_log(kept, folder, date_col, "append", num_partitions)

    return publish(spark, path, write)


def publish_entity(df: DataFrame, path: str) -> str:
    """``write_entity`` as a published version."""
    return publish(df.sparkSession, path, lambda folder: write_entity(df, folder, "errorifexists"))


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The version of a published dataset that is in force."""
    folder = current_version(spark, path)
    if folder is None:
        raise FileNotFoundError(f"nothing published at {path}")
    return spark.read.parquet(folder)
