"""Join helpers: code lookups and skew-safe interval joins."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(fact: DataFrame, dim: DataFrame, left_key: str, right_key: str, how: str = "left") -> DataFrame:
    """``fact ⟕ dim`` on one code column; Spark picks the join from measured sizes.

    ``right_key`` is dropped from the output (the fact keeps its own key).
    """
    if left_key == right_key:
        return fact.join(dim, left_key, how)
    return fact.join(dim, fact[left_key] == dim[right_key], how).drop(dim[right_key])


def day_sequence(lo: Column, hi: Column) -> Column:
    """Days ``lo..hi`` inclusive as an array; empty when ``lo > hi`` or NULL.

    (``sequence`` would otherwise run backwards for lo > hi.)
    """
    return F.when(lo.isNotNull() & hi.isNotNull() & (lo <= hi),
                  F.sequence(lo, hi, F.expr("INTERVAL 1 DAY"))).otherwise(F.array().cast("array<date>"))


def _clipped(lo: str, hi: str, clip_lo: date | None, clip_hi: date | None) -> tuple[Column, Column]:
    # greatest/least skip NULLs: a NULL bound must stay NULL (no days), not become the clip
    a = F.col(lo) if clip_lo is None else F.when(F.col(lo).isNotNull(), F.greatest(F.col(lo), F.lit(clip_lo)))
    b = F.col(hi) if clip_hi is None else F.when(F.col(hi).isNotNull(), F.least(F.col(hi), F.lit(clip_hi)))
    return a, b


def explode_days(df: DataFrame, lo: str, hi: str, out: str, clip_lo: date | None = None,
                 clip_hi: date | None = None, spread_by: str | None = None) -> DataFrame:
    """One row per day of ``[lo, hi]`` (dates), clipped to ``[clip_lo, clip_hi]``.

    With ``spread_by`` (a well-spread key column) the intervals are first
    hash-partitioned over the session's shuffle partitions, a number AQE
    does not reduce.  Otherwise a small interval table, which AQE packs
    into one or two partitions by its byte size, would generate all its
    days in one or two tasks.
    """
    a, b = _clipped(lo, hi, clip_lo, clip_hi)
    if spread_by is not None:
        df = df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), spread_by)
    return df.withColumn(out, F.explode(day_sequence(a, b)))


def interval_left_join(left: DataFrame, right: DataFrame, key: str, right_key: str, at: str,
                       start: str, end: str, spread_by: str, clip_lo: date | None = None) -> DataFrame:
    """``left ⟕ right`` on ``key`` and ``start <= at <= end`` (inclusive).

    ``start``/``end`` are dates of ``right``; ``at`` is a date or
    timestamp of ``left``.  Every match lies in one calendar month of its
    interval, so the join is an equi join on ``(key, month)``, intervals
    repeated for each of their months, with the range test as residual: a
    left row meets each overlapping interval exactly once.  Actions of
    one hot key spread over months, and AQE splits what remains (or
    broadcasts the intervals where their measured size allows).

    ``clip_lo`` is a bound every ``at`` respects: earlier months are never
    generated.  An end far in the future costs twelve rows a year, so no
    upper bound has to be known.  ``spread_by``, a key of ``right``,
    spreads the intervals of a hot key over tasks before they are repeated.
    """
    if clip_lo is not None:
        # every ``at`` is >= clip_lo, so an interval ending earlier can never match
        right = right.where(F.col(end) >= F.lit(clip_lo))
    a, b = _clipped(start, end, clip_lo, None)
    months = F.when(a.isNotNull() & b.isNotNull() & (a <= b), F.sequence(
        F.trunc(a, "MM"), F.trunc(b, "MM"), F.expr("INTERVAL 1 MONTH"))).otherwise(F.array().cast("array<date>"))
    parts = int(right.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    r = right.repartition(parts, spread_by).withColumn("_iv_month", F.explode(months))
    lft = left.withColumn("_at_month", F.trunc(F.to_date(F.col(at)), "MM"))
    cond = ((lft[key] == r[right_key]) & (lft["_at_month"] == r["_iv_month"])
            & (r[start] <= lft[at]) & (lft[at] <= r[end]))
    return lft.join(r, cond, "left").drop("_at_month", "_iv_month").drop(r[right_key])
