"""Scout mails: sent scouts (thread matched to its first message) and replies."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recruitflow.functions import codes
from recruitflow.sources.tables import Tables


def scouts_sent(t: Tables, sent_since: datetime | date, company_type: str | None = None,
                owner_id: int | None = None, message_since: datetime | date | None = None) -> DataFrame:
    """Scout thread rows whose send time equals a recruiter message's time.

    Matching on the exact send time (instead of a min() per thread) is a
    cheap equi join on (thread, time).  Only existence of the message
    matters, so it is a semi join: duplicate messages at the same
    instant cannot multiply thread rows.  Thread rows are one per
    attached job.
    """
    mt = t.since("message_thread", "scout_sent_tm", sent_since).where(
        F.col("create_trigger_type_cd") == codes.THREAD_SCOUT)
    if company_type is not None:
        mt = mt.where(F.col("company_type_cd") == company_type)
    if owner_id is not None:
        mt = mt.where(F.col("recruiter_company_id") != owner_id)
    # times are equal, so the threads' bound holds for messages too
    m = t.since("message", "sent_tm", sent_since if message_since is None else message_since).where(F.col("from_recruiter") == codes.FLAG_TRUE).select(F.col("message_thread_id").alias("_m_tid"), F.col("sent_tm").alias("_m_tm"))
    return mt.join(m, (mt.message_thread_id == m._m_tid) & (mt.scout_sent_tm == m._m_tm), "left_semi")


def first_replies(t: Tables, since: datetime | date) -> DataFrame:
    """First candidate message per thread since ``since``: (thread, reply_tm).

    A plain min() aggregate: partial aggregation on the map side keeps a
    thread with millions of messages from reaching one task whole.
    """
    m = t.since("message", "sent_tm", since).where(F.col("from_recruiter") == codes.FLAG_FALSE)
    return m.groupBy(F.col("message_thread_id").alias("_rep_tid")).agg(F.min("sent_tm").alias("reply_tm"))


def opened_scouts_with_reply(t: Tables, since: datetime | date) -> DataFrame:
    """Distinct opened scout threads with their first reply time."""
    mt = t.message_thread.where((F.col("create_trigger_type_cd") == codes.THREAD_SCOUT)
                                & F.col("cn_scout_first_view_tm").isNotNull())
    rep = first_replies(t, since)
    return (mt.join(rep, mt.message_thread_id == rep._rep_tid)
            .select("message_thread_id", "scout_sent_tm", "recruiter_company_id", "company_type_cd", "reply_tm")
            .distinct())
