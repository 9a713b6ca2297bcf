"""Applications: route labelling, status events, net decisions."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recruitflow.functions import codes, exprs
from recruitflow.sources.tables import Tables

# Default of ``thread_company_type``: restrict the scout lookup like the applications.
SAME_AS_APPLICATIONS = "same-as-applications"


def scout_threads_for_routes(t: Tables, sent_since: datetime | date, company_type: str | None = None) -> DataFrame:
    """Distinct (thread, trigger, class) of scout threads sent since a bound."""
    mt = t.since("message_thread", "scout_sent_tm", sent_since).where(
        F.col("create_trigger_type_cd") == codes.THREAD_SCOUT)
    if company_type is not None:
        mt = mt.where(F.col("company_type_cd") == company_type)
    return mt.select("message_thread_id", "create_trigger_type_cd", "scout_s_class").distinct()


def thread_classes(cpmi: DataFrame, threads: DataFrame) -> DataFrame:
    """(application, class of its thread) for every message-info row; NULL where the thread is unknown.

    Looked up before the applications are joined: most applications have
    no message info, and would meet in one task under a NULL thread id.
    Message-info rows without a thread id are kept beside the lookup for
    the same reason.
    """
    known = cpmi.where(F.col("_mi_tid").isNotNull()).join(threads, F.col("_mi_tid") == F.col("_th_tid"), "left")
    none = cpmi.where(F.col("_mi_tid").isNull()).withColumn("_th_class", F.lit(None).cast("string"))
    return known.select("_mi_pid", "_th_class").unionByName(none.select("_mi_pid", "_th_class"))


def applications_with_route(t: Tables, owner_id: int, thread_since: datetime | date, numbered: bool = True,
                            company_type: str | None = None, join_company: bool = False,
                            applied_since: datetime | date | None = None,
                            thread_company_type: str | None = SAME_AS_APPLICATIONS,
                            with_json: bool = False) -> DataFrame:
    """Applications with their route label (``route_info``).

    Scout applications look up the class of their scout thread among
    threads sent since ``thread_since``; the lookup only labels rows, but
    the join keeps the source multiplicity (one row per message-info row
    of the application).  ``join_company`` adds ``company_type_cd`` and,
    with ``company_type``, keeps only that company type.
    ``thread_company_type`` restricts the scout lookup (defaults to
    ``company_type``).  ``with_json`` keeps the progress JSON text (only the
    interview branches read it).
    """
    cp = t.candidate_progress if applied_since is None else t.since("candidate_progress", "ins_datetime", applied_since)
    cp = cp.where(F.col("recruiter_company_id") != owner_id)
    if join_company or company_type is not None:
        rc = t.recruiter_company.select(F.col("recruiter_company_id").alias("_rc_id"), "company_type_cd")
        if company_type is not None:
            rc = rc.where(F.col("company_type_cd") == company_type)
        cp = cp.join(rc, cp.recruiter_company_id == rc._rc_id).drop("_rc_id")
    cpmi = t.candidate_progress_message_info.select(F.col("candidate_progress_id").alias("_mi_pid"),
                                                    F.col("message_thread_id").alias("_mi_tid"))
    tct = company_type if thread_company_type == SAME_AS_APPLICATIONS else thread_company_type
    threads = scout_threads_for_routes(t, thread_since, tct).select(
        F.col("message_thread_id").alias("_th_tid"), F.col("scout_s_class").alias("_th_class"))
    routes = thread_classes(cpmi, threads)
    j = cp.join(routes, cp.candidate_progress_id == routes._mi_pid, "left")
    keep = ["ins_datetime", "candidate_progress_id", "apply_date", "candidate_id", "recruiter_company_id", "job_id"]
    if with_json:
        keep.append("candidate_progress_data_json")
    return j.select(*keep, exprs.route_info("application_route_type_cd", "_th_class", numbered).alias("route_info"))


def progress_log(t: Tables, statuses: tuple[str, ...] | str, since: datetime | date | None = None) -> DataFrame:
    """Non-deleted status-log rows with one of ``statuses`` (optionally windowed)."""
    st = (statuses,) if isinstance(statuses, str) else statuses
    log = t.candidate_progress_log if since is None else t.since("candidate_progress_log", "ins_datetime", since)
    log = log.where((F.col("del_flg") == codes.NOT_DELETED) & F.col("candidate_progress_status_cd").isin(*st))
    return log.select(F.col("candidate_progress_id").alias("_log_pid"), F.col("ins_datetime").alias("status_tm"))


def status_events(cp: DataFrame, t: Tables, statuses: tuple[str, ...] | str,
                  since: datetime | date | None = None) -> DataFrame:
    """Applications joined to their status changes (``status_tm`` added)."""
    log = progress_log(t, statuses, since)
    return cp.join(log, cp.candidate_progress_id == log._log_pid).drop("_log_pid")


def labelled_progress_log(t: Tables, labels: dict[str, tuple[str, ...]],
                          since: datetime | date | None = None) -> DataFrame:
    """Non-deleted status-log rows of several disjoint status sets; ``status_label`` names a row's set."""
    codes_all = tuple(c for sts in labels.values() for c in sts)
    assert len(set(codes_all)) == len(codes_all), "status sets must be disjoint"
    log = t.candidate_progress_log if since is None else t.since("candidate_progress_log", "ins_datetime", since)
    log = log.where((F.col("del_flg") == codes.NOT_DELETED) & F.col("candidate_progress_status_cd").isin(*codes_all))
    label = None
    for name, sts in labels.items():
        cond = F.col("candidate_progress_status_cd").isin(*sts)
        label = F.when(cond, F.lit(name)) if label is None else label.when(cond, F.lit(name))
    return log.select(F.col("candidate_progress_id").alias("_log_pid"), F.col("ins_datetime").alias("status_tm"),
                      label.alias("status_label"))


def labelled_status_events(cp: DataFrame, t: Tables, labels: dict[str, tuple[str, ...]],
                           since: datetime | date | None = None) -> DataFrame:
    """Applications joined once to their status changes for several disjoint
    status sets; ``status_label`` names the set each change belongs to.

    One scan and one join of the (large) status log serve every labelled
    branch, instead of one per branch.
    """
    log = labelled_progress_log(t, labels, since)
    return cp.join(log, cp.candidate_progress_id == log._log_pid).drop("_log_pid")


def cancelled_progress(t: Tables) -> DataFrame:
    """Progress ids with a live 'hire cancelled' log row."""
    return progress_log(t, codes.STATUS_HIRE_CANCELLED).select("_log_pid")


def standing_decisions(t: Tables, since: datetime | date | None = None) -> DataFrame:
    """Hire decisions (``cr_*``) minus those cancelled before joining: an anti
    join on the progress id (a correlated NOT EXISTS)."""
    cr = t.candidate_replace if since is None else t.since("candidate_replace", "ins_datetime", since)
    cr = cr.select(F.col("candidate_replace_id").alias("cr_id"), F.col("candidate_progress_id").alias("cr_pid"),
                   F.col("candidate_id").alias("cr_candidate_id"), F.col("job_id").alias("cr_job_id"),
                   F.col("income").alias("cr_income"), F.col("ins_datetime").alias("cr_ins_datetime"))
    cancelled = cancelled_progress(t)
    return cr.join(cancelled, cr.cr_pid == cancelled._log_pid, "left_anti")


def net_decisions(cp: DataFrame, t: Tables, since: datetime | date | None = None,
                  require_parents: bool = False) -> DataFrame:
    """Hire decisions minus those cancelled before joining.

    Returns the replace row (``cr_*``) joined with its application.  The
    cancelled ones are left out before the join with ``cp``.
    With ``require_parents`` the company and candidate must exist
    (semi joins: ids are unique in their entity tables).
    """
    cr = standing_decisions(t, since)
    j = cr.join(cp, cr.cr_pid == cp.candidate_progress_id)
    if require_parents:
        rc = t.recruiter_company.select(F.col("recruiter_company_id").alias("_p_cid"))
        ca = t.candidate.select(F.col("candidate_id").alias("_p_candidate"))
        j = j.join(rc, j.recruiter_company_id == rc._p_cid, "left_semi")
        j = j.join(ca, j.candidate_id == ca._p_candidate, "left_semi")
    return j
