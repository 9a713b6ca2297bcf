"""Column expressions shared by the marts.

All builders return plain ``Column`` objects made of built-in functions,
so they stay inside whole-stage codegen.  Nothing here depends on the
session time zone: timestamps are ``TIMESTAMP_NTZ`` wall-clock values and
every zone shift names its zones explicitly.
"""

from __future__ import annotations

from datetime import date, datetime
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from recruitflow.functions import codes

DEC_38_2 = "decimal(38,2)"


# ---------------------------------------------------------------- literals
def ntz(ts: datetime) -> Column:
    """A ``TIMESTAMP_NTZ`` literal (independent of the session time zone)."""
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def ntz_bound(v: datetime | date) -> Column:
    """A window bound (a datetime, or a date meaning its midnight) as NTZ literal."""
    return ntz(v if isinstance(v, datetime) else datetime.combine(v, datetime.min.time()))


def as_col(c: Column | str) -> Column:
    """Column from a name or a Column."""
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- lookups
def label_of(code: Column | str, labels: Mapping[str, str], fallback: Column | None = None) -> Column:
    """CASE ladder ``code -> label``; unmatched (or NULL) codes take ``fallback``."""
    code = as_col(code)
    out = None
    for k, v in labels.items():
        out = F.when(code == k, F.lit(v)) if out is None else out.when(code == k, F.lit(v))
    return out.otherwise(fallback if fallback is not None else F.lit(None).cast("string"))


def industry_group(group_cd: Column | str, fallback: Column | None = None) -> Column:
    """Industry group label; unknown groups take ``fallback`` (NULL by default)."""
    return label_of(group_cd, codes.INDUSTRY_GROUP_LABELS, fallback)


def job_group(group_cd: Column | str) -> Column:
    """Job group label; unknown groups are NULL."""
    return label_of(group_cd, codes.JOB_GROUP_LABELS)


def route_info(route_cd: Column | str, scout_class: Column | str, numbered: bool = True) -> Column:
    """Application route label.

    Scout applications take the class of the scout thread they came
    from; a NULL class (thread unknown or outside the lookup window)
    fails both scout arms and ends as ``Other``.
    """
    route_cd, scout_class = as_col(route_cd), as_col(scout_class)
    fl, other = codes.PS_LABELS_NUMBERED if numbered else codes.PS_LABELS_PLAIN
    out = None
    for k, v in codes.ROUTE_LABELS.items():
        out = F.when(route_cd == k, F.lit(v)) if out is None else out.when(route_cd == k, F.lit(v))
    is_scout = route_cd == codes.ROUTE_SCOUT
    return (
        out.when(is_scout & (scout_class == codes.SCOUT_CLASS_INTERESTED), F.lit(fl))
        .when(is_scout & ~scout_class.isin(codes.SCOUT_CLASS_INTERESTED), F.lit(other))
        .otherwise(F.lit(codes.ROUTE_OTHER))
    )


def scout_label(scout_class: Column | str, numbered: bool = True) -> Column:
    """Scout class label: FL is 'interested', everything else (NULL too) 'other'."""
    fl, other = codes.PS_LABELS_NUMBERED if numbered else codes.PS_LABELS_PLAIN
    return F.when(as_col(scout_class) == codes.SCOUT_CLASS_INTERESTED, F.lit(fl)).otherwise(F.lit(other))


def channel(tracking_code: Column | str) -> Column:
    """Acquisition channel: first ``_`` token; NULL / Organic / app fold to Organic."""
    head = F.split_part(as_col(tracking_code), F.lit(codes.CHANNEL_SEPARATOR), F.lit(1))
    return F.when(head.isNull() | head.isin(*codes.CHANNEL_ORGANIC_ALIASES), F.lit(codes.CHANNEL_ORGANIC)).otherwise(head)


# ---------------------------------------------------------------- time
def local_time(ts: Column | str, tz: str) -> Column:
    """Wall-clock UTC timestamp -> wall-clock time in ``tz`` (stays NTZ)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), as_col(ts))


def epoch_ms_local_date(ms: Column, tz: str) -> Column:
    """Epoch milliseconds -> calendar date in ``tz``."""
    utc = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.make_dt_interval(secs=ms / F.lit(1000))
    return F.to_date(local_time(utc, tz))


def interview_set_date(json_col: Column | str, tz: str) -> Column:
    """Date of the first interview from the progress JSON (NULL when unset).

    An empty or missing value gives NULL; a non-numeric value gives NULL
    as well (``try_cast``) instead of failing the whole job.
    """
    raw = F.get_json_object(as_col(json_col), f"$.{codes.INTERVIEW_SET_KEY}")
    return F.when(raw != "", epoch_ms_local_date(raw.try_cast("bigint"), tz))


def has_interview_set(json_col: Column | str) -> Column:
    """True when the first-interview key holds a non-empty value (NULL when missing)."""
    return F.get_json_object(as_col(json_col), f"$.{codes.INTERVIEW_SET_KEY}") != ""


def age(birth: Column | str, today: date) -> Column:
    """Year difference corrected by day of year (as the report defines it)."""
    birth = as_col(birth)
    t = F.lit(today)
    return (
        F.year(t) - F.year(birth) + F.when(F.dayofyear(birth) > F.dayofyear(t), F.lit(-1)).otherwise(F.lit(0))
    ).cast("bigint")


# ---------------------------------------------------------------- text / numbers
def text_length(*cols: Column | str) -> Column:
    """Length of the concatenation of nullable texts (NULL counts as '')."""
    return F.length(F.concat(*[F.coalesce(as_col(c), F.lit("")) for c in cols])).cast("bigint")


def income_range(lower: str, upper: str) -> Column:
    """'<lower div 10000>万円-<upper div 10000>万円'; NULL when either side is NULL.

    ``lower`` / ``upper`` are column names; ``div`` is integer division
    truncating toward zero, as in the source definition.
    """
    d, u = codes.INCOME_DIVISOR, F.lit(codes.INCOME_UNIT)
    lo = F.expr(f"CAST(`{lower}` AS BIGINT) div {d}").cast("string")
    hi = F.expr(f"CAST(`{upper}` AS BIGINT) div {d}").cast("string")
    return F.concat(lo, u, F.lit("-"), hi, u)


def income_median(lower: Column | str, upper: Column | str) -> Column:
    """Mid income as DECIMAL: (lower + upper) / 2 with both sides DECIMAL(38,2)."""
    return (as_col(lower).cast(DEC_38_2) + as_col(upper).cast(DEC_38_2)) / F.lit(2)


def sales_score(price: Column, kind: Column, prev_kind: Column, previous_id: Column) -> Column:
    """Contribution of one approved sales row to the decision count.

    A priced row counts +1 as a replacement or a borrowing with a
    predecessor, and -1 as an offset of anything but a reduction.
    """
    up = (kind == codes.SALES_REPLACE) | ((kind == codes.SALES_BORROW) & previous_id.isNotNull())
    down = (kind == codes.SALES_OFFSET) & ~prev_kind.eqNullSafe(codes.SALES_REDUCE)
    return F.when(price.isNull(), 0).when(up, 1).when(down, -1).otherwise(0).cast("bigint")


def ntz_day(d: date) -> Column:
    """Midnight of ``d`` as a ``TIMESTAMP_NTZ`` literal."""
    return ntz(datetime.combine(d, datetime.min.time()))
