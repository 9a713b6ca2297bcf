"""Run parameters and reporting-window bounds.

Jobs never read the clock: "now" is the ``as_of`` parameter (a naive UTC
instant).  Window bounds are derived from it once, on the driver, and
enter the plans as literals so Catalyst can fold them and push them into
the Parquet scans.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime
from zoneinfo import ZoneInfo


def _add_months(d: date, months: int) -> date:
    y, m = divmod(d.year * 12 + (d.month - 1) + months, 12)
    return date(y, m + 1, 1)


def month_start_back(d: date, months: int) -> date:
    """First day of the month that is ``months`` months before ``d``."""
    return _add_months(d.replace(day=1), -months)


@dataclass(frozen=True)
class Params:
    """Parameters shared by every mart.

    as_of            the instant treated as "now", naive UTC
    months           trailing window length (13 in every report)
    tz               business time zone; stored timestamps are wall-clock
                     times in this zone
    owner_company_id the platform's own company id, excluded from reports
    since            fixed start of the company log with cohort dates
    contract_since   earliest contract start kept for the company log
    """

    as_of: datetime
    months: int = 13
    tz: str = "Asia/Tokyo"
    owner_company_id: int = 1
    since: date = field(default=date(2017, 8, 1))
    contract_since: date = field(default=date(2016, 8, 1))

    # -- "now" in its two flavours -------------------------------------
    def now_local(self) -> datetime:
        """``as_of`` as wall-clock time in ``tz`` (naive)."""
        utc = self.as_of.replace(tzinfo=ZoneInfo("UTC"))
        return utc.astimezone(ZoneInfo(self.tz)).replace(tzinfo=None)

    def today_utc(self) -> date:
        return self.as_of.date()

    # -- window bounds ---------------------------------------------------
    def local_bound(self) -> datetime:
        """Month start ``months`` back from today's date in ``tz``.

        Used by almost every branch (applications, logins, clicks, ...).
        """
        return datetime.combine(month_start_back(self.now_local().date(), self.months), datetime.min.time())

    def utc_bound(self) -> datetime:
        """Month start ``months`` back from the UTC date of ``as_of``.

        Used by the contract calendar and company-side scout mails, and by
        the scout counters of the candidate profile (a *date* shifted to
        ``tz`` stays on the same day, so that spelling equals this one).
        """
        return datetime.combine(month_start_back(self.today_utc(), self.months), datetime.min.time())

    def calendar_last_day(self) -> date:
        """Last calendar day not after ``as_of`` (a date compared with now)."""
        return self.as_of.date()