"""Run parameters of one monthly cohort run.

All derived dates are computed once on the driver (pure calendar arithmetic
on a handful of scalars) and enter plans as literals, so Catalyst folds them
and pushes the resulting range predicates into the scans.
"""

from __future__ import annotations

import calendar
import datetime as dt
from dataclasses import dataclass, field


def _as_date(v) -> dt.date:
    if isinstance(v, dt.datetime):
        return v.date()
    if isinstance(v, dt.date):
        return v
    return dt.date.fromisoformat(str(v)[:10])


def add_months(d: dt.date, n: int) -> dt.date:
    """Spark ``add_months`` semantics: clamp the day, never snap to month end."""
    y, m = divmod(d.month - 1 + n, 12)
    year, month = d.year + y, m + 1
    day = min(d.day, calendar.monthrange(year, month)[1])
    return dt.date(year, month, day)


def last_day(d: dt.date) -> dt.date:
    return dt.date(d.year, d.month, calendar.monthrange(d.year, d.month)[1])


def month_start(d: dt.date) -> dt.date:
    return d.replace(day=1)


# Code lists of the business rules (they define the results; in rule order).
INFORCE_STATUS = ("1", "2", "3", "5")
ISSUED_STATUS = ("1", "2", "3", "5", "7", "9", "A", "B", "D", "E", "F", "H", "L", "M", "T", "X")
WRITING_CHANNELS = ("01", "97", "98")
SERVICING_CHANNELS = ("01", "04", "97", "98")
PARTY_LINK_TYPES = ("O", "I", "T", "B")
BANCA_CHANNEL = "Banca"
DMTM_LOCATION_PREFIXES = ("DMO", "FPC")


@dataclass(frozen=True)
class RunParams:
    """Parameters of one run.

    ``month_end``            target month end (the cohort month).
    ``scorecard_month_end``  agent scorecard snapshot, stored as ``yyyy-MM-dd`` text.
    ``lifestage_month``      life-stage snapshot, stored as ``yyyy-MM`` text.
    ``needs_month``          existing-customer propensity snapshot (``yyyy-MM``).
    ``run_date``             date the recency cut-off is measured from; the
                             original used the wall clock, here it is explicit
                             so a re-run of a month is reproducible.
    """

    month_end: dt.date = dt.date(2023, 2, 28)
    scorecard_month_end: str = "2023-03-31"
    lifestage_month: str = "2023-03"
    needs_month: str = "2023-03"
    run_date: dt.date = dt.date(2023, 4, 1)
    inforce_status: tuple = INFORCE_STATUS
    issued_status: tuple = ISSUED_STATUS
    writing_channels: tuple = WRITING_CHANNELS
    servicing_channels: tuple = SERVICING_CHANNELS
    party_link_types: tuple = PARTY_LINK_TYPES
    banca_channel: str = BANCA_CHANNEL
    dmtm_prefixes: tuple = DMTM_LOCATION_PREFIXES
    tenure_years: int = 10
    new_lookback_months: int = 6
    repurchase_months: int = 2
    recency_months: int = 4
    snap_month_end: bool = False
    extra: dict = field(default_factory=dict, compare=False, hash=False)

    def __post_init__(self):
        object.__setattr__(self, "month_end", _as_date(self.month_end))
        object.__setattr__(self, "run_date", _as_date(self.run_date))

    # ---- derived values -------------------------------------------------
    @property
    def month_key(self) -> str:
        """``yyyyMM`` of the target month (the output column ``onb_mth_yr``)."""
        return self.month_end.strftime("%Y%m")

    @property
    def month_start(self) -> dt.date:
        return month_start(self.month_end)

    @property
    def next_month_start(self) -> dt.date:
        return add_months(self.month_start, 1)

    @property
    def new_window_start(self) -> dt.date:
        """Start of the 'new customer' window: month start minus N months."""
        return add_months(self.month_start, -self.new_lookback_months)

    @property
    def repurchase_end(self) -> dt.date:
        """Month end + N months; clamped like Spark (28 Feb + 2 = 28 Apr)."""
        end = add_months(self.month_end, self.repurchase_months)
        return last_day(end) if self.snap_month_end else end

    @property
    def recency_cutoff(self) -> dt.date:
        """``LAST_DAY(ADD_MONTHS(run_date, -N))``; batches after it are recent."""
        return last_day(add_months(self.run_date, -self.recency_months))

    def with_(self, **kw) -> "RunParams":
        from dataclasses import replace
        return replace(self, **kw)
