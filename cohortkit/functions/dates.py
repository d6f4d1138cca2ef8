"""Month arithmetic as Column expressions and literals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_key_of(c) -> Column:
    """``yyyyMM`` text of a date column."""
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyyMM")


def month_key_from_text(c) -> Column:
    """``yyyyMM`` from ``yyyy-MM…`` text: ``CONCAT(SUBSTR(s,1,4), SUBSTR(s,6,2))``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(F.substring(c, 1, 4), F.substring(c, 6, 2))


def in_month(c, start: dt.date, next_start: dt.date) -> Column:
    """Calendar-month membership as a half-open range (pushes into the scan).

    Same rows as ``YEAR(c) = YEAR(p) AND MONTH(c) = MONTH(p)``.
    """
    c = F.col(c) if isinstance(c, str) else c
    return (c >= F.lit(start)) & (c < F.lit(next_start))


def tenure_years(ref_date: dt.date, c) -> Column:
    """Whole years between ``c`` and ``ref_date``: ``FLOOR(DATEDIFF/365.25)``."""
    c = F.col(c) if isinstance(c, str) else c
    days = F.datediff(F.lit(ref_date), c)
    return F.floor(days.cast("double") / F.lit(365.25)).cast("int")
