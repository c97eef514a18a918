"""Month arithmetic on plain dates; the results go into plans as typed literals."""

from __future__ import annotations

import calendar
from datetime import date, timedelta


def add_months(day: date, months: int) -> date:
    """Same day ``months`` later (earlier if negative), clipped to the month's length."""
    year, month0 = divmod(day.year * 12 + day.month - 1 + months, 12)
    last = calendar.monthrange(year, month0 + 1)[1]
    return date(year, month0 + 1, min(day.day, last))


def month_start(day: date, back: int = 0) -> date:
    """First day of the month ``back`` months before that of ``day``."""
    return add_months(day.replace(day=1), -back)


def month_end(day: date, back: int = 0) -> date:
    """Last day of the month ``back`` months before that of ``day``."""
    return add_months(day.replace(day=1), 1 - back) - timedelta(days=1)


def slots(as_of: date, n: int = 5) -> list[date]:
    """Month ends of the ``n`` latest months, newest first."""
    return [month_end(as_of, k) for k in range(n)]


def window_start(as_of: date, n: int = 5) -> date:
    """Last day before the ``n``-month window; the window is open on this side."""
    return month_end(as_of, n)
