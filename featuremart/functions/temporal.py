"""Date predicates, durations and flags as column expressions.

Every reference day is an argument: nothing here reads the clock. Bounds are
written as ``column < next day`` so that date and timestamp columns behave
alike and the bare column still reaches the file reader as a pushed filter.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: open dates before this day are treated as missing.
OPEN_DATE_FLOOR = date(2000, 1, 1)


def next_day(day: date) -> Column:
    return F.lit(day + timedelta(days=1))


def within_days(col: str, after: date, upto: date) -> Column:
    """``after < day <= upto``."""
    return (F.col(col) >= next_day(after)) & (F.col(col) < next_day(upto))


def valid_on(as_of: date, from_col: str, to_col: str) -> Column:
    """True when the row's validity interval covers ``as_of``; a null end is open."""
    edge = next_day(as_of)
    return (F.col(from_col) < edge) & (F.col(to_col).isNull() | (F.col(to_col) >= edge))


def repaired_open(col: str, fallbacks: Sequence[str], floor: date = OPEN_DATE_FLOOR) -> Column:
    """The open date, or the earliest fallback when it is null or before ``floor``."""
    opened = F.col(col).cast("date")
    days = [F.col(c).cast("date") for c in fallbacks]
    earliest = F.least(*days) if len(days) > 1 else days[0]
    return F.when(opened >= F.lit(floor), opened).otherwise(earliest)


def closed_by(close: str, as_of: date) -> Column:
    return F.when(F.col(close) < next_day(as_of), 1).otherwise(0)


def tenure_days(open_: str, close: str, as_of: date) -> Column:
    """Days from open to close, or to ``as_of`` when not closed by then."""
    ended = F.col(close).cast("date")
    until = F.when(ended <= F.lit(as_of), ended).otherwise(F.lit(as_of))
    return F.datediff(until, F.col(open_).cast("date"))


def open_on(open_: str, close: str, as_of: date) -> Column:
    """1 when opened by ``as_of`` and not closed by then."""
    return F.when(valid_on(as_of, open_, close), 1).otherwise(0)


def days_since(col: str, as_of: date) -> Column:
    return F.datediff(F.lit(as_of), F.col(col).cast("date"))


def elapsed_hours(start: str | Column, end: str | Column, done: Column) -> Column:
    """Hours from start to end where ``done`` holds, else 0; null if the end is missing."""
    start, end = (F.col(c) if isinstance(c, str) else c for c in (start, end))
    seconds = F.timestamp_diff("SECOND", start, end)
    return F.when(done, seconds / F.lit(3600)).otherwise(F.lit(0.0))


def feature_month(month: Column, lag: int) -> Column:
    """First day of the month whose features belong to a label of ``month``."""
    return F.add_months(F.trunc(month, "month"), -lag)
