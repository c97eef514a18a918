"""Label expressions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from featuremart.functions.calendar import month_end, month_start
from featuremart.functions.temporal import next_day


def active_churn(close: str, month: date) -> Column:
    """1 when the contract was closed within the month of ``month``."""
    inside = (F.col(close) >= F.lit(month_start(month))) & (
        F.col(close) < next_day(month_end(month))
    )
    return F.when(inside, 1).otherwise(0)


def passive_churn(pays: Sequence[str]) -> Column:
    """1 when nothing was paid in any of the given month columns."""
    silent = F.lit(True)
    for pay in pays:
        silent = silent & (F.coalesce(F.col(pay), F.lit(0)) <= 0)
    return F.when(silent, 1).otherwise(0)
