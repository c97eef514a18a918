"""Month-slot aggregation: one column per month of a sliding window."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremart.functions.calendar import month_end, slots, window_start
from featuremart.functions.temporal import within_days


def slot_name(prefix: str, k: int, style: str = "mm") -> str:
    """``pay_00mm`` style by default, ``shpd_gb_0`` with ``style='plain'``."""
    return f"{prefix}_{k:02d}mm" if style == "mm" else f"{prefix}_{k}"


def in_slot(date_col: str, as_of: date, k: int, align: str = "month") -> Column:
    """Whether a day belongs to slot ``k``: any day of the month, or its last day only."""
    end = month_end(as_of, k)
    if align == "exact":
        return F.col(date_col).cast("date") == F.lit(end)
    return within_days(date_col, month_end(as_of, k + 1), end)


def in_window(df: DataFrame, date_col: str, as_of: date, n: int = 5) -> DataFrame:
    """Rows of the ``n`` months up to that of ``as_of``."""
    return df.where(within_days(date_col, window_start(as_of, n), month_end(as_of)))


def slot_sums(
    date_col: str,
    value: str | Column,
    prefix: str,
    as_of: date,
    n: int = 5,
    *,
    align: str = "month",
    style: str = "mm",
    agg=F.sum,
) -> list[Column]:
    """The ``n`` conditional aggregates, to be used in any ``agg`` call."""
    value = F.col(value) if isinstance(value, str) else value
    return [
        agg(F.when(in_slot(date_col, as_of, k, align), value).otherwise(F.lit(0))).alias(
            slot_name(prefix, k, style)
        )
        for k in range(n)
    ]


def month_slots(
    df: DataFrame,
    keys: Sequence[str],
    date_col: str,
    value: str | Column,
    prefix: str,
    as_of: date,
    n: int = 5,
    *,
    align: str = "month",
    style: str = "mm",
    agg=F.sum,
    present: str | None = None,
) -> DataFrame:
    """Sum ``value`` per key and month slot; keys without rows in the window are absent."""
    sums = slot_sums(date_col, value, prefix, as_of, n, align=align, style=style, agg=agg)
    out = in_window(df, date_col, as_of, n).groupBy(*keys).agg(*sums)
    return out.withColumn(present, F.lit(1)) if present else out


def _class_totals(df, keys, date_col, class_col, value, as_of, n):
    """Total per key, month and class: the shared first step of the payment block."""
    return (
        in_window(df, date_col, as_of, n)
        .groupBy(*keys, F.last_day(F.col(date_col)).alias("_month"), F.col(class_col).alias("_class"))
        .agg(F.sum(value).alias("_total"))
    )


def _dominant(as_of: date, n: int, prefix: str, none_value) -> list[Column]:
    # greatest total first, equal totals by the smaller class
    order = F.struct(-F.col("_total"), F.col("_class"))
    out = []
    for k, end in enumerate(slots(as_of, n)):
        top = F.min_by(F.col("_class"), F.when(F.col("_month") == F.lit(end), order))
        if none_value is not None:
            top = F.coalesce(top, F.lit(none_value))
        out.append(top.alias(slot_name(prefix, k)))
    return out


def dominant_by_month(
    df: DataFrame,
    keys: Sequence[str],
    date_col: str,
    class_col: str,
    value: str,
    prefix: str,
    as_of: date,
    n: int = 5,
    *,
    none_value=None,
) -> DataFrame:
    """The class with the greatest sum per key and month slot.

    Rows are first reduced to one per key, month and class, so the second,
    wider aggregation sees little data even for a hot key.
    """
    totals = _class_totals(df, keys, date_col, class_col, value, as_of, n)
    return totals.groupBy(*keys).agg(*_dominant(as_of, n, prefix, none_value))


def payment_block(
    df: DataFrame,
    keys: Sequence[str],
    as_of: date,
    n: int = 5,
    *,
    date_col: str = "dt",
    class_col: str = "pay_class",
    value: str = "amount",
    none_value=0,
) -> DataFrame:
    """Month sums and dominant class together.

    Both come from the same class totals, so the block needs neither a second
    read of the payments nor a join.
    """
    totals = _class_totals(df, keys, date_col, class_col, value, as_of, n)
    sums = [
        F.sum(F.when(F.col("_month") == F.lit(end), F.col("_total")).otherwise(F.lit(0))).alias(
            slot_name("pay", k)
        )
        for k, end in enumerate(slots(as_of, n))
    ]
    block = totals.groupBy(*keys).agg(*sums, *_dominant(as_of, n, "pay_class", none_value))
    return block.withColumn("is_pay", F.lit(1))
