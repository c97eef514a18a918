"""Month sums kept as a mergeable state, from which any window is made."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremart.functions.calendar import month_end
from featuremart.operators.joins import stack
from featuremart.operators.slots import slot_name

#: Columns of a state besides its keys; ``class`` is null where classes are not told apart.
STATE = ("month", "class", "total", "n")


def month_state(
    df: DataFrame, keys: Sequence[str], date_col: str, value: str | Column, class_col: str | None = None
) -> DataFrame:
    """One row per key, month and class with the sum and number of values: what :func:`windows` needs of the rows.

    ``month`` is the month's last day. Rows without a date are left out; a null
    value counts as a row, not as a sum. Stored by month, a state is made once
    per month and never read back from the rows.
    """
    value = F.col(value) if isinstance(value, str) else value
    kind = F.lit(None).cast("int") if class_col is None else F.col(class_col)
    dated = df.where(F.col(date_col).isNotNull())
    return dated.groupBy(*keys, F.last_day(F.col(date_col).cast("date")).alias("month"), kind.alias("class")).agg(
        F.sum(value).alias("total"), F.count("*").alias("n")
    )


def merge_states(keys: Sequence[str], *states: DataFrame) -> DataFrame:
    """States of disjoint rows added up, such as that of a month and of its late rows."""
    return stack(*states).groupBy(*keys, "month", "class").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def windows(
    state: DataFrame,
    keys: Sequence[str],
    as_of: Sequence[date],
    prefix: str,
    n: int = 5,
    *,
    class_prefix: str | None = None,
    none_class=None,
    style: str = "mm",
    out: str = "as_of",
) -> DataFrame:
    """The ``n`` month slots of ``month_slots`` for every day of ``as_of``, from one read of a merged state.

    One row per key and window that has rows in it; ``out`` holds the window's
    month end. With ``class_prefix`` also the class with the greatest sum per
    slot, equal sums by the smaller class, ``none_class`` where there is none.
    A state row reaches at most ``n`` windows, and each key's rows are combined
    before the shuffle.
    """
    ends = F.array(*[F.lit(d) for d in sorted({month_end(d) for d in as_of})])
    back = lambda end: (F.year(end) - F.year("month")) * 12 + F.month(end) - F.month("month")
    reached = F.filter(ends, lambda end: (back(end) >= 0) & (back(end) < n))
    rows = state.withColumn(out, F.explode(reached)).withColumn("slot", back(F.col(out)))
    aggs = [
        F.sum(F.when(F.col("slot") == k, F.col("total")).otherwise(F.lit(0))).alias(slot_name(prefix, k, style))
        for k in range(n)
    ]
    if class_prefix is not None:
        order = F.struct(-F.col("total"), F.col("class"))
        for k in range(n):
            top = F.min_by("class", F.when(F.col("slot") == k, order))
            aggs.append((top if none_class is None else F.coalesce(top, F.lit(none_class))).alias(slot_name(class_prefix, k)))
    return rows.groupBy(*keys, out).agg(*aggs)
