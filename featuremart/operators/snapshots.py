"""Rows valid on a day, one row per key, and month-lagged columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featuremart.functions.temporal import (
    OPEN_DATE_FLOOR,
    closed_by,
    days_since,
    open_on,
    repaired_open,
    tenure_days,
    valid_on,
)


def snapshot(df: DataFrame, as_of: date, from_col: str = "dt_from", to_col: str = "dt_to") -> DataFrame:
    """Rows whose interval ``[from, to)`` covers ``as_of``; a null end is open."""
    return df.where(valid_on(as_of, from_col, to_col))


def latest_by(
    df: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str | Column] = ()
) -> DataFrame:
    """The row with the greatest ``order`` per key.

    ``ties`` (greatest first for names) must settle equal dates; give all
    compared columns when the table has no unique id. The rank filter reaches
    the map side, so a hot key sends one row per task through the shuffle.
    """
    ranking = [F.col(order).desc_nulls_last()]
    ranking += [F.col(t).desc_nulls_last() if isinstance(t, str) else t for t in ties]
    return one_per_key(df, keys, ranking)


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row per key in the given order."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def any_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One whole row per key, the same one on every run: the smallest of all its columns."""
    return one_per_key(df, keys, [F.col(c).asc_nulls_last() for c in df.columns if c not in keys])


def repair_open_date(
    df: DataFrame, col: str, fallbacks: Sequence[str], floor: date = OPEN_DATE_FLOOR
) -> DataFrame:
    """Replace implausible open dates by the earliest fallback; drop rows that have none."""
    repaired = df.withColumn(col, repaired_open(col, fallbacks, floor))
    return repaired.where(F.col(col).isNotNull())


def with_tenure(df: DataFrame, pairs: Mapping[str, tuple[str, str]], as_of: date) -> DataFrame:
    """Add ``{out: (open, close)}`` durations in days."""
    return df.withColumns({out: tenure_days(o, c, as_of) for out, (o, c) in pairs.items()})


def with_open_flags(df: DataFrame, pairs: Mapping[str, tuple[str, str]], as_of: date) -> DataFrame:
    """Add ``{out: (open, close)}`` flags: open on ``as_of``."""
    return df.withColumns({out: open_on(o, c, as_of) for out, (o, c) in pairs.items()})


def with_closed_flag(df: DataFrame, out: str, close: str, as_of: date) -> DataFrame:
    return df.withColumn(out, closed_by(close, as_of))


def with_days_since(df: DataFrame, columns: Mapping[str, str], as_of: date) -> DataFrame:
    """Add ``{out: date column}`` ages in days."""
    return df.withColumns({out: days_since(c, as_of) for out, c in columns.items()})


def lag_columns(
    df: DataFrame,
    keys: Sequence[str],
    date_col: str,
    columns: Mapping[str, str | Column],
    days: Sequence[date],
) -> DataFrame:
    """Put the values of each snapshot day side by side as ``name_0 … name_{n-1}``.

    Only keys present on the first day are kept. One aggregation replaces a
    self-join per day. If a key repeats on a day, one of its rows supplies all
    columns of that day.
    """
    values = {n: F.col(c) if isinstance(c, str) else c for n, c in columns.items()}
    narrow = (
        df.where(F.col(date_col).isin(list(days)))
        .select(*keys, F.col(date_col).alias("_day"), *[c.alias(n) for n, c in values.items()])
        .withColumn("_row", F.xxhash64(*values))
    )
    aggs = [
        F.max_by(F.col(n), F.when(F.col("_day") == F.lit(day), F.col("_row"))).alias(f"{n}_{k}")
        for k, day in enumerate(days)
        for n in values
    ]
    present = F.max(F.when(F.col("_day") == F.lit(days[0]), 1)).alias("_present")
    wide = narrow.groupBy(*keys).agg(present, *aggs)
    return wide.where(F.col("_present") == 1).drop("_present")


def month_slice(df: DataFrame, col: str, month: date, columns: Sequence[str] = ()) -> DataFrame:
    """One month of a table, optionally projected; prunes partitions when ``col`` is one."""
    kept = df.where(F.col(col) == F.lit(month))
    return kept.select(*columns) if columns else kept


def assert_grain(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Check that ``keys`` identify a row; runs one aggregation and returns ``df``."""
    repeated = df.groupBy(*keys).count().where(F.col("count") > 1).first()
    if repeated is not None:
        raise ValueError(f"{list(keys)} repeats: {repeated.asDict()}")
    return df
