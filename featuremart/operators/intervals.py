"""Validity intervals met by many days at once."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremart.operators.joins import enrich_spread, spread_join, unused

#: An end on or after this day means that the interval is still open, as a null end does.
OPEN_END = date(9000, 1, 1)
#: Days in one mask, a long whose sign stays free.
MASK_DAYS = 62


def _day(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("date")


def _covers(day: Column, start: str | Column, end: str | Column) -> Column:
    """``start <= day < end``, a null end is open: the test of ``snapshot`` for a day that is a column."""
    return (_day(start) <= day) & (_day(end).isNull() | (_day(end) > day))


def _month(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def _year_of(month: Column) -> Column:
    return F.floor((month - 1) / 12).cast("int")


def _month_bucket(month: Column) -> Column:
    return month * 2


def _year_bucket(year: Column) -> Column:
    return year * 2 + 1


def snapshots(
    df: DataFrame, days: Sequence[date], from_col: str = "dt_from", to_col: str = "dt_to", out: str = "snapshot_day"
) -> DataFrame:
    """The rows valid on each of the days, with that day in ``out``: the snapshots of all days from one read.

    A row appears once per day that its interval covers. Nothing is shuffled.
    """
    listed = F.array(*[F.lit(d) for d in sorted(set(days))])
    return df.withColumn(out, F.explode(F.filter(listed, lambda d: _covers(d, from_col, to_col))))


def day_masks(
    days: Sequence[date], names: Sequence[str], from_col: str = "dt_from", to_col: str = "dt_to"
) -> list[Column]:
    """The days on which a row is valid, as the bits of longs that ``bit_or`` merges; ``names`` as of :func:`mask_names`."""
    days = sorted(set(days))
    covered = lambda i, d: F.when(_covers(F.lit(d), from_col, to_col), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
    parts = [days[k * MASK_DAYS : (k + 1) * MASK_DAYS] for k in range(len(names))]
    none = F.lit(0).cast("long")
    return [reduce(Column.bitwiseOR, [covered(i, d) for i, d in enumerate(part)], none).alias(n) for n, part in zip(names, parts)]


def mask_names(days: Sequence[date], prefix: str) -> list[str]:
    return [f"{prefix}{k}" for k in range(max(1, -(-len(set(days)) // MASK_DAYS)))]


def masked_days(days: Sequence[date], names: Sequence[str]) -> Column:
    """The array of the days held in the masks of :func:`day_masks`."""
    held = [
        F.when(F.col(names[i // MASK_DAYS]).bitwiseAND(F.lit(1 << i % MASK_DAYS).cast("long")) != 0, F.lit(d))
        for i, d in enumerate(sorted(set(days)))
    ]
    return F.array_compact(F.array(*held)).cast("array<date>")


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    day: str,
    from_col: str = "dt_from",
    to_col: str = "dt_to",
    *,
    how: str = "inner",
    span: tuple[date, date] | None = None,
) -> DataFrame:
    """Each row of ``left`` with the rows of ``right`` of its key whose interval covers its ``day``.

    Closed intervals are cut into buckets and meet the days of a bucket by
    equality: those within two months into months, longer ones into years, so
    that an interval is two rows and one more for each whole year. ``span``, the
    first and last day of ``left``, keeps them from being
    cut outside it. Open intervals (a null end, or one from ``OPEN_END`` on) have no last month. They
    form a class of their own that joins on the key, is not multiplied by buckets
    and is only tested for its start. Null keys and null days match nothing.
    With ``how='left'`` rows of ``left`` without a match stay, with nulls; the least open start of
    each key settles most rows, and only the days of the others look for a closed interval again.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    if clash:
        raise ValueError(f"both sides have {sorted(clash)}")
    bucket, start, end, held = (unused(c, left, right) for c in ("_bucket", "_start", "_end", "_held"))
    is_open = _day(to_col).isNull() | (_day(to_col) >= F.lit(OPEN_END))
    first, last = _month(_day(from_col)), _month(F.date_sub(_day(to_col), 1))
    closed = right.where(~is_open & (_day(from_col) < _day(to_col)))
    short = last - first < 2
    if span is not None:
        first, last = F.greatest(first, _month(F.lit(span[0]))), F.least(last, _month(F.lit(span[1])))
        closed = closed.where(first <= last)
    by_month, by_year = F.sequence(first, last), F.sequence(_year_of(first), _year_of(last))
    cut = closed.withColumn(bucket, F.explode(F.when(short, F.transform(by_month, _month_bucket)).otherwise(F.transform(by_year, _year_bucket))))
    opened = right.where(is_open)

    def covering(days: DataFrame) -> DataFrame:
        month = _month(_day(day))
        buckets = F.inline(F.array(*[F.struct(b.alias(bucket)) for b in (_month_bucket(month), _year_bucket(_year_of(month)))]))
        return days.select("*", buckets).join(cut, [*keys, bucket], "inner").where(_covers(_day(day), from_col, to_col))

    order = [*left.columns, *[c for c in right.columns if c not in keys]]
    # plain joins: an inner join drops null keys before its shuffle, and the union lets hot keys be split
    after = left.join(opened, list(keys), "inner").where(_covers(_day(day), from_col, to_col))
    found = covering(left).select(order).unionByName(after.select(order))
    if how == "inner":
        return found
    # least start per key and end: open ends are a handful of days, so a key holds a short array
    ends = opened.groupBy(*keys, _day(to_col).alias(end)).agg(F.min(_day(from_col)).alias(start))
    least = ends.groupBy(*keys).agg(F.collect_list(F.struct(start, end)).alias(held))
    open_then = F.exists(held, lambda s: _covers(_day(day), s[start], s[end]))
    waiting = enrich_spread(left, least, keys).where(~F.coalesce(open_then, F.lit(False))).drop(held)
    met = covering(waiting.select(*keys, day).distinct()).select(*keys, day).distinct()
    return found.unionByName(spread_join(waiting, met, [*keys, day], "left_anti"), allowMissingColumns=True)
