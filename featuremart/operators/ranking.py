"""Global numbering, exact row caps and cohorts without a single-task window."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featuremart.operators.joins import unused
from featuremart.sources.storage import checkpoint_dir

# monotonically_increasing_id holds the row's position in its partition in the
# lower 33 bits and the partition number above them.
_POSITION_BITS = 33


def _as_columns(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def global_row_number(
    df: DataFrame,
    order: Sequence[str | Column],
    name: str = "row_num",
    *,
    unique: bool = False,
) -> DataFrame:
    """``row_number`` over the whole table, counted from 1.

    The rows are range-partitioned and sorted, so that a row's number is its
    position within the partition plus the rows of all partitions before it;
    only one count per partition is gathered. The sorted rows are checkpointed:
    the positions must not change between counting and numbering, nor when an
    executor is lost.

    Unless the order is ``unique``, the rows are checkpointed once before and
    their fixed position there is the last order column. Equal rows then have a
    defined order and can be spread over tasks, however many there are.
    """
    checkpoint_dir(df.sparkSession)
    keys = _as_columns(order)
    if not unique:
        df = df.checkpoint().withColumn("_tie", F.monotonically_increasing_id())
        keys.append(F.col("_tie"))
    placed = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id())
        .checkpoint()
    )
    part = F.shiftright("_place", _POSITION_BITS)
    position = F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    # one row per partition: this window and the broadcast stay small
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    number = F.col("_offset") + position + F.lit(1)
    return numbered.withColumn(name, number).drop("_part", "_place", "_tie", "_offset")


def key_hash(key: Sequence[str], seed: int) -> Column:
    """A repeatable number in ``[0, 2**32)`` from the key values and the seed.

    md5 rather than Spark's own hash, so that any engine can reproduce it.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def cap_rows(df: DataFrame, n: int | None, key: Sequence[str], seed: int = 0) -> DataFrame:
    """``n`` rows, always the same ones: those with the least hash of the key.

    ``None`` keeps all rows. A histogram of the hash finds the bucket in which
    the ``n``-th row lies; the rows below it pass by a plain filter and only the
    rows of that bucket are ranked.
    """
    if n is None:
        return df
    bucket = F.shiftright(key_hash(key, seed), 16)
    counts = df.groupBy(bucket.alias("_bucket")).agg(F.count("*").alias("_n"))
    # at most 65 536 rows reach this window
    running = F.sum("_n").over(Window.orderBy("_bucket"))
    edge = (
        counts.withColumn("_upto", running)
        .where(F.col("_upto") >= n)
        .agg(F.min_by(F.struct("_bucket", "_n", "_upto"), "_bucket").alias("_edge"))
        .first()["_edge"]
    )
    if edge is None:
        return df
    below = df.where(bucket < edge["_bucket"])
    wanted = n - (edge["_upto"] - edge["_n"])
    rows = df.where(bucket == edge["_bucket"])
    order = [key_hash(key, seed), *_as_columns(key)]
    ranked = global_row_number(rows, order, "_rank").where(F.col("_rank") <= wanted)
    return below.unionByName(ranked.drop("_rank"))


def cohort_rank(
    df: DataFrame,
    order: Sequence[str | Column],
    n_positive: int,
    label: str = "target_active_churn",
    *,
    unique: bool = False,
) -> DataFrame:
    """Number all rows by ``order`` and label the first ``n_positive`` of them 1, the rest 0."""
    numbered = global_row_number(df, order, unique=unique)
    return numbered.withColumn(label, F.when(F.col("row_num") <= n_positive, 1).otherwise(0))


#: Parts into which one look at the data cuts the range in which the border lies.
BINS = 4096
#: Rows beyond the wanted ones that may be numbered with them.
ROOM = 100_000


def _at_most(prefix: Sequence[tuple[str, object]], last: Column) -> Column:
    """Rows that sort before the values of ``prefix``, or have them and fulfil ``last``; nulls sort first."""
    for name, value in reversed(prefix):
        equal = F.col(name).eqNullSafe(F.lit(value))
        last = equal & last if value is None else F.col(name).isNull() | (F.col(name) < F.lit(value)) | (equal & last)
    return last


def _bin(kind: T.DataType, name: str, low, high) -> Column | None:
    """A number or text that grows with the column and differs between ``low`` and ``high``; None if the type has none."""
    if isinstance(kind, T.StringType):
        same = next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
        return F.substring(name, same + 1, 1)
    if isinstance(kind, (T.IntegralType, T.DecimalType)):
        scale = getattr(kind, "scale", 0)
        value, edges = F.col(name).cast(f"decimal(38,{scale})"), [Decimal(x) for x in (low, high)]
    elif isinstance(kind, T.DateType):
        value, edges = F.unix_date(name), [x.toordinal() - date(1970, 1, 1).toordinal() for x in (low, high)]
    elif isinstance(kind, T.FractionalType) and all(map(math.isfinite, (low, high, high - low))):
        value, edges = F.col(name).cast("double"), [float(low), float(high)]
    else:
        return None
    # the difference first: it is exact where the values are beyond the digits of a double
    share = (value - F.lit(edges[0])).cast("double") / F.lit(float(edges[1] - edges[0]))
    return F.floor(share * BINS)


def first_rows(df: DataFrame, order: Sequence[str], n: int, room: int | None = None) -> DataFrame:
    """The rows that can be among the first ``n`` of ``order``, by a filter on its columns.

    The order (ascending, nulls first) is refined digit by digit: a histogram
    of the first column tells in which part of its range the ``n``-th row lies,
    the next one cuts that part again, and within one value the next column is
    refined. Each step reads the order columns only. It stops when at most
    ``room`` rows too many would pass; more pass only if they are equal in all
    columns, or in those of a type that has no histogram (such as binary).
    """
    room = ROOM if room is None else room
    prefix: list[tuple[str, object]] = []
    for name in order:
        rows = df.where(reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in prefix], F.lit(True)))
        facts = rows.agg(F.count("*"), F.count(name), F.min(name), F.max(name)).first()
        total, known, low, high = facts
        if total <= n + room:
            break
        if n <= total - known:
            if total - known <= n + room:
                return df.where(_at_most(prefix, F.col(name).isNull()))
            prefix.append((name, None))
            continue
        n, count = n - (total - known), known
        while count > n + room and low != high:
            place = _bin(df.schema[name].dataType, name, low, high)
            if place is None:
                return df.where(_at_most(prefix, F.lit(True)))
            inside = rows.where(F.col(name).between(F.lit(low), F.lit(high)))
            bins = inside.groupBy(place.alias("bin")).agg(F.count("*").alias("n"), F.min(name).alias("low"), F.max(name).alias("high"))
            # at most a row per bin (or character) reaches this window
            upto = bins.withColumn("upto", F.sum("n").over(Window.orderBy("bin"))).where(F.col("upto") >= n)
            edge = upto.agg(F.min_by(F.struct("n", "upto", "low", "high"), "bin")).first()[0]
            n, count, low, high = n - (edge["upto"] - edge["n"]), edge["n"], edge["low"], edge["high"]
        if count <= n + room:
            return df.where(_at_most(prefix, F.col(name).isNull() | (F.col(name) <= F.lit(high))))
        prefix.append((name, low))
    return df.where(_at_most(prefix, F.lit(True)))


@dataclass(frozen=True)
class Cohort:
    """One month's cohort: how many rows it takes and how many of them are positive."""

    month: date
    rows: int
    positives: int


def monthly_cohorts(
    df: DataFrame,
    order: Sequence[str | Column],
    cohorts: Sequence[Cohort],
    label: str = "target_active_churn",
    month_col: str = "table_business_month",
    *,
    unique: bool = False,
) -> DataFrame:
    """Disjoint cohorts of the given sizes, each with its own ``row_num`` and label.

    One numbering, cut into consecutive ranges, takes the place of one anti-join
    per month against all months before. If the order is given by column names,
    :func:`first_rows` finds the rows that the cohorts can need, and no others
    are numbered; if it is ``unique`` too, only their order columns are sorted
    and checkpointed, and the rows are joined back. The input is read several
    times, so it should be a stored table.
    """
    total = sum(c.rows for c in cohorts)
    rank = unused("_rank", df)
    named = all(isinstance(o, str) for o in order)
    rows = first_rows(df, order, total) if named else df
    if named and unique:
        numbers = global_row_number(rows.select(*order), order, rank, unique=True).where(F.col(rank) <= total)
        other = {c: unused(f"_of_{c}", df) for c in order}
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(o)) for c, o in other.items()])
        numbered = rows.join(numbers.withColumnsRenamed(other), same).drop(*other.values())
    else:
        numbered = global_row_number(rows, order, rank, unique=unique)
    start, month, first, positives = 0, F.lit(None), F.lit(None), F.lit(None)
    for c in cohorts:
        inside = (F.col(rank) > start) & (F.col(rank) <= start + c.rows)
        month = F.when(inside, F.lit(c.month)).otherwise(month)
        first = F.when(inside, F.lit(start).cast("long")).otherwise(first)
        positives = F.when(inside, F.lit(c.positives).cast("long")).otherwise(positives)
        start += c.rows
    number = F.col(rank) - first
    return (
        numbered.where(F.col(rank) <= start)
        .withColumns(
            {
                "row_num": number,
                label: F.when(number <= positives, 1).otherwise(0),
                month_col: month,
            }
        )
        .drop(rank)
    )
