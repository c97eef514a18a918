"""Negative downsampling."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featuremart.operators.joins import unused
from featuremart.operators.ranking import key_hash

#: Strata whose borders are sent to every task; more are joined by a shuffle.
STRATA_SENT = 100_000


def downsample(
    df: DataFrame, label: str, ratio: float, key: Sequence[str], seed: int = 0
) -> DataFrame:
    """All positives and about ``ratio`` negatives for each of them.

    A negative stays when the hash of its key falls below the wanted fraction,
    so a rerun or a retried task picks the same rows. With too few negatives all
    stay; without positives none do.
    """
    positive = F.col(label) == 1
    negative = F.col(label) == 0
    # one row; as a scalar subquery it is computed once, before the filter
    share = df.agg(
        F.try_divide(F.count_if(positive) * F.lit(float(ratio)), F.count_if(negative)).alias("share")
    ).scalar()
    hashed = key_hash(key, seed) / F.lit(float(2**32))
    return df.where(positive | (negative & (hashed < share)))


def downsample_strata(
    df: DataFrame, label: str, ratio: float, key: Sequence[str], strata: Sequence[str], seed: int = 0
) -> DataFrame:
    """All positives and, in each stratum, exactly ``floor(ratio * positives)`` negatives or all there are.

    The negatives with the least hash of their key stay, so a rerun picks the
    same rows; equal hashes are settled by the key, which should identify a row
    of a stratum. One histogram of the hash per stratum tells in which bucket
    its last negative lies: rows below it pass by a filter and only those of
    that bucket, one of 65 536, are ranked. A null in a stratum is a value of its own.
    """
    names = {s: unused(f"_of_{s}", df) for s in strata}
    bucket, edge, rest, rank = (unused(c, df) for c in ("_bucket", "_edge", "_rest", "_rank"))
    place = F.shiftright(key_hash(key, seed), 16)
    counts = df.groupBy(*[F.col(s).alias(o) for s, o in names.items()], place.alias(bucket)).agg(
        F.count_if(F.col(label) == 1).alias("positive"), F.count_if(F.col(label) == 0).alias("negative")
    )
    # at most 65 536 rows of a stratum reach these windows
    whole = Window.partitionBy(*names.values())
    upto = F.sum("negative").over(whole.orderBy(bucket))
    wanted = F.floor(F.sum("positive").over(whole) * F.lit(float(ratio)))
    summed = counts.withColumns({"upto": upto, "wanted": wanted}).where("upto >= wanted")
    # the first bucket that reaches the wanted number; a stratum with too few negatives has none
    first = F.min_by(F.struct(F.col(bucket).alias(edge), (F.col("wanted") - F.col("upto") + F.col("negative")).alias(rest)), bucket)
    borders = summed.groupBy(*names.values()).agg(first.alias("border")).select(*names.values(), "border.*")
    small = borders.limit(STRATA_SENT + 1).count() <= STRATA_SENT
    same = reduce(lambda a, b: a & b, [F.col(s).eqNullSafe(F.col(o)) for s, o in names.items()])
    rows = df.withColumn(bucket, place).join(F.broadcast(borders) if small else borders, same, "left")
    negative = F.col(label) == 0
    below = F.col(edge).isNull() | (F.col(bucket) < F.col(edge))
    passed = rows.where((F.col(label) == 1) | (negative & below))
    order = Window.partitionBy(*strata).orderBy(key_hash(key, seed), *key)
    last = rows.where(negative & (F.col(bucket) == F.col(edge)) & (F.col(rest) > 0))
    ranked = last.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= F.col(rest))
    return passed.select(df.columns).unionByName(ranked.select(df.columns))
