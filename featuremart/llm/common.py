"""Expressions and small helpers that several operators use."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featuremart.sources.storage import checkpoint_dir, scratch_path, shuffles_released

#: A word is a run of anything but the six ASCII blanks.
BLANK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back: a lost executor cannot change it.

    The shuffle files of the write go when it ends.
    """
    path = scratch_path(df.sparkSession, name)
    with shuffles_released(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """For small tables: cut the lineage in ``spark.checkpoint.dir``; Spark's cleaner may remove it after use."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where the body names it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def text_of(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def word_list(text: Column) -> Column:
    """The words of a text as an array."""
    return F.filter(F.split(text, BLANK), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def remainder(col: str, n: int) -> Column:
    """crc32 of an id as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(F.col(col).cast("string"), F.lit("")), "utf-8")) % n


def group_key(cols: Sequence[str]) -> Column:
    """One text per distinct combination, its parts joined by ``|``; null differs from the empty text."""
    plain = lambda c: F.replace(F.replace(F.col(c).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\p"))
    return F.concat_ws("|", *(F.coalesce(F.concat(F.lit("="), plain(c)), F.lit("~")) for c in cols))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have, so that extra columns can't clash."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        new = f"_{name}"
        while new.lower() in taken:
            new = f"_{new}"
        taken.add(new.lower())
        out.append(new)
    return out


def running_offsets(df: DataFrame, group: str | None, bucket: str, amount: Column, before: str, total: str) -> DataFrame:
    """Per group and bucket the amount in earlier buckets and in the whole group.

    The sums combine before their shuffle, and the window sees one row per
    bucket, never one per input row. This is what makes exact ranks and running
    totals possible without sorting a group in a single task.
    """
    keys = [group, bucket] if group else [bucket]
    sums = df.groupBy(*keys).agg(amount.alias(total))
    whole = Window.partitionBy(*([group] if group else []))
    earlier = whole.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(*keys, F.coalesce(F.sum(total).over(earlier), F.lit(0)).cast("bigint").alias(before), F.sum(total).over(whole).cast("bigint").alias(total))


def runs_of(texts: list, size: int = 1_000_000) -> Iterator[list]:
    """Neighbouring texts of about ``size`` characters or bytes together, a longer one alone: what a task works on at a time."""
    part, held = [], 0
    for t in texts:
        if part and held + len(t) > size:
            yield part
            part, held = [], 0
        part.append(t)
        held += len(t)
    if part:
        yield part


def small_enough(df: DataFrame, rows: int) -> DataFrame:
    """Marked for broadcast if it has at most ``rows`` rows, else left to a shuffle join. ``df`` must be stored."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
