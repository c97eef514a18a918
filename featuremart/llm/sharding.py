"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded key within their source and get the fractional
rank (2r - 1) / 2n. Sorted by it, all sources advance at the same pace, so every
contiguous cut has the mixture of the whole. The cuts put equal numbers of rows
in each shard, at most one apart (law ``rows``).

No task ever sorts a source: ranks come from 4096 key ranges per source, whose
counts are summed first, and the global order from 4096 ranges of the
fractional rank. The text leaves the plan in the scan; only ids, sizes and
checksums are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featuremart.llm.common import fresh, group_key, running_offsets

RANGES = 4096


def interleave(df: DataFrame, shards: int = 40, seed: int = 7, source: str = "source", key: str = "_key") -> DataFrame:
    """``df`` with ``position`` (0 to n - 1 in interleaved order), ``shard`` and ``slot`` (gapless from 0).

    ``key`` names a string column of ``df`` that shuffles the rows: hexadecimal,
    evenly spread, and the same whenever the row is the same. Rows with an
    equal key in one source take neighbouring places in either order, which
    only identical rows should do. A null source is a source of its own. With
    fewer rows than shards some shards stay empty; no rows give no rows.
    """
    group, cut, before, total, rank, share, place, start = fresh(df, "group", "cut", "before", "total", "rank", "share", "place", "start")
    dealt = df.withColumn(group, group_key([source])).withColumn(cut, F.conv(F.substring(key, 1, 3), 16, 10).cast("int"))
    offsets = running_offsets(dealt, group, cut, F.count("*"), before, total)
    within = Window.partitionBy(group, cut).orderBy(key)
    ranked = dealt.join(offsets, [group, cut]).withColumn(rank, F.col(before) + F.row_number().over(within))
    ranked = ranked.withColumn(share, (2 * F.col(rank) - 1) / (2 * F.col(total))).drop(before, total, cut, rank)
    spread = ranked.withColumn(place, F.floor(F.col(share) * RANGES).cast("int"))
    starts = running_offsets(spread, None, place, F.count("*"), start, total)
    order = Window.partitionBy(place).orderBy(share, group, key)
    n = F.col(total)
    return (
        spread.join(starts, place)
        .withColumn("position", F.col(start) + F.row_number().over(order) - 1)
        .withColumn("shard", F.expr(f"cast((position * {int(shards)}) div `{total}` as int)"))
        .withColumn("slot", F.col("position") - F.ceil(F.col("shard") * n / F.lit(int(shards))).cast("bigint"))
        .drop(place, share, start, total, group)
    )


def shard_documents(docs: DataFrame, shards: int = 40, seed: int = 7, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Shard, slot, size and checksum of every document.

    Size is the UTF-8 length of the text plus 16; a null text has no bytes. Null
    ids, repeated ids and repeated rows are rows like any other. Equal texts
    are not kept together: the law is the row count. Other columns are ignored.
    """
    raw = F.coalesce(F.encode(F.col(text), "utf-8"), F.encode(F.lit(""), "utf-8"))
    rows = docs.select(F.col(id).alias("doc_id"), F.col(source).alias("source"), (F.octet_length(raw) + 16).cast("bigint").alias("size"), F.crc32(raw).alias("text_crc32"))
    rows = rows.withColumn("_key", F.md5(F.encode(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text_crc32").cast("string")), "utf-8")))
    return interleave(rows, shards, seed).drop("_key")


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id: str = "doc_id") -> None:
    """Write whole documents in one folder per shard, in slot order. ``id`` must be unique; one row may have none.

    Rows are dealt by shard and a range of slots, so a shard is written by several tasks.
    """
    if set(docs.columns) & {"shard", "slot"}:
        raise ValueError("the documents already have a column shard or slot")
    key, *_ = fresh(docs, "key")
    where = placed.select(F.col("doc_id").alias(key), "shard", "slot")
    full = docs.join(where, F.col(id).eqNullSafe(F.col(key))).drop(key)
    full.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").mode("errorifexists").parquet(path)
