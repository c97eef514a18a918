"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.llm.common import checkpointed

LINKS = 20_000  # links of a partition


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` for every end of ``edges(a, b)``: the smallest id that links reach.

    Large stars point each neighbour above a node to the node's least
    neighbour, small stars those below it. Minima combine before their shuffle
    and joins are split by adaptive execution, so one node may hold most edges.
    The number of rounds grows with the logarithm of the longest path. No edges give no rows.
    """
    now = checkpointed(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    # the number of links does not grow from round to round; few links take few files
    parts = 1 + now.count() // LINKS
    kept = lambda df: checkpointed(df.coalesce(parts))
    last = None
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = kept(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = kept(large)
        least = kept(large.groupBy("a").agg(F.min("b").alias("m")))
        turned = large.join(least, "a")
        small = turned.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(least.select("a", F.col("m").alias("b"))).distinct()
        now = kept(small)
        state = tuple(now.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31))).cast("bigint")).first())
        if state == last:
            return kept(now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(now.select("b", "b").distinct()))
        last = state
