"""Mixing sources to target weights by hierarchical budgeting.

The tree is domain, language, source (any list of columns). Each node's token
budget is dealt to its children by weight. A child that can't use its part
(all its tokens, times the epochs allowed) takes what it has, and the rest is
dealt among its siblings; only what all siblings together can't use has made
their parent's capacity small and so goes to the parent's siblings. A leaf then
takes whole epochs and, of the next epoch's seeded order, the longest prefix
that fits.

Only ids and token counts are shuffled. The prefix is found from 4096 key
ranges per leaf, so a leaf with a third of all rows is never sorted in one task.
What travels back to the documents is one row per leaf: the whole epochs and
the last key of the prefix.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featuremart.llm.common import checkpointed, fresh, group_key, running_offsets, small_enough

#: Leaves that are sent to every task; beyond it the leaf table is joined by a shuffle.
LEAVES_SENT = 100_000


def _weight(path: Column, weights: Mapping[str, int]) -> Column:
    if not weights:
        return F.lit(1.0)
    given = F.create_map(*(F.lit(x) for pair in weights.items() for x in (pair[0], float(pair[1]))))
    return F.coalesce(F.element_at(given, path), F.lit(1.0))


def deal(children: DataFrame, parent: str, weight: str, capacity: str, budget: str, out: str) -> DataFrame:
    """Water filling: ``budget`` of each parent over its children, none above its capacity.

    A child is full if its capacity is at most its part of what is left after
    all children that fill earlier, by capacity per weight.
    """
    order = Window.partitionBy(parent).orderBy(F.col(capacity) / F.col(weight), capacity, "path")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.col(budget) - F.coalesce(F.sum(capacity).over(before), F.lit(0.0))
    rows = children.withColumn("_full", F.col(capacity) * F.sum(weight).over(after) <= F.col(weight) * left)
    whole = Window.partitionBy(parent)
    rest = F.col(budget) - F.coalesce(F.sum(F.when(F.col("_full"), F.col(capacity))).over(whole), F.lit(0.0))
    open_weight = F.sum(F.when(~F.col("_full"), F.col(weight))).over(whole)
    part = F.when(F.col("_full"), F.col(capacity)).otherwise(F.least(F.col(capacity), F.floor(F.col(weight) * rest / open_weight).cast("double")))
    return rows.withColumn(out, part).drop("_full")


def leaf_budgets(leaves: DataFrame, levels: int, budget: float | Column, epochs: int, weights: Mapping[str, int]) -> DataFrame:
    """``leaf, available, budget`` from ``leaf`` (levels joined by ``|``) and ``available`` tokens."""
    up = lambda k: F.substring_index("leaf", "|", k)
    rows = leaves.withColumn("_cap", (F.col("available") * epochs).cast("double"))
    top = rows.agg(F.coalesce(F.sum("_cap"), F.lit(0.0)).alias("_all"), F.coalesce(F.sum("available"), F.lit(0)).cast("double").alias("_tokens"))
    wanted = budget if isinstance(budget, Column) else F.lit(float(budget))
    given = top.select(F.lit("").alias("parent"), F.least(F.col("_all"), F.floor(wanted).cast("double")).alias("_budget"))
    for k in range(1, levels + 1):
        nodes = rows.groupBy(up(k).alias("path")).agg(F.sum("_cap").alias("_cap"))
        nodes = nodes.withColumn("parent", F.substring_index("path", "|", k - 1) if k > 1 else F.lit("")).withColumn("_w", _weight(F.col("path"), weights))
        given = deal(nodes.join(given, "parent"), "parent", "_w", "_cap", "_budget", "_part").select(F.col("path").alias("parent"), F.col("_part").alias("_budget"))
    return leaves.join(given.select(F.col("parent").alias("leaf"), F.col("_budget").cast("bigint").alias("budget")), "leaf")


def mix(
    docs: DataFrame,
    tree: Sequence[str],
    tokens: Column,
    share: float = 0.5,
    epochs: int = 1,
    weights: Mapping[str, int] | None = None,
    seed: int = 7,
    id: str = "doc_id",
) -> DataFrame:
    """``docs`` with ``epochs_used`` (1 or more) and ``token_count`` for each document of the mixture.

    ``share`` sets the budget as a part of all tokens; ``weights`` maps a path
    such as ``=web|=en`` (values marked ``=``, null is ``~``) to a weight above
    0, 1 if absent. Prefixes hold documents whole and never exceed the leaf's
    budget; rows with equal keys (a repeated id) come or stay together. Texts
    without tokens cost nothing and belong to a prefix like others. A null in a
    tree column is a value of its own; a null token count is 0.
    """
    if any(w <= 0 for w in (weights or {}).values()):
        raise ValueError("weights must be above 0")
    leaf, cut, used, count, key = fresh(docs, "leaf", "cut", "used", "count", "key")
    order = lambda epoch: F.md5(F.encode(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col(id).cast("string"), F.lit(""))), "utf-8"))
    marked = docs.withColumn(leaf, group_key(tree)).withColumn(count, F.coalesce(tokens.cast("bigint"), F.lit(0)))
    # the one pass that reads texts to count: what follows works on three short columns
    light = checkpointed(marked.select(F.col(leaf).alias("leaf"), F.col(count).alias("n"), F.col(id)))
    leaves = light.groupBy("leaf").agg(F.sum("n").alias("available"))
    budgets = leaf_budgets(leaves, len(tree), F.col("_tokens") * share, epochs, weights or {})
    plan = budgets.withColumn("whole", F.when(F.col("available") > 0, F.expr("budget div available")).otherwise(epochs - 1))
    plan = checkpointed(plan.withColumn("rest", F.when(F.col("available") > 0, F.col("budget") - F.col("whole") * F.col("available")).otherwise(0)))
    rows = light.join(small_enough(plan, LEAVES_SENT), "leaf").withColumn("key", order(F.col("whole")))
    rows = rows.withColumn("cut", F.substring("key", 1, 3))
    offsets = running_offsets(rows, "leaf", "cut", F.sum("n"), "before", "total").drop("total")
    # equal keys are peers of the frame, so they are counted together
    inside = Window.partitionBy("leaf", "cut").orderBy("key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    fits = rows.join(offsets, ["leaf", "cut"]).withColumn("sum", F.col("before") + F.sum("n").over(inside)).where(F.col("sum") <= F.col("rest"))
    border = fits.groupBy("leaf").agg(F.max("key").alias("border"))
    chosen = plan.join(border, "leaf", "left").select(F.col("leaf").alias(leaf), F.col("whole").alias(used), F.col("border").alias(key))
    chosen = small_enough(checkpointed(chosen), LEAVES_SENT)
    taken = F.col(used) + F.when(order(F.col(used)) <= F.col(key), 1).otherwise(0)
    out = marked.join(chosen, leaf).withColumn(used, F.least(taken, F.lit(epochs)).cast("int")).where(F.col(used) > 0)
    return out.drop(leaf, key).withColumnsRenamed({used: "epochs_used", count: "token_count"})
