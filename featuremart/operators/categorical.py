"""One-hot, presence and pivot matrices."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremart.functions.text import slug
from featuremart.operators.joins import unused

# A long holds this many flags without touching its sign bit.
_BITS = 62

# As many columns as Spark itself allows a pivot to find in the data.
MAX_PIVOT_VALUES = 10_000


def one_hot_names(values: Mapping[str, Sequence]) -> list[str]:
    """``type_1_kind_1, type_1_kind_2, …`` over the product of all value lists."""
    names = list(values)
    return ["_".join(f"{n}_{v}" for n, v in zip(names, combo)) for combo in product(*values.values())]


def _combinations(values: Mapping[str, Sequence]) -> list[Column]:
    names = list(values)
    return [
        reduce(lambda a, b: a & b, [F.col(n) == F.lit(v) for n, v in zip(names, combo)])
        for combo in product(*values.values())
    ]


def one_hot(values: Mapping[str, Sequence]) -> list[Column]:
    """0/1 columns for every combination of the listed values."""
    return [
        F.when(is_combo, 1).otherwise(0).alias(name)
        for name, is_combo in zip(one_hot_names(values), _combinations(values))
    ]


def presence_masks(values: Mapping[str, Sequence], where: Column, prefix: str) -> list[Column]:
    """Aggregates that collect which combinations occur, packed into longs.

    A row has one combination, so it is found by position in each value list
    instead of by testing all combinations.
    """
    index = F.lit(0)
    for name, allowed in values.items():
        index = index * len(allowed) + F.array_position(F.lit(list(allowed)), F.col(name)) - 1
    known = reduce(lambda a, b: a & b, [F.col(n).isin(list(v)) for n, v in values.items()])
    masks = []
    for k, name in enumerate(mask_names(values, prefix)):
        here = where & known & (index >= k * _BITS) & (index < (k + 1) * _BITS)
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (index - k * _BITS).cast("int"))
        masks.append(F.bit_or(F.when(here, bit).otherwise(F.lit(0).cast("long"))).alias(name))
    return masks


def presence_columns(values: Mapping[str, Sequence], prefix: str) -> list[Column]:
    """The 0/1 columns held in the masks of :func:`presence_masks`; null where the mask is null."""
    return [
        F.expr(f"cast(shiftright({prefix}{i // _BITS}, {i % _BITS}) & 1 as int) as `{name}`")
        for i, name in enumerate(one_hot_names(values))
    ]


def mask_names(values: Mapping[str, Sequence], prefix: str) -> list[str]:
    return [f"{prefix}{k}" for k in range(-(-len(one_hot_names(values)) // _BITS))]


def presence_matrix(
    df: DataFrame, keys: Sequence[str], values: Mapping[str, Sequence]
) -> DataFrame:
    """Per key, 1 for every combination that occurs in at least one row.

    Only a few longs per key are shuffled, not one column per combination.
    """
    masks = presence_masks(values, F.lit(True), "_mask")
    return df.groupBy(*keys).agg(*masks).select(*keys, *presence_columns(values, "_mask"))


def flags(df: DataFrame, col: str, names: Mapping[str, object]) -> DataFrame:
    """Add ``{out: value}`` columns: 1 where ``col`` has the value."""
    return df.withColumns({n: F.when(F.col(col) == F.lit(v), 1).otherwise(0) for n, v in names.items()})


def ever_flag(df: DataFrame, keys: Sequence[str], name: str, cond: Column | None = None) -> DataFrame:
    """The keys that have any row, or any row with ``cond``, marked 1."""
    kept = df if cond is None else df.where(cond)
    return kept.select(*keys).distinct().withColumn(name, F.lit(1))


def contact_counts(df: DataFrame, keys: Sequence[str], dim: str, measure: str, out: str) -> DataFrame:
    """Sum of ``measure`` per key and cleaned dimension name."""
    return df.groupBy(*keys, slug(dim).alias(dim)).agg(F.sum(measure).alias(out))


def dictionary_values(df: DataFrame, col: str, max_values: int = MAX_PIVOT_VALUES) -> list:
    """The distinct values of a column in order; too many raise an error."""
    rows = df.select(col).where(F.col(col).isNotNull()).distinct().limit(max_values + 1).collect()
    if len(rows) > max_values:
        raise ValueError(f"{col} has more than {max_values} values")
    return sorted(r[0] for r in rows)


def listed(label: Column, values: Sequence, other: str | None) -> Column:
    """The label if it is listed, else ``other`` or an error."""
    rest = F.raise_error(F.concat(F.lit("not a listed value: "), F.coalesce(label.cast("string"), F.lit("null")))).cast("string")
    return F.when(label.isin(list(values)), label).otherwise(rest if other is None else F.lit(other))


def pivot_counts(
    df: DataFrame,
    keys: Sequence[str],
    dim: str,
    measure: str,
    prefix: str,
    values: Sequence | None = None,
    *,
    other: str | None = None,
) -> DataFrame:
    """Sums per key, one ``prefix + value`` column per value.

    Without ``values`` they are looked up first, so the columns follow the data;
    with them the schema is fixed and the lookup job is saved. Rows whose value
    is null or not listed are summed under ``other``; without it they raise an
    error, so none is lost in silence.
    """
    values = dictionary_values(df, dim) if values is None else list(values)
    label = listed(F.col(dim), values, other)
    if other is not None:
        values = [*values, other]
    narrow = df.select(*keys, label.alias("_label"), F.col(measure).alias("_measure"))
    wide = narrow.groupBy(*keys).pivot("_label", values).agg(F.sum("_measure"))
    return wide.select(*keys, *[F.col(f"`{v}`").alias(f"{prefix}{v}") for v in values])


def contact_matrix(
    sources: Sequence[tuple[DataFrame, str, str, str, Sequence[str] | None]],
    key: str,
    *,
    other: str | None = None,
) -> DataFrame:
    """Several contact tables as one wide table, absent pairs 0.

    Each source is ``(frame, dimension, measure, prefix, values)``. Names that
    are null or not listed are summed under ``other``, or raise an error. The sources
    are stacked in long form and pivoted once; pivoting each and joining them
    outer gives the same rows with two more wide shuffles.
    """
    parts, columns = [], []
    for df, dim, measure, prefix, values in sources:
        cleaned = df.select(key, slug(dim).alias("_name"), F.col(measure).alias("_measure"))
        names = dictionary_values(cleaned, "_name") if values is None else list(values)
        columns += [prefix + n for n in ([*names, other] if other is not None else names)]
        parts.append(cleaned.withColumn("_name", F.concat(F.lit(prefix), listed(F.col("_name"), names, other))))
    stacked = reduce(DataFrame.unionByName, parts)
    wide = stacked.groupBy(key).pivot("_name", columns).agg(F.sum("_measure"))
    return wide.fillna(0, columns)


def category_matrix(
    df: DataFrame,
    keys: Sequence[str],
    category: str,
    metrics: Mapping[str, str],
    values: Sequence[int],
    *,
    shuffle_by: str | None = None,
) -> DataFrame:
    """Sums of several metrics per key and category; nulls and NaN count as 0.

    ``metrics`` maps a metric to its column name with ``{}`` for the category.
    Keys that have only other categories keep a row of zeros. The rows are reduced
    to one per key and category and gathered as :func:`category_vectors`, whose
    entries become columns in the last projection: an aggregation of wide rows
    would hold every column of every key of a task.
    With ``shuffle_by``, one of the keys, the result is already partitioned for
    a join on that column and its many columns are not shuffled again.
    """
    vector = unused("_vector", df)
    gathered = category_vectors(df, keys, category, list(metrics), values, vector, shuffle_by=shuffle_by)
    return spread_vectors(gathered, vector, metrics, values)


def _clean(metric: str) -> Column:
    return F.coalesce(F.nanvl(F.col(metric).cast("double"), F.lit(0.0)), F.lit(0.0))


def _vectors(long: DataFrame, keys: Sequence[str], category: str, metrics: Sequence[str], out: str, shuffle_by: str | None) -> DataFrame:
    entries = long.groupBy(*keys, category).agg(*[F.sum(m).alias(m) for m in metrics])
    if shuffle_by is not None:
        entries = entries.repartition(shuffle_by)
    # an entry without a category only keeps its key
    entry = F.when(F.col(category).isNotNull(), F.struct(F.col(category).cast("int").alias("category"), *metrics))
    return entries.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias(out))


def category_vectors(
    df: DataFrame,
    keys: Sequence[str],
    category: str,
    metrics: Sequence[str],
    values: Sequence[int],
    out: str = "vector",
    *,
    shuffle_by: str | None = None,
) -> DataFrame:
    """The sums of :func:`category_matrix` as one sorted array of ``(category, metrics...)`` per key.

    Only categories a key has take room, so a join or shuffle moves what there is
    and not a column per category and metric. A null or unlisted category counts
    for nothing, but its key keeps a row (an empty array).
    """
    listed_only = F.when(F.col(category).isin(list(values)), F.col(category)).alias(category)
    narrow = df.select(*keys, listed_only, *[_clean(m).alias(m) for m in metrics])
    return _vectors(narrow, keys, category, metrics, out, shuffle_by)


def merge_vectors(df: DataFrame, keys: Sequence[str], vector: str = "vector", *, shuffle_by: str | None = None) -> DataFrame:
    """Add up the vectors of all rows of a key: of months, regions or any finer key. Null vectors are empty."""
    metrics = [f.name for f in df.schema[vector].dataType.elementType.fields if f.name != "category"]
    entry = unused("_entry", df)
    long = df.select(*keys, F.explode_outer(vector).alias(entry)).select(*keys, f"{entry}.*")
    return _vectors(long, keys, "category", metrics, vector, shuffle_by)


def spread_vectors(df: DataFrame, vector: str, metrics: Mapping[str, str], values: Sequence[int]) -> DataFrame:
    """Replace a vector by a column per category and metric, 0 where it has no entry or is null.

    ``metrics`` maps a metric to its column name with ``{}`` for the category.
    Meant for the sink: a projection of the finished row, without an aggregation
    over the wide row.
    """
    held = unused("_held", df)
    by_category = F.map_from_entries(F.transform(vector, lambda e: F.struct(e["category"], e)))
    placed = df.withColumn(held, by_category)
    # as text: hundreds of column objects take longer to build than the job takes to run
    columns = [
        f"coalesce(`{held}`[{int(v)}].`{m}`, 0d) as `{name.format(v)}`"
        for v in values
        for m, name in metrics.items()
    ]
    return placed.selectExpr(*[f"`{c}`" for c in df.columns if c != vector], *columns)
