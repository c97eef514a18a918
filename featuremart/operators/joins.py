"""Left-join assembly, full-outer merge, spines and anti-joins."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A joined row set whose size is known and small enough to send to every task.
MAX_SPINE_ROWS = 10_000


def stack(*frames: DataFrame) -> DataFrame:
    """Union of frames with the same column names, whatever their order."""
    return reduce(DataFrame.unionByName, frames)


def _refuse_clash(base: DataFrame, right: DataFrame, keys: Sequence[str]) -> None:
    clash = (set(base.columns) & set(right.columns)) - set(keys)
    if clash:
        raise ValueError(f"both sides have {sorted(clash)}")


def enrich(base: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join; columns that both sides have besides the keys are refused."""
    _refuse_clash(base, right, keys)
    return base.join(right, list(keys), "left")


def assemble(base: DataFrame, blocks: Iterable[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Left-join blocks onto a spine; each block must be unique on its keys.

    Put blocks with other keys first and those sharing keys last: joins on the
    same keys then reuse one shuffle of the spine.
    """
    return reduce(lambda spine, block: enrich(spine, *block), blocks, base)


def _same_key(keys: Sequence[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys])


def _prefixed(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return df.select(*[F.col(k).alias(prefix + k) for k in keys])


def unused(name: str, *frames: DataFrame) -> str:
    """``name`` or, if a frame has such a column, a longer one that none has."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _key_hash(keys: Sequence[str], like: DataFrame) -> Column:
    """Hash of the keys as values of the types they have in ``like``: equal keys of other types hash alike."""
    return F.xxhash64(*[F.col(k).try_cast(like.schema[k].dataType) for k in keys])


def _spread(left: DataFrame, keys: Sequence[str], by: Sequence[str] | None) -> Column:
    """The hash of the keys, or of the whole row (or ``by``) where a key is null."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return F.when(missing, F.xxhash64(*(by or left.columns))).otherwise(_key_hash(keys, left))


def assemble_known(
    base: DataFrame, blocks: Sequence[tuple[DataFrame, Sequence[str]]], spread_by: Sequence[str] | None = None
) -> DataFrame:
    """:func:`assemble` for a base whose keys may be null.

    Rows with a null key match nothing. The hash of the key joins too, and for
    those rows it is the hash of ``spread_by`` (the whole row by default), so
    that they don't meet in one task. The base is read and, for neighbouring
    blocks with the same keys, shuffled once.
    """
    out = base
    for keys, group in groupby(blocks, key=lambda block: tuple(block[1])):
        group = [block for block, _ in group]
        name = unused("_spread", out, *group)
        out = out.withColumn(name, _spread(out, keys, spread_by or base.columns))
        hashed = [(block.withColumn(name, _key_hash(keys, out)), [*keys, name]) for block in group]
        out = assemble(out, hashed).drop(name)
    return out


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Left, semi or anti join in which neither null keys nor hot keys fill one task.

    The hash of the key joins too. For rows with a null key, which match nothing
    but would all meet in one task, it is the hash of ``spread_by`` (the whole
    row by default) instead. The extra key also has both sides shuffled for this
    join alone, even where ``right`` is an aggregate, and between two such
    shuffles adaptive execution splits the hot keys of ``left``.
    """
    name = unused("_spread", left, right)
    placed = left.withColumn(name, _spread(left, keys, spread_by))
    other = right.withColumn(name, _key_hash(keys, left))
    return placed.join(other, [*keys, name], how).drop(name)


def enrich_spread(
    base: DataFrame, right: DataFrame, keys: Sequence[str], spread_by: Sequence[str] | None = None
) -> DataFrame:
    """:func:`enrich` as a :func:`spread_join`."""
    _refuse_clash(base, right, keys)
    return spread_join(base, right, keys, "left", spread_by)


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    target: Column,
    month: str,
    *,
    within: int | None = None,
    out: str = "feature_month",
) -> DataFrame:
    """Left join with each key's newest snapshot of a month not later than ``target``.

    ``right`` is unique on the keys and ``month`` (a date or its ISO text); its
    rows that are more than ``within`` months older than ``target`` don't count.
    ``out`` holds the month found, null if there is none. A key's months are
    gathered from the narrow key columns alone, as a short array; the wide rows
    then join on key and month, each at most once. Null keys and a null target
    match nothing and are spread over all tasks.
    """
    held, want, at = (unused(c, left, right) for c in ("_held", "_want", "_at"))
    day = F.col(month).cast("date")
    months = right.select(*keys, day.alias(at)).groupBy(*keys).agg(F.collect_set(at).alias(held))
    known = enrich_spread(left.withColumn(want, target.cast("date")), months, keys)
    fits = F.filter(held, lambda m: m <= F.col(want))
    if within is not None:
        fits = F.filter(fits, lambda m: m >= F.add_months(F.col(want), -within))
    placed = known.withColumn(at, F.array_max(fits)).drop(held, want)
    joined = assemble_known(placed, [(right.withColumn(at, day).drop(month), [*keys, at])])
    return joined.withColumnRenamed(at, out)


def attach_history(
    df: DataFrame, history: DataFrame, keys: Sequence[str], drop: Sequence[str] = ()
) -> DataFrame:
    """Left join of a history table without its clashing columns."""
    return enrich(df, history.drop(*drop), keys)


def attach_flags(df: DataFrame, flags: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Left-join several flag tables on the same keys."""
    return assemble(df, [(f, keys) for f in flags])


def merge_counters(blocks: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Left-join counter blocks onto the first of them."""
    return assemble(blocks[0], [(b, keys) for b in blocks[1:]])


def attach_by(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Inner join that brings ``right`` onto the rows of ``left``."""
    keys = [key] if isinstance(key, str) else list(key)
    return left.join(right, keys, "inner")


def full_merge(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full-outer merge into one row per key.

    The frames are stacked and aggregated once: a chain of outer joins would
    shuffle again after each step, because the merged key is a new column. A
    frame that repeats a key contributes the greatest value of each column, so
    frames of several columns that belong together must be unique on the keys.
    """
    columns = [c for f in frames for c in f.columns if c not in keys]
    if len(columns) != len(set(columns)):
        raise ValueError("frames share a column besides the keys")
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in columns])


def spine(df: DataFrame, small: DataFrame, max_rows: int = MAX_SPINE_ROWS) -> DataFrame:
    """Every row with every row of a small calendar or category table.

    The size of ``small`` is checked before it is broadcast.
    """
    if small.limit(max_rows + 1).count() > max_rows:
        raise ValueError(f"a spine may have at most {max_rows} rows")
    return df.crossJoin(F.broadcast(small))


def holdout(
    df: DataFrame, taken: DataFrame, keys: Sequence[str], *, null_safe: bool = False
) -> DataFrame:
    """Rows of ``df`` whose key is not taken.

    A null in a key never matches, so such rows stay; ``null_safe`` lets nulls
    match each other.
    """
    used = taken.select(*keys).distinct()
    if not null_safe:
        return spread_join(df, used, keys, "left_anti")
    return df.join(_prefixed(used, keys, "_taken_"), _same_key(keys, "_taken_"), "left_anti")


def fill_typed(
    df: DataFrame,
    num: float | int | None = None,
    text: str | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Fill nulls by type: numbers (NaN too) with ``num``, strings with ``text``.

    Dates and booleans are never filled.
    """
    subset = list(columns) if columns is not None else None
    if num is not None:
        df = df.fillna(num, subset)
    return df.fillna(text, subset) if text is not None else df


def stamp(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Add constant columns such as the build date and the business month."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def explode_list(df: DataFrame, col: str | Column, name: str) -> DataFrame:
    """One row per list element, next to the other columns."""
    source = F.col(col) if isinstance(col, str) else col
    rest = [c for c in df.columns if c not in (col, name)] if isinstance(col, str) else df.columns
    return df.select(*rest, F.explode(source).alias(name))
