"""Entity rollup driven by a column -> rule mapping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# "first" is the first non-null value of a column that has one per entity. The
# least value is that value, and stays the same on every run if there are more.
# "bits" merges the packed flags of a presence matrix.
RULES = {"first": "min", "max": "max", "min": "min", "sum": "sum", "bits": "bit_or"}


def _row(columns: Mapping[str, Column]) -> Column:
    """The columns as a struct, null if none has a value."""
    known = reduce(lambda a, b: a | b, [c.isNotNull() for c in columns.values()])
    return F.when(known, F.struct(*[c.alias(name) for name, c in columns.items()]))


def least_row(columns: Sequence[str]) -> Column:
    """The least combination of the columns among the rows that have any of them, as a struct."""
    return F.min(_row({c: F.col(c) for c in columns}))


def _row_groups(spec: Mapping[str, str]) -> dict[str, list[str]]:
    groups: dict[str, list[str]] = {}
    for c, rule in spec.items():
        if rule.startswith("row:"):
            groups.setdefault(rule, []).append(c)
    return groups


def rollup_entity(df: DataFrame, keys: Sequence[str], spec: Mapping[str, str]) -> DataFrame:
    """One row per entity; ``spec`` maps each column to a rule of ``RULES``, or to ``row:name``.

    Columns with the same ``row:name`` come from one and the same row: the one
    with the least values in the order of ``spec``.
    """
    groups = _row_groups(spec)
    single = [F.expr(f"{RULES[rule]}(`{c}`) as `{c}`") for c, rule in spec.items() if rule not in groups]
    rows = [least_row(columns).alias(f"_{rule}") for rule, columns in groups.items()]
    out = df.groupBy(*keys).agg(*single, *rows)
    pick = lambda c, rule: F.col(f"`_{rule}`.`{c}`").alias(c) if rule in groups else F.col(f"`{c}`")
    return out.select(*[f"`{k}`" for k in keys], *[pick(c, rule) for c, rule in spec.items()])


def pair_is_exact(kind: T.DataType) -> bool:
    """Whether two values of the type add up without a loss of digits."""
    return not (isinstance(kind, T.DecimalType) and kind.precision == 38 and kind.scale > 6)


def rollup_pair(
    spec: Mapping[str, str], left: Mapping[str, Column], right: Mapping[str, Column], types: Mapping[str, T.DataType]
) -> list[Column]:
    """What :func:`rollup_entity` gives for an entity of just two rows, without an aggregation.

    ``left`` and ``right`` hold each column of ``spec`` as the one and the other row have it, ``types`` those of the result.
    """
    groups = _row_groups(spec)
    firsts = {rule: F.least(*[_row({c: side[c] for c in columns}) for side in (left, right)]) for rule, columns in groups.items()}

    def total(a: Column, b: Column, kind: T.DataType) -> Column:
        # decimals of the rows are narrower than their sum
        a, b = (x if isinstance(kind, T.DecimalType) else x.cast(kind) for x in (a, b))
        return F.coalesce(a + b, a, b)

    def merged(c: str, rule: str) -> Column:
        a, b = left[c], right[c]
        if rule in groups:
            return firsts[rule].getField(c)
        if rule == "sum":
            return total(a, b, types[c])
        if rule == "bits":
            return F.coalesce(a.bitwiseOR(b), a, b)
        return F.greatest(a, b) if RULES[rule] == "max" else F.least(a, b)

    return [merged(c, rule).cast(types[c]).alias(c) for c, rule in spec.items()]
