"""Subscribers seen from two billing systems."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dual_identity(
    df: DataFrame,
    common: Sequence[str],
    roles: Mapping[int, Mapping[str, str]],
    flag: str,
    *,
    distinct: bool = True,
) -> DataFrame:
    """Each row once per role, without duplicates.

    ``roles`` maps the flag value to ``{out: source column}``. The table is read
    once and deduplicated once, flag included.
    """
    versions = F.array(
        *[
            F.struct(
                *[F.col(source).alias(out) for out, source in columns.items()],
                F.lit(value).alias(flag),
            )
            for value, columns in roles.items()
        ]
    )
    stacked = df.select(*common, F.inline(versions))
    return stacked.distinct() if distinct else stacked


def mask_by_role(df: DataFrame, when: Column, columns: Sequence[str]) -> DataFrame:
    """Keep the given columns only on rows where ``when`` holds, null elsewhere."""
    return df.withColumns({c: F.when(when, F.col(c)) for c in columns})
