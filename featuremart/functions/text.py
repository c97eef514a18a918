"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slug(col: str | Column) -> Column:
    """Lower-case name without dots, fit for a column name."""
    return F.lower(F.replace(F.col(col) if isinstance(col, str) else col, F.lit("."), F.lit("")))


def prefixed(prefix: str, col: str | Column) -> Column:
    """Text with a fixed prefix, such as a country code; null stays null."""
    col = F.col(col) if isinstance(col, str) else col
    return F.concat(F.lit(prefix), col.cast("string"))
