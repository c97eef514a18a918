"""Traffic volume conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit code -> how many of that unit make one gigabyte.
UNITS_PER_GB = {
    2: 8 * 1024**3,  # bits
    3: 1024**3,  # bytes
    4: 1024**2,  # kilobytes
    5: 1024,  # megabytes
}


def to_gb(units: str, unit_code: str) -> Column:
    """Gigabytes rounded to 2 digits; unknown or missing codes count as 0.

    One division per row: on decimals each further division would round again.
    """
    gb = F.lit(None)
    for code, per_gb in UNITS_PER_GB.items():
        gb = F.when(F.col(unit_code) == code, F.col(units) / F.lit(per_gb)).otherwise(gb)
    known = F.col(unit_code).isin(list(UNITS_PER_GB))
    return F.when(known, F.round(gb, 2)).otherwise(F.lit(0))
