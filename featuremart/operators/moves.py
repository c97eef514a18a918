"""Distances between the places of different months."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column
from pyspark.sql import functions as F

from featuremart.functions.geo import great_circle_m


def pair_moves(places: Sequence[str] = ("home", "work"), n: int = 4) -> list[Column]:
    """``home_diff_0_1``, ``work_diff_0_1``, … in metres, for every pair of months.

    Expects ``{place}_lat_{k}`` and ``{place}_lon_{k}`` columns.
    """
    return [
        great_circle_m(
            F.col(f"{p}_lon_{a}"), F.col(f"{p}_lat_{a}"), F.col(f"{p}_lon_{b}"), F.col(f"{p}_lat_{b}")
        ).alias(f"{p}_diff_{a}_{b}")
        for a, b in combinations(range(n), 2)
        for p in places
    ]
