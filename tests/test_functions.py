import math
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from featuremart.functions import calendar
from featuremart.functions.churn import active_churn, passive_churn
from featuremart.functions.geo import great_circle_m
from featuremart.functions.temporal import (
    closed_by,
    elapsed_hours,
    feature_month,
    open_on,
    repaired_open,
    tenure_days,
    valid_on,
)
from featuremart.functions.text import prefixed, slug
from featuremart.functions.units import to_gb

AS_OF = date(2024, 3, 31)


@pytest.mark.parametrize(
    "as_of, expected",
    [
        (date(2023, 12, 31), [date(2023, 12, 31), date(2023, 11, 30), date(2023, 10, 31)]),
        (date(2024, 2, 29), [date(2024, 2, 29), date(2024, 1, 31), date(2023, 12, 31)]),
        (date(2024, 1, 15), [date(2024, 1, 31), date(2023, 12, 31), date(2023, 11, 30)]),
    ],
)
def test_slots(as_of, expected):
    assert calendar.slots(as_of, 3) == expected


def test_month_arithmetic():
    assert calendar.window_start(date(2024, 3, 31)) == date(2023, 10, 31)
    assert calendar.add_months(date(2024, 1, 31), 1) == date(2024, 2, 29)
    assert calendar.add_months(date(2024, 1, 22), -3) == date(2023, 10, 22)
    assert calendar.month_start(date(2024, 1, 9), 1) == date(2023, 12, 1)


def test_validity_edges(spark):
    df = spark.createDataFrame(
        [
            (1, date(2024, 1, 1), None),
            (2, date(2024, 1, 1), "9999-12-31"),
            (3, date(2024, 1, 1), "2024-03-31"),  # ends on the day: closed
            (4, date(2024, 1, 1), "2024-04-01"),
            (5, date(2024, 3, 31), None),  # starts on the day: included
            (6, date(2024, 4, 1), None),
        ],
        "id int, f date, t string",
    )
    assert {r.id for r in df.where(valid_on(AS_OF, "f", "t")).collect()} == {1, 2, 4, 5}


def test_validity_of_timestamps_counts_the_whole_day(spark):
    df = spark.createDataFrame(
        [(1, datetime(2024, 3, 31, 18), None), (2, datetime(2024, 3, 1), datetime(2024, 3, 31, 18))],
        "id int, f timestamp_ntz, t timestamp_ntz",
    )
    assert {r.id for r in df.where(valid_on(AS_OF, "f", "t")).collect()} == {1}


def test_open_date_repair(spark):
    df = spark.createDataFrame(
        [
            (1, date(2010, 5, 5), date(2005, 1, 1), None),
            (2, date(1999, 12, 31), date(2005, 1, 1), date(2004, 1, 1)),
            (3, None, None, date(2006, 1, 1)),
            (4, None, None, None),
            (5, date(2000, 1, 1), date(1990, 1, 1), None),
        ],
        "id int, o date, a date, b date",
    )
    got = {r.id: r.x for r in df.select("id", repaired_open("o", ["a", "b"]).alias("x")).collect()}
    assert got == {
        1: date(2010, 5, 5),
        2: date(2004, 1, 1),
        3: date(2006, 1, 1),
        4: None,
        5: date(2000, 1, 1),
    }


def test_tenure_and_flags(spark):
    df = spark.createDataFrame(
        [
            (1, date(2024, 3, 1), None),
            (2, date(2024, 3, 1), "2024-03-11"),
            (3, date(2024, 3, 1), "2024-03-31"),
            (4, date(2024, 3, 1), "2024-04-30"),
            (5, None, "2024-04-30"),
        ],
        "id int, o date, c string",
    )
    out = df.select(
        "id", tenure_days("o", "c", AS_OF).alias("t"), closed_by("c", AS_OF).alias("x"), open_on("o", "c", AS_OF).alias("f")
    )
    got = {r.id: (r.t, r.x, r.f) for r in out.collect()}
    assert got == {1: (30, 0, 1), 2: (10, 1, 0), 3: (30, 1, 0), 4: (30, 0, 1), 5: (None, 0, 0)}


def test_elapsed_hours(spark):
    df = spark.createDataFrame(
        [(1, "open", date(2024, 1, 3)), (2, "closed", date(2024, 1, 3)), (3, "closed", None)],
        "id int, s string, e date",
    ).withColumn("b", F.lit(date(2024, 1, 1)))
    out = df.select("id", elapsed_hours("b", "e", F.col("s") == "closed").alias("h"))
    assert {r.id: r.h for r in out.collect()} == {1: 0.0, 2: 48.0, 3: None}


def test_units(spark):
    df = spark.createDataFrame(
        [(c, Decimal("1073741824.00")) for c in (1, 2, 3, 4, 5, None)], "c int, u decimal(18,2)"
    )
    got = {r.c: float(r.g) for r in df.select("c", to_gb("u", "c").alias("g")).collect()}
    assert got == {1: 0.0, 2: 0.13, 3: 1.0, 4: 1024.0, 5: 1048576.0, None: 0.0}


def test_distance_edges(spark):
    df = spark.createDataFrame(
        [
            ("same", 37.6, 55.7, 37.6, 55.7),
            ("antipodes", 0.0, 0.0, 180.0, 0.0),
            ("null", 37.6, 55.7, None, 55.7),
            ("degree", 0.0, 0.0, 0.0, 1.0),
        ],
        "id string, a double, b double, c double, d double",
    )
    cols = [F.col(c) for c in "abcd"]
    got = {r.id: r.m for r in df.select("id", great_circle_m(*cols).alias("m")).collect()}
    assert got["same"] == 0.0
    assert got["antipodes"] == pytest.approx(math.pi * 6_371_000)
    assert got["null"] is None
    assert got["degree"] == pytest.approx(math.pi / 180 * 6_371_000)


def test_distance_never_nan(spark):
    df = spark.range(2000).select(
        (54 + F.rand(1) * 10).alias("lat"), (30 + F.rand(2) * 20).alias("lon")
    )
    nudged = great_circle_m(F.col("lon"), F.col("lat"), F.col("lon") + 1e-12, F.col("lat"))
    assert df.where(F.isnan(nudged) | (nudged > 1)).count() == 0


def test_text(spark):
    row = spark.sql("select 'Dom.Ru' as a, cast(null as string) as b").select(slug("a"), slug("b"), prefixed("7", "b")).first()
    assert tuple(row) == ("domru", None, None)


def test_churn_labels(spark):
    df = spark.createDataFrame(
        [(1, date(2023, 12, 1), 0, 0, 0), (2, date(2023, 12, 31), 1, 0, 0), (3, date(2024, 1, 1), 0, 0, 5), (4, None, None, None, None)],
        "id int, c date, p0 int, p1 int, p2 int",
    )
    out = df.select(
        "id",
        active_churn("c", date(2023, 12, 15)).alias("a"),
        passive_churn(["p0", "p1", "p2"]).alias("p3"),
        passive_churn(["p0", "p1"]).alias("p2m"),
    )
    assert {tuple(r) for r in out.collect()} == {(1, 1, 1, 1), (2, 1, 0, 0), (3, 0, 0, 1), (4, 0, 1, 1)}


def test_feature_month(spark):
    row = spark.range(1).select(feature_month(F.lit(date(2024, 1, 20)), 3)).first()
    assert row[0] == date(2023, 10, 1)
