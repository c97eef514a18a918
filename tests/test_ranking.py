import random
from datetime import date, timedelta
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from featuremart.operators import profile, quality, ranking
from featuremart.operators.labels import class_counts, label_share
from featuremart.operators.ranking import Cohort, first_rows
from featuremart.operators.sampling import downsample


def test_global_numbers_equal_the_window(spark):
    df = spark.range(5000).select("id", (F.rand(4) * 50).cast("int").alias("v"))
    ours = ranking.global_row_number(df, [F.col("v").desc(), "id"], unique=True)
    theirs = df.withColumn("row_num", F.row_number().over(Window.orderBy(F.col("v").desc(), "id")))
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, theirs.collect()))


def test_equal_rows_get_distinct_numbers(spark):
    """A third and more of the rows are copies of one row."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).alias("v"))
    out = ranking.global_row_number(df, ["v"])
    numbers = sorted(r.row_num for r in out.collect())
    assert numbers == list(range(1, 3001))
    ordered = [r.v for r in out.orderBy("row_num").collect()]
    assert ordered == sorted(ordered)


@pytest.mark.parametrize("n", [0, 1, 137, 999, 1000, 5000])
def test_cap_is_exact_and_repeatable(spark, n):
    df = spark.range(1000)
    first = {r.id for r in ranking.cap_rows(df, n, ["id"], seed=1).collect()}
    again = {r.id for r in ranking.cap_rows(df.repartition(7), n, ["id"], seed=1).collect()}
    assert len(first) == min(n, 1000) and first == again


def test_cap_of_copies(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("id"))
    assert ranking.cap_rows(df, 700, ["id"]).count() == 700
    assert ranking.cap_rows(df, None, ["id"]) is df


def test_cohorts_are_disjoint(spark):
    df = spark.range(100).select("id")
    plan = [ranking.Cohort(date(2025, 8, 1), 40, 4), ranking.Cohort(date(2025, 9, 1), 20, 2), ranking.Cohort(date(2025, 10, 1), 70, 5)]
    out = ranking.monthly_cohorts(df, ["id"], plan, "y", "m", unique=True).toPandas()
    assert out.id.is_unique
    assert out.groupby("m").agg(n=("y", "size"), p=("y", "sum"), top=("row_num", "max")).values.tolist() == [
        [40, 4, 40],
        [20, 2, 20],
        [40, 5, 40],  # the rest of the table is smaller than asked for
    ]


def labelled(spark, positives, negatives):
    return spark.range(positives + negatives).select("id", (F.col("id") < positives).cast("int").alias("y"))


def test_downsampling(spark):
    df = labelled(spark, 100, 5000)
    first = downsample(df, "y", 10, ["id"], seed=3)
    assert first.where("y = 1").count() == 100
    assert 900 <= first.where("y = 0").count() <= 1100
    again = downsample(df.repartition(5), "y", 10, ["id"], seed=3)
    assert {r.id for r in first.collect()} == {r.id for r in again.collect()}
    other = downsample(df, "y", 10, ["id"], seed=4)
    assert {r.id for r in first.collect()} != {r.id for r in other.collect()}


@pytest.mark.parametrize("positives, negatives, kept", [(10, 0, 10), (0, 10, 0), (10, 50, 60)])
def test_downsampling_edges(spark, positives, negatives, kept):
    assert downsample(labelled(spark, positives, negatives), "y", 10, ["id"]).count() == kept


def lift_by_hand(frame: pd.DataFrame, n: int) -> pd.DataFrame:
    """Buckets by position in the sorted table, as an independent check."""
    ordered = frame.sort_values(["score", "id"], ascending=[False, True])
    parts = np.array_split(ordered.y.to_numpy(), n)
    out = pd.DataFrame({"target_cnt": [p.sum() for p in parts], "cnt": [len(p) for p in parts]})
    overall = frame.y.mean()
    out["lift"] = out.target_cnt / out.cnt / overall
    out["coverage"] = out.target_cnt.cumsum() / frame.y.sum()
    out["cum_lift"] = out.target_cnt.cumsum() / out.cnt.cumsum() / overall
    return out


@pytest.mark.parametrize("rows", [23, 200, 1001])
def test_lift_table(spark, rows):
    rnd = random.Random(rows)
    frame = pd.DataFrame(
        [(i, rnd.randrange(10) / 10, int(rnd.random() < 0.4)) for i in range(rows)], columns=["id", "score", "y"]
    )
    df = spark.createDataFrame(frame)
    got = quality.lift_table(df, "y", "score", ["id"], unique=True).orderBy("top").toPandas()
    expected = lift_by_hand(frame, 10)
    assert got.top.tolist() == list(range(1, 11))
    for c in expected.columns:
        assert np.allclose(got[c].astype(float), expected[c].astype(float)), c
    if rows == 23:
        assert got.cnt.tolist() == [3, 3, 3, 2, 2, 2, 2, 2, 2, 2]


def test_lift_with_fewer_rows_than_buckets(spark):
    df = spark.createDataFrame([(1, 0.9, 1), (2, 0.1, 0)], "id int, score double, y int")
    got = quality.lift_table(df, "y", "score", ["id"], unique=True).orderBy("top").collect()
    assert [(r.top, r.cnt, r.target_cnt) for r in got] == [(1, 1, 1), (2, 1, 0)]


def test_confusion(spark):
    df = spark.createDataFrame(
        [(1, 0.9), (1, 0.5), (0, 0.6), (0, None), (0, 0.1)], "y int, p double"
    )
    assert [tuple(r) for r in quality.confusion(df, "y", "p").collect()] == [("act_POS", 1, 1), ("act_NEG", 1, 2)]
    only = quality.confusion(df.where("y = 1"), "y", "p").collect()
    assert tuple(only[1]) == ("act_NEG", 0, 0)


def test_profile(spark):
    df = spark.createDataFrame(
        [(1, "a", None), (2, "a", None), (3, "b", None), (4, None, None)], "i int, s string, e string"
    )
    got = {r["column"]: tuple(r)[1:] for r in profile.column_profile(df).collect()}
    assert got == {"i": (4, 1.0, 0.25), "s": (2, 0.75, 2 / 3), "e": (0, 0.0, 0.0)}
    near = {r["column"]: tuple(r)[1:] for r in profile.column_profile(df, approx=True).collect()}
    assert near == got
    assert profile.column_profile(df.limit(0), approx=True).count() == 0
    chosen = profile.select_features(profile.column_profile(df), min_fill=0.7, exclude=["i"])
    assert [r["column"] for r in chosen.collect()] == ["s"]
    nulls = {r.name: (r.non_null_cnt, r.dtype) for r in profile.null_profile(df).collect()}
    assert nulls == {"i": (4, "int"), "s": (3, "string"), "e": (0, "string")}


def test_metric_pivot_averages_repeats(spark):
    df = spark.createDataFrame(
        [("a", "n_unique", 2.0), ("a", "n_unique", 4.0), ("a", "fill_rate", 1.0)], "column string, metric string, value double"
    )
    assert tuple(profile.metric_pivot(df).first()) == ("a", 3.0, 1.0, None)


def test_label_reports(spark):
    df = spark.createDataFrame([("m", 1), ("m", 0), ("m", 0)], "month string, y int")
    assert {tuple(r) for r in class_counts(df, ["month"], "y").collect()} == {("m", 1, 1), ("m", 0, 2)}
    assert tuple(label_share(df, ["month"], "y").first()) == ("m", 1, 3, 33.33)


KINDS = {
    "a": ("int", lambda r: r.choice([None, 5, 5, 5, r.randrange(-(2**31), 2**31)])),
    "b": ("bigint", lambda r: r.choice([2**62, -(2**62), 2**62 + r.randrange(9), r.randrange(99)])),
    "c": ("string", lambda r: r.choice([None, "", "ab", "abé", "日本", "ab" + str(r.randrange(99))])),
    "d": ("double", lambda r: r.choice([None, 0.0, -1e300, 1e300, r.random(), float("inf")])),
    "e": ("date", lambda r: r.choice([None, date(2001, 1, 1) + timedelta(r.randrange(900))])),
    "f": ("decimal(20,4)", lambda r: r.choice([None, Decimal(r.randrange(10**9)) / 10000, Decimal("1.5000")])),
    "g": ("boolean", lambda r: r.choice([None, True, False])),
}


@pytest.mark.parametrize("order", ["a", "abc", "cb", "dea", "ef", "gb", "fcd"])
def test_first_rows(spark, order):
    """All wanted rows pass, and few others."""
    rnd = random.Random(order)
    rows = [tuple(make(rnd) for _, make in KINDS.values()) + (i,) for i in range(800)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, (t, _) in KINDS.items()) + ", i int").cache()
    key = lambda r: tuple((r["abcdefg".index(c)] is not None, 0 if r["abcdefg".index(c)] is None else r["abcdefg".index(c)]) for c in order)
    ranked = sorted(rows, key=key)
    for n, room in ((1, 0), (37, 5), (400, 0), (799, 0), (800, 0), (5000, 10)):
        got = first_rows(df, list(order), n, room).collect()
        wanted = {r[-1] for r in ranked if key(r) <= key(ranked[min(n, 800) - 1])}
        assert {r.i for r in got} >= {r[-1] for r in ranked[:n]}
        if "g" not in order and "d" not in order:  # these have values without a histogram
            assert len(got) <= max(n + room, len(wanted))
    df.unpersist()


def test_first_rows_of_nothing(spark):
    none = spark.createDataFrame([], "a int, i int")
    assert first_rows(none, ["a"], 5, 0).count() == 0


def test_cohorts_number_only_what_they_need(spark, monkeypatch):
    monkeypatch.setattr(ranking, "ROOM", 10)
    seen, number = [], ranking.global_row_number
    monkeypatch.setattr(ranking, "global_row_number", lambda df, *a, **k: seen.append((df.columns, df.count())) or number(df, *a, **k))
    rows = [(None if i == 7 else i, f"x{i}", i % 3) for i in range(5000)]
    df = spark.createDataFrame(rows, "k int, wide string, _rank int").repartition(8)
    cohorts = [Cohort(date(2001, 5, 1), 30, 3), Cohort(date(2001, 6, 1), 20, 2)]
    got = ranking.monthly_cohorts(df, ["k"], cohorts, unique=True).collect()
    assert seen[0][0] == ["k"] and seen[0][1] <= 60
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))[:50]
    want = {(*r, (i if i < 30 else i - 30) + 1, int((i if i < 30 else i - 30) < (3 if i < 30 else 2)), date(2001, 5 + (i >= 30), 1)) for i, r in enumerate(order)}
    assert {(r.k, r.wide, r._rank, r.row_num, r.target_active_churn, r.table_business_month) for r in got} == want
    ties = ranking.monthly_cohorts(df.union(df), ["k"], cohorts).collect()
    assert len(ties) == 50 and sorted(r.k for r in ties if r.k is not None) == sorted([*range(7), *range(8, 25)] * 2)


def test_lift_from_sketches_is_within_its_bound(spark):
    """Counts of a merged sketch of a size far below the rows, against the exact ranks."""
    size, n = 200, 60_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.rand(1)).alias("score"), (F.rand(2) < 0.1).cast("int").alias("y"), (F.col("id") % 4).alias("run")
    ).cache()
    parts = quality.score_sketches(df, "y", "score", ["run"], size)
    rows = quality.lift_from_sketches(quality.merge_score_sketches(parts)).orderBy("top").collect()
    assert rows[-1].cnt_cum == n and rows[-1].target_cnt_cum == df.where("y = 1").count()
    bound = 2.3 / size**0.9
    # a third of equal scores stays in one bucket
    assert len(rows) < 10 and max(r.cnt for r in rows) >= n / 3 * (1 - 3 * bound)
    exact = sorted(r.score for r in df.select("score").collect())
    positives = sorted(r.score for r in df.where("y = 1").select("score").collect())
    assert sum(r.cnt for r in rows) == n and sum(r.target_cnt for r in rows) == len(positives)
    borders = quality.merge_score_sketches(parts).select(F.kll_sketch_get_quantile_double("scores", F.array(*[F.lit(1 - i / 10) for i in range(1, 10)]))).first()[0]
    for r, b in zip(rows, dict.fromkeys(borders)):
        assert abs(r.cnt_cum - sum(x > b for x in exact)) <= 2 * bound * n
        assert abs(r.target_cnt_cum - sum(x > b for x in positives)) <= 2 * bound * len(positives)


def test_lift_from_sketches_edges(spark):
    df = spark.createDataFrame([(None, 1, 1), (float("nan"), 1, 1), (0.5, 0, 1), (0.7, None, 2)], "score double, y int, run int")
    rows = quality.lift_from_sketches(quality.merge_score_sketches(quality.score_sketches(df, "y", "score", ["run"])), 4).collect()
    assert [(r.top, r.target_cnt, r.cnt, r.lift) for r in rows] == [(1, 0, 1, None), (2, 0, 1, None)]
    assert quality.lift_from_sketches(quality.merge_score_sketches(quality.score_sketches(df.where("false"), "y", "score"))).count() == 0


def test_merged_profiles_equal_one_read(spark):
    df = spark.range(20_000).select((F.col("id") % 3).alias("m"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("a"), F.lit(None).cast("int").alias("b"), F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 50).alias("c"))
    whole = {r.column: r for r in profile.profile_of(profile.profile_sketches(df, columns=["a", "b", "c"])).collect()}
    merged = {r.column: r for r in profile.profile_of(profile.merge_profiles(profile.profile_sketches(df, ["m"]))).collect()}
    assert {c: (r.fill_rate, r.top_1_share) for c, r in merged.items() if c != "a"} == {c: (r.fill_rate, r.top_1_share) for c, r in whole.items() if c != "a"}
    assert {c: r.n_unique for c, r in merged.items() if c != "a"} == {"b": 0, "c": 25} and merged["a"].fill_rate == 0.8
    assert all(abs(r["a"].n_unique - 16_000) < 0.05 * 16_000 for r in (whole, merged)) and merged["b"].top_1_share == 0
    assert abs(merged["a"].n_unique - whole["a"].n_unique) <= 0.02 * 16_000
    assert profile.profile_of(profile.profile_sketches(df.where("false"), columns=["a"])).count() == 0
