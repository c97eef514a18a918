"""Intervals met by many days, month states and exact negatives."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from featuremart.functions.calendar import month_end
from featuremart.operators.intervals import interval_join, snapshots
from featuremart.operators.ranking import key_hash
from featuremart.operators.sampling import downsample_strata
from featuremart.operators.slots import month_slots, payment_block
from featuremart.operators.snapshots import snapshot
from featuremart.operators.states import merge_states, month_state, windows

D = date(2001, 1, 1)


def some_day(rnd, n=500):
    return D + timedelta(rnd.randrange(n))


def intervals(rnd, n):
    out = []
    for i in range(n):
        start = rnd.choice([None, some_day(rnd), some_day(rnd)])
        end = rnd.choice([None, date(9999, 12, 31), some_day(rnd), (start or D) + timedelta(rnd.randrange(3)), (start or D) + timedelta(900)])
        out.append((rnd.choice([None, 1, 2, 3]), start, None if end is None else end.isoformat(), i))
    return out


def covers(day, start, end):
    return day is not None and start is not None and start <= day and (end is None or date.fromisoformat(end) > day)


@pytest.mark.parametrize("how, span", [("inner", None), ("left", None), ("inner", True)])
def test_interval_join(spark, how, span):
    rnd = random.Random(how)
    right = intervals(rnd, 300)
    left = [(rnd.choice([None, 1, 2, 4]), rnd.choice([None, some_day(rnd), some_day(rnd)]), i) for i in range(200)]
    left += left[:20]
    a = spark.createDataFrame(left, "k int, day date, i int")
    b = spark.createDataFrame(right, "k bigint, dt_from date, dt_to string, j int")
    limits = (D, D + timedelta(500)) if span else None
    got = sorted(((r.k, r.day, r.i, r.j) for r in interval_join(a, b, ["k"], "day", how=how, span=limits).collect()), key=str)
    want = []
    for k, day, i in left:
        found = [j for k2, s, e, j in right if k is not None and k == k2 and covers(day, s, e)]
        want += [(k, day, i, j) for j in found or ([None] if how == "left" else [])]
    assert got == sorted(want, key=str) and len(want) > 500
    assert interval_join(a.where("false"), b, ["k"], "day", how=how).count() == 0
    with pytest.raises(ValueError):
        interval_join(a, b.withColumn("i", F.lit(1)), ["k"], "day")


def test_open_intervals_are_not_cut(spark):
    """An open interval reaches its join as one row, a closed one as a row per month inside the span."""
    rows = [(1, D, None, 1), (1, D, "9999-12-31", 2), (1, D, "2001-03-15", 3), (1, D, "2001-01-01", 4), (1, D, "2090-01-01", 5)]
    b = spark.createDataFrame(rows, "k int, dt_from date, dt_to string, j int")
    a = spark.createDataFrame([(1, date(2001, m, 28)) for m in range(1, 13)], "k int, day date")
    joined = interval_join(a, b, ["k"], "day", span=(date(2001, 1, 1), date(2001, 12, 31)))
    assert {(r.j, r["count"]) for r in joined.groupBy("j").count().collect()} == {(1, 12), (2, 12), (3, 2), (5, 12)}
    joined.collect()
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1


def test_closed_intervals_are_cut_into_few_rows(spark):
    """200 days took eight month buckets, twelve years 145; days at the ends of months and years are still met."""
    rows = [(1, date(2001, 5, 20), "2001-12-06", 1), (1, date(1998, 12, 31), "2011-01-01", 2), (1, date(2000, 12, 31), "2001-01-01", 3), (1, date(2000, 12, 31), "2001-01-02", 4)]
    b = spark.createDataFrame(rows, "k int, dt_from date, dt_to string, j int")
    days = [date(y, m, d) for y in (1998, 2000, 2001, 2010, 2011) for m, d in ((1, 1), (5, 19), (5, 20), (12, 5), (12, 6), (12, 31))]
    a = spark.createDataFrame([(1, d) for d in days], "k int, day date")
    joined = interval_join(a, b, ["k"], "day")
    assert {(r.j, r.day) for r in joined.collect()} == {(j, d) for _, s, e, j in rows for d in days if covers(d, s, e)}
    plan = joined._jdf.queryExecution().optimizedPlan()
    explodes, todo = [], [plan]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Generate" and "explode" in node.simpleString(1000):
            explodes.append(node)
        todo += [node.children().apply(i) for i in range(node.children().size())]
    assert len(explodes) == 1
    made = spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, explodes[0]).count()
    assert made == 1 + 13 + 1 + 2


def test_open_ends_in_far_years(spark):
    """An open interval that has ended by a day of the ninth millennium does not cover it."""
    b = spark.createDataFrame([(1, D, "9500-01-01", 1), (1, date(9600, 1, 1), "9999-12-31", 2), (2, D, None, 3)], "k int, dt_from date, dt_to string, j int")
    a = spark.createDataFrame([(k, date(y, 1, 1)) for k in (1, 2, 3) for y in (9499, 9500, 9550, 9700)], "k int, day date")
    got = {(r.k, r.day.year, r.j) for r in interval_join(a, b, ["k"], "day", how="left").collect()}
    assert got == {(1, 9499, 1), (1, 9500, None), (1, 9550, None), (1, 9700, 2)} | {(2, y, 3) for y in (9499, 9500, 9550, 9700)} | {(3, y, None) for y in (9499, 9500, 9550, 9700)}


def test_snapshots_are_those_of_each_day(spark):
    df = spark.createDataFrame(intervals(random.Random(1), 400), "k int, dt_from date, dt_to string, i int")
    days = [month_end(date(2001, 7, 1), k) for k in range(12)]
    got = snapshots(df, [*days, days[0]])
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    ours = {(r.i, r.snapshot_day) for r in got.collect()}
    assert ours == {(r.i, d) for d in days for r in snapshot(df, d).collect()}


def test_windows_of_a_state(spark):
    """Equal to the month slots at several days, with a third of the rows in one key and late rows added."""
    rnd = random.Random(3)
    rows = [(rnd.choice([1, 1, 2, 3, 4, None]), rnd.choice([some_day(rnd), None, some_day(rnd)]), rnd.choice([None, 5, 7, 9]), rnd.choice([None, 1, 2, 3])) for _ in range(900)]
    df = spark.createDataFrame(rows, "k int, dt date, amount int, pay_class int").withColumn("late", F.rand(1) < 0.2).cache()
    states = [month_state(df.where(f"late = {flag}"), ["k"], "dt", "amount", "pay_class") for flag in ("false", "true")]
    merged = merge_states(["k"], *states).cache()
    days = [date(2001, 7, 15), date(2001, 12, 31), date(2002, 3, 1), date(2001, 1, 5)]
    made = windows(merged, ["k"], days, "pay", class_prefix="pay_class", none_class=0)
    for d in days:
        ours = made.where(F.col("as_of") == F.lit(month_end(d))).drop("as_of")
        theirs = payment_block(df, ["k"], d).drop("is_pay")
        assert sorted(map(str, ours.select(theirs.columns).collect())) == sorted(map(str, theirs.collect()))
    plain = windows(merge_states(["k"], month_state(df, ["k"], "dt", "amount")), ["k"], days[:1], "x", 3, style="plain").drop("as_of")
    theirs = month_slots(df, ["k"], "dt", "amount", "x", days[0], 3, style="plain")
    assert sorted(map(str, plain.collect())) == sorted(map(str, theirs.select(plain.columns).collect()))
    assert windows(merged.where("false"), ["k"], days, "pay").count() == 0


@pytest.mark.parametrize("ratio", [0, 0.5, 2, 2.5, 1000])
def test_exact_negatives(spark, ratio):
    rows = [(i, "hot" if i % 3 else rnd_month(i), int(i % 17 == 0), 0) for i in range(4000)]
    df = spark.createDataFrame(rows, "id int, month string, y int, _edge int").cache()
    got = downsample_strata(df, "y", ratio, ["id"], ["month"], seed=3).cache()
    whole = {r.month: (r.p, r.n) for r in df.groupBy("month").agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("n")).collect()}
    kept = {r.month: (r.p, r.n) for r in got.groupBy("month").agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("n")).collect()}
    for month, (p, n) in whole.items():
        assert kept.get(month, (0, 0)) == (p, min(n, int(p * ratio)))
    order = [r.id for r in df.where("y = 0 and month = 'hot'").orderBy(key_hash(["id"], 3), "id").collect()]
    chosen = {r.id for r in got.where("y = 0 and month = 'hot'").collect()}
    assert chosen == set(order[: len(chosen)]) and got.columns == df.columns
    assert downsample_strata(df.where("false"), "y", ratio, ["id"], ["month"]).count() == 0


def rnd_month(i):
    return [None, "2001-05-01", "2001-06-01", "none"][i // 3 % 4] if i % 17 or i // 3 % 4 != 3 else "2001-05-01"
