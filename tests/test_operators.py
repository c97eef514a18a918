import random
from collections import Counter
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from featuremart.operators import categorical, joins, services, slots, snapshots, tickets
from featuremart.operators.identity import dual_identity, mask_by_role
from featuremart.operators.labels import label_base
from featuremart.operators.rollup import rollup_entity

AS_OF = date(2024, 3, 31)


# ---------------------------------------------------------------- snapshots


def test_latest_row_settles_ties(spark, rows):
    df = spark.createDataFrame([(1, "2024-01-01", 5), (1, "2024-01-01", 7), (1, None, 9), (2, None, 1)], "k int, d string, id int")
    assert rows(snapshots.latest_by(df, ["k"], "d", ["id"])) == {(1, "2024-01-01", 7), (2, None, 1)}


def test_latest_row_is_limited_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = snapshots.latest_by(df, ["k"], "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_any_per_key_is_one_whole_row(spark, rows):
    df = spark.createDataFrame([(1, 2, "b"), (1, 2, "a"), (1, 1, "z"), (2, None, "q")], "k int, x int, y string")
    assert rows(snapshots.any_per_key(df, ["k"])) == {(1, 1, "z"), (2, None, "q")}


def test_lag_columns_keep_rows_together(spark):
    days = [date(2024, 3, 22), date(2024, 2, 22)]
    df = spark.createDataFrame(
        [
            (1, days[0], 1.0, -1.0),
            (1, days[0], 2.0, -2.0),  # the day repeats: one row supplies both columns
            (1, days[1], 5.0, -5.0),
            (1, date(2023, 1, 1), 9.0, -9.0),
            (2, days[1], 3.0, -3.0),  # absent on the first day
            (3, days[0], None, -7.0),
        ],
        "k int, d date, lat double, lon double",
    )
    out = snapshots.lag_columns(df, ["k"], "d", {"lat": "lat", "lon": "lon"}, days)
    got = {r.k: r for r in out.collect()}
    assert set(got) == {1, 3}
    assert got[1].lat_0 == -got[1].lon_0 and got[1].lat_1 == 5.0
    assert (got[3].lat_0, got[3].lon_0, got[3].lat_1) == (None, -7.0, None)


def test_assert_grain(spark):
    df = spark.createDataFrame([(1, 1), (1, 2)], "a int, b int")
    assert snapshots.assert_grain(df, ["a", "b"]) is df
    with pytest.raises(ValueError, match="repeats"):
        snapshots.assert_grain(df, ["a"])


# ---------------------------------------------------------------- slots


def payments(spark):
    return spark.createDataFrame(
        [
            (1, date(2024, 3, 31), Decimal("10.00"), 2),
            (1, date(2024, 3, 1), Decimal("10.00"), 1),  # equal totals: class 1 wins
            (1, date(2024, 2, 29), Decimal("5.50"), 3),
            (1, date(2023, 11, 1), Decimal("7.00"), 4),
            (1, date(2023, 10, 31), Decimal("99.00"), 5),  # before the window
            (1, date(2024, 4, 1), Decimal("99.00"), 5),  # after it
            (2, date(2023, 10, 31), Decimal("1.00"), 1),
        ],
        "k int, dt date, amount decimal(10,2), pay_class int",
    )


def test_month_slots_and_dominant_class(spark):
    got = slots.payment_block(payments(spark), ["k"], AS_OF).collect()
    assert len(got) == 1
    row = got[0].asDict()
    assert [float(row[f"pay_0{k}mm"]) for k in range(5)] == [20.0, 5.5, 0.0, 0.0, 7.0]
    assert [row[f"pay_class_0{k}mm"] for k in range(5)] == [1, 3, 0, 0, 4]
    assert row["is_pay"] == 1


def test_block_equals_its_parts(spark, rows):
    df = payments(spark)
    sums = slots.month_slots(df, ["k"], "dt", "amount", "pay", AS_OF)
    tops = slots.dominant_by_month(df, ["k"], "dt", "pay_class", "amount", "pay_class", AS_OF, none_value=0)
    block = slots.payment_block(df, ["k"], AS_OF)
    assert rows(joins.enrich(sums, tops, ["k"]).withColumn("is_pay", F.lit(1))) == rows(block)


def test_exact_alignment(spark):
    df = spark.createDataFrame([(1, date(2024, 3, 31), 1), (1, date(2024, 3, 30), 2)], "k int, d date, v int")
    exact = slots.month_slots(df, ["k"], "d", "v", "x", AS_OF, align="exact", style="plain").first()
    month = slots.month_slots(df, ["k"], "d", "v", "x", AS_OF, style="plain").first()
    assert (exact.x_0, month.x_0) == (1, 3)


def test_slot_sums_add_up_to_the_window(spark):
    rnd = random.Random(1)
    data = [(rnd.randrange(5), date(2023, 1 + rnd.randrange(12), 1 + rnd.randrange(28)), rnd.randrange(100)) for _ in range(500)]
    df = spark.createDataFrame(data, "k int, d date, v int")
    as_of = date(2023, 12, 31)
    wide = slots.month_slots(df, ["k"], "d", "v", "x", as_of)
    total = sum(sum(r[1:]) for r in wide.collect())
    assert total == sum(v for _, d, v in data if d > date(2023, 7, 31))


# ---------------------------------------------------------------- categories


def test_presence_matrix_matches_one_hot(spark):
    values = {"a": list(range(1, 20)), "b": [1, 2, 3, 4]}
    rnd = random.Random(2)
    data = [(rnd.randrange(20), rnd.choice([*range(20), None]), rnd.choice([*range(5), None])) for _ in range(300)]
    df = spark.createDataFrame(data, "k int, a int, b int")
    names = categorical.one_hot_names(values)
    assert len(names) == 76 and names[0] == "a_1_b_1" and names[-1] == "a_19_b_4"
    spelled = df.select("k", *categorical.one_hot(values)).groupBy("k").agg(*[F.max(n).alias(n) for n in names])
    packed = categorical.presence_matrix(df, ["k"], values).select("k", *names)
    assert sorted(map(tuple, packed.collect())) == sorted(map(tuple, spelled.select("k", *names).collect()))


def test_zero_codes_give_a_zero_row(spark):
    df = spark.createDataFrame([(1, 0, 1), (1, 1, 0)], "k int, a int, b int")
    row = categorical.presence_matrix(df, ["k"], {"a": [1], "b": [1]}).first()
    assert tuple(row) == (1, 0)


def test_category_matrix(spark):
    nan = float("nan")
    df = spark.createDataFrame(
        [(1, 1, 2.0, 1.0), (1, 1, 3.0, nan), (1, 2, None, 4.0), (2, 99, 5.0, 5.0)],
        "k int, c int, m double, w double",
    )
    spec = {"m": "c{}_m", "w": "c{}_w"}
    for co in (None, "k"):
        out = categorical.category_matrix(df, ["k"], "c", spec, [1, 2], shuffle_by=co)
        assert out.columns == ["k", "c1_m", "c1_w", "c2_m", "c2_w"]
        assert {tuple(r) for r in out.collect()} == {(1, 5.0, 1.0, 0.0, 4.0), (2, 0.0, 0.0, 0.0, 0.0)}
    single = categorical.category_matrix(df, ["k"], "c", {"m": "c{}"}, [1])
    assert {tuple(r) for r in single.collect()} == {(1, 5.0), (2, 0.0)}


def test_contact_matrix_equals_joined_pivots(spark, rows):
    sms = spark.createDataFrame([(1, "Dom.Ru", 2), (1, "domru", 3), (2, "Akado", 1)], "k int, c string, n int")
    web = spark.createDataFrame([(3, "Akado", 7), (1, None, 9)], "k int, c string, n int")
    sources = [(sms, "c", "n", "s_", None), (web, "c", "n", "w_", ["akado"])]
    out = categorical.contact_matrix(sources, "k", other="rest")
    assert out.columns == ["k", "s_akado", "s_domru", "s_rest", "w_akado", "w_rest"]
    assert rows(out) == {(1, 0, 5, 0, 0, 9), (2, 1, 0, 0, 0, 0), (3, 0, 0, 0, 7, 0)}
    with pytest.raises(Exception, match="not a listed value"):
        categorical.contact_matrix(sources, "k").collect()


def test_pivot_other(spark, rows):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (1, "c", 4)], "k int, c string, n int")
    assert rows(categorical.pivot_counts(df, ["k"], "c", "n", "p_", ["a"], other="rest")) == {(1, 1, 6)}
    assert rows(categorical.pivot_counts(df, ["k"], "c", "n", "p_")) == {(1, 1, 2, 4)}
    odd = df.union(df.select("k", F.lit(None).cast("string"), F.lit(8)))
    total = categorical.pivot_counts(odd, ["k"], "c", "n", "p_", ["a", "b"], other="rest").first()
    assert sum(total[1:]) == 7 + 3 * 8
    with pytest.raises(Exception, match="not a listed value"):
        categorical.pivot_counts(odd, ["k"], "c", "n", "p_").collect()


def test_dictionary_lookup_is_bounded(spark):
    df = spark.range(20).withColumn("id", F.col("id").cast("string"))
    with pytest.raises(ValueError, match="more than 5"):
        categorical.dictionary_values(df, "id", 5)


# ---------------------------------------------------------------- identity


def test_dual_identity(spark, rows):
    df = spark.createDataFrame([("x", 1, 10), ("x", 1, 11), ("x", 1, 10)], "line string, a int, b int")
    out = dual_identity(df, ["line"], {1: {"id": "a"}, 0: {"id": "b"}}, "first")
    assert sorted(map(tuple, out.collect())) == [("x", 1, 1), ("x", 10, 0), ("x", 11, 0)]
    masked = mask_by_role(out, F.col("first") == 0, ["id"])
    rolled = rollup_entity(masked, ["line"], {"id": "first", "first": "max"})
    assert rows(rolled) == {("x", 10, 1)}


# ---------------------------------------------------------------- requests


def complaint_rows(spark):
    def row(request, contract, status, created, closed, kind="Фиксированный", raw=None, priority="Средний"):
        return (request, contract, status, priority, created, closed, raw or created, kind)

    march, nov, old = date(2024, 3, 5), date(2023, 11, 1), date(2023, 10, 31)
    return spark.createDataFrame(
        [
            row(1, 100, "Закрыт", march, date(2024, 3, 7)),
            row(1, 100, "Закрыт", march, date(2024, 3, 7)),  # repeated row
            row(1, 100, "В работе", march, None),
            row(2, 100, "Закрыт", march, date(2024, 3, 7)),
            row(2, 200, "Закрыт", march, date(2024, 3, 7)),  # two contracts: dropped
            row(3, 100, "Решен", nov, None),  # closed without an end: no hours
            row(4, 100, "Закрыт", old, old),  # before the window
            row(5, 200, "Закрыт", march, march, kind="Мобильный"),
            row(6, 200, "Активное ожидание", march, None, raw=old),
            row(None, 200, "Закрыт", march, march),
            row(7, 300, "Активное ожидание", march, None, priority="Наивысший"),
            row(7, None, "Закрыт", march, march),  # no contract: neither counts nor blocks
        ],
        "request_id int, contract_num int, status string, priority string, createdate_dt_orig date,"
        " closetime_dt_orig date, raw_dt date, dogtype string",
    )


def test_ambiguity_guard(spark, rows):
    kept = tickets.keep_unambiguous(tickets.scoped(complaint_rows(spark), AS_OF), "request_id", "contract_num")
    assert rows(kept, "request_id") == {(1,), (3,), (7,)}


def test_request_statistics(spark):
    accounts = spark.createDataFrame([(9, 100), (9, 100), (8, 300), (7, 400)], "acc int, contract_num int")
    out = tickets.request_statistics(complaint_rows(spark), accounts, AS_OF)
    got = {r.acc: r for r in out.collect()}
    assert set(got) == {9, 8}
    nine = got[9]
    assert (nine.cnt_zhalobi, nine.cnt_zhalobi_00mm, nine.cnt_zhalobi_04mm) == (2, 1, 1)
    assert (nine.complaints_num_close, nine.complaints_num_active) == (1, 1)
    assert (nine.min_zhalobi_lifetime_hours, nine.max_zhalobi_lifetime_hours) == (48.0, 48.0)
    assert (got[8].complaints_num_priority_highest, got[8].max_zhalobi_lifetime_hours) == (1, 0.0)


def test_hours_between_dates_ignore_clock_changes(spark):
    df = complaint_rows(spark).where("request_id = 2")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # clocks changed on 2024-03-10
    try:
        moved = df.withColumn("closetime_dt_orig", F.lit(date(2024, 3, 12)))
        hours = {r.zhalobi_lifetime_hours for r in tickets.with_ticket_flags(moved, AS_OF).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert hours == {7 * 24.0}


def test_statistics_equal_the_stepwise_operators(spark):
    kept = tickets.keep_unambiguous(tickets.scoped(complaint_rows(spark), AS_OF), "request_id", "contract_num")
    flagged = tickets.with_ticket_flags(kept, AS_OF).where(F.col("contract_num").isNotNull())
    steps = tickets.per_account(tickets.per_request(flagged, ["contract_num"]), ["contract_num"])
    whole = tickets.contract_statistics(complaint_rows(spark), AS_OF)
    order = sorted(whole.columns)
    assert sorted(map(tuple, steps.select(order).collect())) == sorted(map(tuple, whole.select(order).collect()))


# ---------------------------------------------------------------- services


def test_service_block(spark):
    old, new = date(2020, 1, 1), date(2024, 6, 1)
    service_rows = spark.createDataFrame(
        [
            (1, 10, 0, 1, old, "9999-12-31"),
            (1, 10, 0, 1, old, None),  # repeated service
            (1, 11, 0, 0, old, "9999-12-31"),
            (1, 12, 1, 0, old, "9999-12-31"),
            (1, 12, 0, 0, new, "9999-12-31"),  # not yet valid
            (2, 10, 1, 1, old, "9999-12-31"),  # nothing active: absent
        ],
        "acc int, app_service_id int, is_closed int, is_b2c_basic_service int, dt_from date, dt_to string",
    )
    discounts = spark.createDataFrame(
        [(1, 10, 5, old, "9999-12-31"), (1, 10, 7, old, None), (1, 12, 100, old, None), (1, 11, 50, old, "2024-03-31")],
        "acc int, app_service_id int, discount_price int, dt_from date, dt_to string",
    )
    block = services.service_block(service_rows, discounts, ["acc"], AS_OF).collect()
    assert [r.asDict() for r in block] == [
        {"acc": 1, "active_serv_cnt": 2, "closed_cnt": 1, "basic_serv_cnt": 1, "not_basic_serv_cnt": 1, "all_disc_sum": 12}
    ]
    active = services.active(service_rows, AS_OF)
    parts = joins.merge_counters(
        [
            services.active_services(active, ["acc"]),
            services.closed_services(service_rows, ["acc"]),
            services.basic_services(active, ["acc"]),
            services.discount_totals(service_rows, discounts, ["acc"], AS_OF),
        ],
        ["acc"],
    )
    assert [r.asDict() for r in parts.collect()] == [r.asDict() for r in block]


# ---------------------------------------------------------------- joins


def test_enrich_refuses_clashing_columns(spark):
    df = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(ValueError, match="'v'"):
        joins.enrich(df, df, ["k"])


def test_spread_join_equals_the_plain_one(spark):
    rnd = random.Random(3)
    left = [(rnd.choice([7, 7, 7, None, None, *range(50)]), i) for i in range(2000)]
    base = spark.createDataFrame(left, "k int, i int")
    right = spark.createDataFrame([(k, k * 10) for k in range(0, 40)], "k int, v int")
    plain = Counter(map(tuple, joins.enrich(base, right, ["k"]).collect()))
    assert Counter(map(tuple, joins.enrich_spread(base, right, ["k"]).collect())) == plain
    assert Counter(map(tuple, joins.assemble_known(base, [(right, ["k"])]).collect())) == plain


def test_ids_of_a_line_come_from_one_row(spark):
    rows = spark.createDataFrame(
        [(1, 5, 10, 800), (1, 3, 90, 700), (1, None, None, None), (2, None, None, None)], "line int, b int, a int, n int"
    )
    spec = {"b": "row:account", "a": "row:account", "n": "row:account"}
    assert {tuple(r) for r in rollup_entity(rows, ["line"], spec).collect()} == {(1, 3, 90, 700), (2, None, None, None)}
    paid = rows.withColumns({"pay": F.lit(1), "dt_close": F.lit(None).cast("date")})
    labelled = label_base(paid, ["line"], ["b", "a", "n"], ["pay"])
    assert {tuple(r)[:4] for r in labelled.collect()} == {(1, 3, 90, 700), (2, None, None, None)}


def test_null_keys_are_spread(spark):
    base = spark.createDataFrame([(None, i) for i in range(100)] + [(1, 100)], "k int, i int")
    right = spark.createDataFrame([(1, "x"), (None, "never")], "k int, v string")
    out = joins.enrich_spread(base, right, ["k"], ["i"])
    assert out.columns == ["k", "i", "v"]
    assert out.where("v is not null").count() == 1 and out.count() == 101
    assert joins.spread_join(base, right, ["k"], "left_anti").count() == 100
    assert joins.spread_join(base, right, ["k"], "left_semi").count() == 1


@pytest.fixture
def eager_skew_handling(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_hot_key_is_split_next_to_an_aggregate(spark, eager_skew_handling, how):
    """A third of the rows has one key; the right side is an aggregate."""
    base = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 997).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("text")
    )
    right = spark.range(0, 3000).groupBy((F.col("id") % 900).alias("k")).agg(F.count("*").alias("n"))
    out = joins.spread_join(base, right, ["k"], how)
    out.count()
    joined = joins.spread_join(base, right, ["k"], how)
    joined.collect()
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == base.join(right, ["k"], how).count()


def test_full_merge_keeps_one_sided_keys(spark, rows):
    a = spark.createDataFrame([(1, 5), (1, 6), (2, 1)], "k int, a int")
    b = spark.createDataFrame([(2, "x"), (3, "y")], "k int, b string")
    assert rows(joins.full_merge([a, b], ["k"])) == {(1, 6, None), (2, 1, "x"), (3, None, "y")}


def test_spine_is_bounded(spark):
    assert joins.spine(spark.range(3), spark.range(4).withColumnRenamed("id", "m")).count() == 12
    with pytest.raises(ValueError, match="at most 2"):
        joins.spine(spark.range(3), spark.range(4).withColumnRenamed("id", "m"), max_rows=2)


def test_holdout_nulls(spark, rows):
    df = spark.createDataFrame([(1, None), (1, 2), (3, 4)], "a int, b int")
    taken = spark.createDataFrame([(1, None), (3, 4)], "a int, b int")
    assert rows(joins.holdout(df, taken, ["a", "b"])) == {(1, None), (1, 2)}
    assert rows(joins.holdout(df, taken, ["a", "b"], null_safe=True)) == {(1, 2)}


def test_fill_by_type(spark):
    df = spark.createDataFrame(
        [(None, float("nan"), None, None, None)], "i int, d double, s string, t date, b boolean"
    )
    assert tuple(joins.fill_typed(df, num=-1, text="unk").first()) == (-1, -1.0, "unk", None, None)


def test_stack_by_name(spark, rows):
    a, b = spark.sql("select 1 as x, 'a' as y"), spark.sql("select 'b' as y, 2 as x")
    assert rows(joins.stack(a, b)) == {(1, "a"), (2, "b")}


def test_explode_list(spark, rows):
    df = spark.sql("select 1 as k, sequence(1, 3) as ids union all select 2, array()")
    assert rows(joins.explode_list(df, "ids", "id")) == {(1, 1), (1, 2), (1, 3)}


def test_a_matrix_is_wide_only_in_its_projection(spark):
    """As a pivot, each task held a wide row of nearly every key."""
    df = spark.createDataFrame([(i % 50, i % 7, float(i)) for i in range(700)] + [(None, 1, 2.0), (3, None, 1.0), (99, 12, 1.0)], "k int, c int, v double")
    out = categorical.category_matrix(df, ["k"], "c", {"v": "c_{}"}, range(5))
    want = {k: [0.0] * 5 for k in [*range(50), None, 99]}
    for r in df.collect():
        if r.c is not None and r.c < 5:
            want[r.k][r.c] += r.v
    assert {tuple(r) for r in out.collect()} == {(k, *v) for k, v in want.items()}
    assert "pivotfirst" not in out._jdf.queryExecution().optimizedPlan().toString()
