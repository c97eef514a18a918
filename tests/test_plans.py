from datetime import date, timedelta
from decimal import Decimal
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.catalogue import fixed as fixed_queries
from featuremart.catalogue import mobile as mobile_queries
from featuremart.catalogue.registry import AS_OF, Tables
from featuremart.operators.categorical import category_matrix, category_vectors, merge_vectors, spread_vectors
from featuremart.operators.joins import as_of_join, assemble_known, enrich_spread
from featuremart.operators.rollup import rollup_entity, rollup_pair
from featuremart.operators.snapshots import assert_grain, snapshot
from featuremart.plans import fixed, mobile, training
from featuremart.sources import tables

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, SMALL)


def test_mart_keeps_one_row_per_line(t):
    mart = fixed.fixed_mart({name: getattr(t, name) for name in fixed_queries.FIXED_SOURCES}, AS_OF)
    assert_grain(mart, fixed_queries.MART_KEYS)


def test_building_the_plans_runs_no_job(t, spark):
    """No plan depends on counts taken while it is built."""
    tracker = spark.sparkContext.statusTracker()
    sources = {name: getattr(t, name) for name in fixed_queries.FIXED_SOURCES}
    spark.sparkContext.setJobGroup("plans", "plans")
    fixed.identity_base(t.convergent_a, t.convergent_b, t.contracts, AS_OF)
    fixed.fixed_mart(sources, AS_OF)
    training.churn_labels(t.convergent_a, t.convergent_b, t.lifetimes, t.payments, AS_OF)
    assert not list(tracker.getJobIdsForGroup("plans"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_null_lines_and_second_interests_keep_the_mobile_grain(spark):
    base = spark.createDataFrame([(1, 10), (2, 20), *[(None, 30)] * 3], "msisdn int, n int")
    one = lambda c: spark.createDataFrame([(1, 5), (None, 6)], f"msisdn int, {c} int")
    interests = spark.createDataFrame([(7, 8, 1, 1.5), (7, 9, 1, 2.0)], "regid int, app_n int, msisdn int, cat double")
    mart = mobile.mobile_mart(base, one("a"), one("b"), one("c"), interests, AS_OF, AS_OF)
    rows = {(r.msisdn, r.n, r.a, r.cat) for r in mart.collect()}
    assert mart.count() == 5
    assert rows == {(1, 10, 5, 3.5), (2, 20, 0, 0.0), (-1, 30, 0, 0.0)}


def test_blocks_keep_their_grain(t):
    assert_grain(fixed.lifetime_block(t.lifetimes.union(t.lifetimes), AS_OF), fixed.ACCOUNT)
    assert_grain(fixed.profile_block(t.profiles), fixed.PROFILE_KEY)
    assert_grain(fixed.equipment_block(t.equipment, AS_OF), fixed.ACCOUNT)


def test_prefixes_rename_the_identity_columns(t):
    renamed = {c: c.replace("mobile_", "cell_") for c in t.convergent_a.columns}
    a, b = (f.withColumnsRenamed(renamed) for f in (t.convergent_a, t.convergent_b))
    base = fixed.identity_base(a, b, t.contracts, AS_OF, mobile="cell")
    assert {"cell_id", "cell_msisdn", "is_cell"} <= set(base.columns)


def test_age_names():
    assert mobile.age_name("tp_change_dt") == "tp_change_days"
    assert mobile.age_name("max_subs_fee_dt_day_31d") == "max_subs_fee_day_31d_days_ago"


def test_mobile_mart_keeps_the_lines_and_has_no_gaps(t):
    mart = mobile_queries.mart_frame(t)
    assert mart.count() == t.daily_profile.count()
    filled = [c for c, dtype in mart.dtypes if dtype not in ("date", "boolean")]
    nulls = mart.select(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in filled]).first()
    assert not any(nulls)


def test_interest_rows_are_not_shuffled_again_for_the_join(t):
    """The interest block is wide; its shuffles must carry its input, not its 380 columns."""
    base = t.daily_profile.select("msisdn")
    block = mobile_queries.interests_frame(t).drop("regid", "app_n")
    t.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = base.join(block, "msisdn", "left")._jdf.queryExecution().executedPlan().toString()
    finally:
        t.spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for line in plan.splitlines():
        assert not ("Exchange" in line and "cat_95" in line)
    assert plan.count("Exchange hashpartitioning") == 3  # base, per category, per line


def test_age_prefix(spark):
    def score(name, key):
        return spark.createDataFrame([(key, 1)], f"msisdn string, {name} int")

    out = mobile.demographic_scores(
        score("model_sex", "79"), score("model_age", "9"), score("model_income", "79"), age_prefix="7"
    )
    assert [tuple(r) for r in out.collect()] == [("79", 1, 1, 1)]


def test_splits_are_disjoint_and_hold_all_positives(spark):
    labels = spark.range(600).select(
        F.lit(1).alias("mobile_id"),
        F.col("id").alias("mobile_acc_id"),
        F.col("id").alias("mobile_msisdn"),
        (F.col("id") % 20 == 0).cast("int").alias("target_active_churn"),
        F.make_date(F.lit(2025), (F.col("id") % 3 + 8).cast("int"), F.lit(1)).alias("table_business_month"),
    )
    fixed_mart = labels.select("mobile_id", "mobile_acc_id", "mobile_msisdn", F.lit(1).alias("f"))
    lines = labels.select(F.col("mobile_msisdn").alias("msisdn"), F.lit(2).alias("m"))
    seen = set()
    for month in (8, 9, 10):
        day = date(2025, month, 1)
        out = training.build_split(labels, fixed_mart, lines, (day, day), ratio=2).toPandas()
        assert out.target_active_churn.sum() == 10
        assert (out.f == 1).all() and (out.m == 2).all()
        assert not seen & set(out.msisdn)
        seen |= set(out.msisdn)


def test_target_table_replaces_months(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS plan_test")
    months = [date(2025, 8, 1), date(2025, 9, 1)]
    targets = spark.createDataFrame(
        [(1, i, i, i % 2, months[i % 2]) for i in range(10)],
        "mobile_id int, mobile_acc_id int, mobile_msisdn int, target_active_churn int, table_business_month date",
    )
    try:
        for _ in range(2):
            training.target_table(targets, "plan_test.targets", months)
        assert spark.table("plan_test.targets").count() == 10
        training.save_split(targets, "plan_test.split", str(tmp_path / "split"))
        assert spark.read.parquet(str(tmp_path / "split")).count() == 10
    finally:
        spark.sql("DROP DATABASE plan_test CASCADE")


def test_quality_report(spark):
    df = spark.range(50).select("id", (F.col("id") / 50).alias("p"), (F.col("id") > 30).cast("int").alias("y"))
    matrix, lift = training.quality_report(df, "y", "p", ["id"])
    assert sum(r.pred_POS + r.pred_NEG for r in matrix.collect()) == 50
    assert sum(r.cnt for r in lift.collect()) == 50


def test_the_mart_reads_each_source_once_for_null_lines(t):
    """Null lines are spread inside the joins, not by a second read of the base."""
    base = mobile_queries.base_frame(t)
    joined = assemble_known(base, [(mobile_queries.scores_frame(t), ["msisdn"]), (mobile_queries.moves_frame(t), ["msisdn"])])
    scans = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")
    assert scans(joined) == scans(base) + scans(mobile_queries.scores_frame(t)) + scans(mobile_queries.moves_frame(t))


def test_a_third_of_null_lines_is_spread(spark):
    rows = [(None if i % 3 == 0 else i, i % 7) for i in range(6000)]
    base = spark.createDataFrame(rows, "msisdn int, n int")
    blocks = [spark.createDataFrame([(i, i) for i in range(0, 6000, 2)] + [(None, 5)], f"msisdn bigint, {c} int") for c in "ab"]
    kept = {name: spark.conf.get(name) for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = assemble_known(base, [(b, ["msisdn"]) for b in blocks])
        sizes = [r[0] for r in joined.groupBy(F.spark_partition_id()).count().select("count").collect()]
        got = sorted(((r.msisdn or -1, r.n, r.a, r.b) for r in joined.collect()), key=str)
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
    find = lambda k: k if k is not None and k % 2 == 0 else None
    assert got == sorted(((k or -1, n, find(k), find(k)) for k, n in rows), key=str)
    assert max(sizes) < 2 * 6000 / len(sizes) and len(sizes) == 8
    assert plan.count("Exchange") == 3  # the base once, each block once
    clash = assemble_known(base.withColumn("_spread", F.lit(1)), [(blocks[0], ["msisdn"])])
    assert "_spread" in clash.columns and clash.count() == 6000


def test_vectors(spark):
    rows = [(1, 7, 2, 1.5), (1, 7, 2, float("nan")), (1, 8, 2, 2.0), (1, 8, 1, None), (2, 7, 99, 4.0), (None, 7, 3, 1.0), (3, 1, None, 1.0)]
    df = spark.createDataFrame(rows, "msisdn int, regid int, cat int, m double")
    finer = category_vectors(df, ["msisdn", "regid"], "cat", ["m"], range(1, 4))
    merged = merge_vectors(finer, ["msisdn"])
    vectors = {r.msisdn: [tuple(e) for e in r.vector] for r in merged.collect()}
    assert vectors == {1: [(1, 0.0), (2, 3.5)], 2: [], None: [(3, 1.0)], 3: []}
    straight = category_vectors(df, ["msisdn"], "cat", ["m"], range(1, 4))
    assert {r.msisdn: [tuple(e) for e in r.vector] for r in straight.collect()} == vectors
    wide = {tuple(r) for r in spread_vectors(merged.withColumn("_held", F.lit(0)), "vector", {"m": "c{}"}, range(1, 4)).drop("_held").collect()}
    assert wide == {(1, 0.0, 3.5, 0.0), (2, 0.0, 0.0, 0.0), (None, 0.0, 0.0, 1.0), (3, 0.0, 0.0, 0.0)}
    matrix = category_matrix(df, ["msisdn"], "cat", {"m": "c{}"}, range(1, 4))
    assert {tuple(r) for r in matrix.collect()} == wide
    assert merge_vectors(finer.where("false"), ["msisdn"]).count() == 0


def test_sparse_and_wide_interests_give_one_mart(t):
    wide = mobile.mobile_mart(
        mobile_queries.base_frame(t), mobile_queries.scores_frame(t), mobile_queries.contacts_frame(t), mobile_queries.moves_frame(t),
        mobile_queries.interests_frame(t), AS_OF, AS_OF,
    )
    sparse = mobile_queries.mart_frame(t).drop("build_dt")
    assert wide.drop("build_dt").select(sparse.columns).exceptAll(sparse).count() == 0
    assert wide.count() == sparse.count()


def test_as_of_join(spark):
    """The newest month not later than the target, at most ``within`` months older."""
    left = [(1, "2001-06-01"), (1, "2001-04-01"), (2, "2001-06-01"), (3, "2001-06-01"), (None, "2001-06-01"), (1, None)]
    right = [(1, "2001-03-01", 13), (1, "2001-05-01", 15), (1, "2001-07-01", 17), (2, "2001-01-01", 21), (None, "2001-05-01", 9)]
    a = spark.createDataFrame([(*r, "x", 0) for r in left], "k int, day string, _at string, _held int")
    b = spark.createDataFrame(right, "k int, month string, v int")
    target = F.to_date("day")
    rows = lambda **how: {(r.k, r.day, r.v, str(r.feature_month)) for r in as_of_join(a, b, ["k"], target, "month", **how).collect()}
    none = {(3, "2001-06-01", None, "None"), (None, "2001-06-01", None, "None"), (1, None, None, "None")}
    assert rows() == none | {(1, "2001-06-01", 15, "2001-05-01"), (1, "2001-04-01", 13, "2001-03-01"), (2, "2001-06-01", 21, "2001-01-01")}
    assert rows(within=2) == none | {(1, "2001-06-01", 15, "2001-05-01"), (1, "2001-04-01", 13, "2001-03-01"), (2, "2001-06-01", None, "None")}
    assert rows(within=0) == none | {(1, "2001-06-01", None, "None"), (1, "2001-04-01", None, "None"), (2, "2001-06-01", None, "None")}
    assert as_of_join(a.where("false"), b, ["k"], target, "month").count() == 0
    assert as_of_join(a, b.where("false"), ["k"], target, "month").where("v is null").count() == len(left)


def test_no_feature_is_younger_than_the_lag(spark):
    """Marts stored by month: older features only, and no file of a later month is read."""
    tables.ensure_db(spark, "months_test")
    try:
        keys = "mobile_id int, mobile_acc_id int, mobile_msisdn int"
        for month in ("2001-03-01", "2001-05-01", "2001-06-01", "2001-07-01"):
            number = int(month[5:7])
            fixed_rows = spark.createDataFrame([(i, i, i, number, month) for i in range(9) if (i + number) % 2], f"{keys}, f int, table_business_month string")
            mobile_rows = spark.createDataFrame([(i, number * 10, month) for i in range(9)], "msisdn int, m int, table_business_month string")
            training.publish_month(fixed_rows, "months_test.fix")
            training.publish_month(mobile_rows, "months_test.mob")
        labels = [(i, i, i, i % 2, month) for i in range(9) for month in ("2001-04-01", "2001-06-01", "2001-07-01")]
        targets = spark.createDataFrame(labels, f"{keys}, target_active_churn int, table_business_month string")
        marts = [tables.load(spark, f"months_test.{n}") for n in ("fix", "mob")]
        split = training.build_split(targets, *marts, (date(2001, 4, 1), date(2001, 7, 1)), ratio=100, lag=1, within=None)
        rows = split.collect()
        assert len(rows) == 27
        for r in rows:
            label, limit = date.fromisoformat(r.table_business_month), {4: 3, 6: 5, 7: 6}[int(r.table_business_month[5:7])]
            held = [n for n in (3, 5, 6, 7) if (r.mobile_id + n) % 2 and n <= limit]
            assert r.f == max(held, default=None) and r.m == 10 * limit
            for month in (r.fixed_feature_month, r.mobile_feature_month):
                assert month is None or month < label
        exact = training.build_split(targets, *marts, (date(2001, 4, 1), date(2001, 7, 1)), ratio=100, lag=1).collect()
        assert {(r.msisdn, r.table_business_month, r.m) for r in exact} == {(r.msisdn, r.table_business_month, r.m) for r in rows}
        # the file listing itself is cut to the months that labels of April can know
        early = training.usable_months(marts[1], (date(2001, 4, 1), date(2001, 4, 1)), 1, 0)
        plan = early._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and {r[0] for r in early.select("m").distinct().collect()} == {30}
    finally:
        spark.sql("DROP DATABASE months_test CASCADE")


def test_the_fixed_mart_names_its_month(t):
    mart = fixed_queries.fixed_mart_frame(t, date(2001, 4, 30))
    assert {r[0] for r in mart.select(training.MONTH).distinct().collect()} == {"2001-04-01"}


def test_identity_months_are_those_of_each_day(spark):
    """More days than a long has bits, equal identities with other spans, and each identity shuffled once whatever its days."""
    names = "fix_billing_id int, fix_acc_id int, fix_acc_num int, mobile_id int, mobile_acc_id int, personal_account_number int, mobile_msisdn int, dt_from date, dt_to string, mobile_tariff_plan int"
    start = date(2001, 1, 1)
    rows = [(1, i % 3, None if i % 2 else 7, 1, i % 4, 5, i % 4, None if i == 9 else start + timedelta(3 * i), None if i % 5 == 0 else str(start + timedelta(40 + 2 * i)), 2) for i in range(30)]
    a, b = spark.createDataFrame(rows, names), spark.createDataFrame(rows[:3] + [(None, None, None, 1, None, 5, 9, start, None, 2)], names)
    contracts = spark.createDataFrame([(1, i, 7, start, "9999-12-31", i, i) for i in range(3)], "billing_id int, acc_id int, acc_num int, dt_from date, dt_to string, contract_num int, contract_id int")
    days = [start + timedelta(k) for k in range(130)]
    got = fixed.identity_months(a, b, contracts, [*days, days[0]])
    want = reduce(DataFrame.unionByName, [fixed.identity_base(a, b, contracts, d).withColumn("snapshot_day", F.lit(d)) for d in days[::13]])
    few = got.where(F.col("snapshot_day").isin(days[::13]))
    assert sorted(map(str, few.select(want.columns).collect())) == sorted(map(str, want.collect()))
    text = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = {k: min(i for i, line in enumerate(text) if k in line) for k in ("Generate explode", "Aggregate", "Join")}
    assert depth["Generate explode"] < min(depth["Aggregate"], depth["Join"])


def test_the_mart_of_lines_with_any_number_of_fixed_accounts(t):
    """Two joins for lines with one fixed account, the rollup for the others: as the rollup of all identities."""
    a = t.convergent_a
    other = a.where("mobile_acc_id % 5 = 0").withColumn("fix_acc_id", F.expr("if(mobile_acc_id % 2 = 0, fix_acc_id + 1, null)"))
    more = other.unionByName(a.where("mobile_acc_id % 3 = 0")).unionByName(a.where("mobile_acc_id % 7 = 0").withColumn("fix_acc_num", F.lit(None)))
    null_line = a.withColumns({c: F.lit(None) for c in ("mobile_id", "mobile_acc_id", "personal_account_number", "mobile_msisdn", "mobile_tariff_plan")})
    no_number = a.where("mobile_acc_id % 11 = 0").withColumns({"personal_account_number": F.lit(None), "fix_billing_id": F.lit(None)})
    sources = {name: getattr(t, name) for name in fixed_queries.FIXED_SOURCES}
    sources["convergent_a"] = reduce(DataFrame.unionByName, [a, more, null_line.limit(40), no_number])
    got = fixed.fixed_mart(sources, AS_OF)

    current = snapshot(sources["convergent_a"].unionByName(sources["convergent_b"]), AS_OF)
    identities = fixed.line_identities(current)
    spec = fixed.entity_spec(packed=True)
    wanted = [c for c in spec if c not in (*fixed.ACCOUNT, "acc_num", "mobile_contract_num")] + ["contract_num"]
    rows, fields = fixed.account_rows(identities.select(*fixed.ACCOUNT).distinct(), sources, AS_OF, wanted)
    joined = enrich_spread(identities, rows, fixed.ACCOUNT)
    requests = [c for c in wanted if c.startswith(("complaints_", "cnt_", "min_", "max_"))]
    number = F.col("acc_num").isNotNull()
    values = {c: F.when(number, F.col(f"_blocks.{fields[c]}")) if c in requests else F.col(f"_blocks.{fields[c]}") for c in wanted}
    role = F.col("is_mobile")
    values |= {c: F.when(role == 0, F.col(c)) for c in (*fixed.ACCOUNT, "acc_num")}
    values |= {"mobile_contract_num": F.when(role == 1, values["contract_num"])}
    keys = fixed_queries.MART_KEYS
    want = fixed.unpack_equipment(rollup_entity(joined.select(*keys, *[values[c].alias(c) for c in spec]), keys, spec))
    names = [c for c in want.columns if c not in fixed_queries.MART_KEYS] + list(keys)
    assert got.count() == want.count() > 100
    assert got.select(names).exceptAll(want.select(names)).count() == 0
    assert [d for d in got.dtypes if d[0] != training.MONTH] == want.dtypes


def test_lines_with_one_fixed_account_go_through_no_wide_aggregation(t):
    text = fixed_queries.fixed_mart_frame(t)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    first = next(i for i, line in enumerate(text) if "Union" in line)
    # the branch of these lines comes first
    above = text[first + 1 : next(i for i, line in enumerate(text) if i > first and "Join" in line)]
    assert above and not any("Aggregate" in line for line in above)


def test_a_pair_rolls_up_as_two_rows(spark):
    kinds = "side int, a int, b string, f int, m double, s decimal(12,2), n int, w double, bits bigint"
    one = (1, None, "x", 3, float("nan"), None, 2_000_000_000, 0.5, 5)
    cases = [(one, (0, 2, "a", None, 1.0, None, 2_000_000_000, None, 9)), (one, (0,) + (None,) * 8), ((1,) + (None,) * 8, (0,) + (None,) * 8)]
    cases.append(((1, 1, None, 3, 2.0, 1, 1, 0.25, None), (0, 1, "b", 2, None, 2, None, 0.5, 1)))
    spec = {"a": "row:one", "b": "row:one", "f": "first", "m": "max", "s": "sum", "n": "sum", "w": "sum", "bits": "bits"}
    for pair in cases:
        pair = [tuple(Decimal(v) if k == 5 and v is not None else v for k, v in enumerate(row)) for row in pair]
        rows = spark.createDataFrame(pair, kinds)
        rolled = rollup_entity(rows.withColumn("k", F.lit(1)), ["k"], spec).drop("k")
        both = rows.where("side = 1").select(F.struct("*").alias("l")).crossJoin(rows.where("side = 0").select(F.struct("*").alias("r")))
        sides = [{c: F.col(f"{s}.{c}") for c in spec} for s in "lr"]
        merged = both.select(*rollup_pair(spec, *sides, {c: rolled.schema[c].dataType for c in spec}))
        assert merged.dtypes == rolled.dtypes and str(merged.collect()) == str(rolled.collect())


def test_a_mart_is_not_sorted_to_look_for_repeated_keys(spark, monkeypatch):
    spark.sql("CREATE DATABASE IF NOT EXISTS unique_test")
    try:
        df = spark.createDataFrame([(1, 2, "2001-01-01"), (None, 2, "2001-01-01"), (None, 3, "2001-01-01")], f"k int, v int, {training.MONTH} string")
        plans, hint = [], type(df).hint
        monkeypatch.setattr(type(df), "hint", lambda self, *a: plans.append(self._jdf.queryExecution().optimizedPlan().toString()) or hint(self, *a))
        training.publish_month(df, "unique_test.mart", unique=["k"])
        assert plans and not any("Window" in p for p in plans)
        with pytest.raises(ValueError, match="^1 rows"):
            training.publish_month(df.union(df.where("k = 1")), "unique_test.mart", unique=["k"])
        assert spark.table("unique_test.mart").count() == 3
    finally:
        spark.sql("DROP DATABASE unique_test CASCADE")
