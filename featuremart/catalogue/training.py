"""Queries of labels, cohorts, training sets, profiles and model quality."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from featuremart.catalogue import fixed as fixed_queries
from featuremart.catalogue import mobile as mobile_queries
from featuremart.catalogue.registry import AS_OF, Tables, casts, day, fresh_table, in_month, moved, query, with_ctes
from featuremart.functions.calendar import add_months, month_end, month_start
from featuremart.functions.churn import active_churn, passive_churn
from featuremart.functions.temporal import feature_month, within_days
from featuremart.operators import profile
from featuremart.operators.joins import enrich, holdout, stack
from featuremart.operators.labels import class_counts, label_base, label_inputs, label_share
from featuremart.operators.quality import confusion, lift_from_sketches, lift_table, merge_score_sketches, score_sketches
from featuremart.operators.ranking import Cohort, cohort_rank, global_row_number, monthly_cohorts
from featuremart.operators.sampling import downsample, downsample_strata
from featuremart.operators.slots import month_slots
from featuremart.operators.snapshots import month_slice
from featuremart.plans import training
from featuremart.sources.tables import load, replace_partition

START = month_start(AS_OF)
PAYS = ["pay_00mm", "pay_01mm", "pay_02mm"]

# ---------------------------------------------------------------- labels

_LATEST_PAIR = """
select * from (select *, row_number() over (partition by fix_billing_id, fix_acc_id order by dt_from desc,
    mobile_msisdn desc, mobile_acc_id desc, mobile_id desc, fix_acc_num desc, personal_account_number desc,
    mobile_tariff_plan desc) as rn
  from (select mobile_id, mobile_acc_id, personal_account_number, mobile_msisdn, mobile_tariff_plan,
      fix_billing_id, fix_acc_id, fix_acc_num, dt_from from convergent_a
    union all select mobile_id, mobile_acc_id, personal_account_number, mobile_msisdn, mobile_tariff_plan,
      fix_billing_id, fix_acc_id, fix_acc_num, dt_from from convergent_b)) where rn = 1
"""
_PAY_SUMS = ", ".join(
    f"sum(case when {in_month('dt', k)} then amount else 0 end) as {p}" for k, p in enumerate(PAYS)
)
_LINE = ["mobile_id", "mobile_acc_id", "mobile_msisdn"]
LABEL_CTES = {
    "newest": _LATEST_PAIR,
    "label_ids": fixed_queries._IDENTITY.format(src="newest"),
    "closes": "select billing_id, acc_id, max(cast(dt_close as date)) as dt_close from lifetimes group by all",
    "pays": f"select billing_id, acc_id, {_PAY_SUMS} from payments group by billing_id, acc_id",
    "owned_ids": "select mobile_id, mobile_acc_id, mobile_msisdn, billing_id, acc_id, acc_num from label_ids where is_mobile = 0",
    "line_account": fixed_queries.one_row("owned_ids", _LINE, ["billing_id", "acc_id", "acc_num"]),
    "lines": f"""
    select s.*, a.billing_id, a.acc_id, a.acc_num from (
      select mobile_id, mobile_acc_id, mobile_msisdn,
        {', '.join(f'coalesce(sum({p}), 0) as {p}' for p in PAYS)}, max(dt_close) as dt_close
      from label_ids left join closes using (billing_id, acc_id) left join pays using (billing_id, acc_id)
      group by mobile_id, mobile_acc_id, mobile_msisdn) s
    left join line_account a on {fixed_queries.same_keys('s', 'a', _LINE)}
    """,
    "labelled": f"""
    select {casts('bigint', ['mobile_id', 'mobile_acc_id', 'mobile_msisdn', 'billing_id', 'acc_id', 'acc_num'])},
      {casts('double', PAYS)},
      cast(case when date_trunc('month', dt_close) = {day(START)} then 1 else 0 end as bigint) as target_active_churn,
      cast(case when pay_00mm <= 0 and pay_01mm <= 0 and pay_02mm <= 0 then 1 else 0 end as bigint) as target_passive_churn_3m,
      cast(case when pay_00mm <= 0 and pay_01mm <= 0 then 1 else 0 end as bigint) as target_passive_churn_2m,
      '{add_months(START, -1)}' as business_month_join_target_active_churn,
      '{add_months(START, -3)}' as business_month_join_target_passive_churn_3m,
      '{add_months(START, -2)}' as business_month_join_target_passive_churn_2m,
      '{START}' as table_business_month from lines
    """,
}
LABEL_ROLES = ("convergent_a", "convergent_b", "lifetimes", "payments")


def labels_frame(t: Tables):
    return training.churn_labels(t.convergent_a, t.convergent_b, t.lifetimes, t.payments, AS_OF)


@query("churn_labels", with_ctes(LABEL_CTES, "select * from labelled"), LABEL_ROLES)
def churn_labels(t: Tables):
    return labels_frame(t)


@query(
    "churn_active",
    """
    select o_custkey, cast(case when max(l_shipdate) >= timestamp '2001-07-01' and max(l_shipdate) < timestamp '2001-08-01'
      then 1 else 0 end as bigint) as target_active_churn
    from orders join lineitem on o_orderkey = l_orderkey group by o_custkey
    """,
)
def churn_active(t: Tables):
    shipped = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate")
    last = t.orders.join(shipped, "o_orderkey").groupBy("o_custkey").agg(F.max("l_shipdate").alias("last"))
    return last.select("o_custkey", active_churn("last", AS_OF).alias("target_active_churn"))


@query(
    "churn_passive",
    """
    select c_custkey,
      cast(case when count(case when o_orderdate > timestamp '2001-04-30' then 1 end) = 0 then 1 else 0 end as bigint) as no_pay_3m,
      cast(case when count(case when o_orderdate > timestamp '2001-05-31' then 1 end) = 0 then 1 else 0 end as bigint) as no_pay_2m
    from customer left join orders on c_custkey = o_custkey and o_orderdate <= timestamp '2001-07-31' group by c_custkey
    """,
)
def churn_passive(t: Tables):
    paid = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderdate", "o_totalprice")
    pays = month_slots(paid, ["c_custkey"], "o_orderdate", "o_totalprice", "pay", AS_OF, 3)
    joined = enrich(t.customer.select("c_custkey"), pays, ["c_custkey"])
    return joined.select(
        "c_custkey", passive_churn(PAYS).alias("no_pay_3m"), passive_churn(PAYS[:2]).alias("no_pay_2m")
    )


@query(
    "label_base",
    f"""
    with first as (select * from (select *, row_number() over (partition by c_nationkey order by c_mktsegment, c_custkey) as rn from customer) where rn = 1)
    select s.*, first.c_custkey as first_customer, first.c_mktsegment as segment from (
    select c_nationkey, cast(coalesce(sum(amount), 0) as double) as amount,
      cast(max(last_day) as varchar) as last_day
    from (select cast(c_nationkey as bigint) as c_nationkey, c_custkey from customer)
    left join (select o_custkey, sum(cast(o_totalprice as decimal(18, 2))) as amount from orders where {in_month('o_orderdate', 0)} group by 1) on c_custkey = o_custkey
    left join (select o_custkey as k, max(cast(o_orderdate as date)) as last_day from orders group by 1) on c_custkey = k
    group by c_nationkey) s join first using (c_nationkey)
    """,
)
def label_base_rows(t: Tables):
    paid = t.orders.select(
        F.col("o_custkey").alias("c_custkey"), "o_orderdate", F.col("o_totalprice").cast("decimal(18,2)").alias("v")
    )
    pays = month_slots(paid, ["c_custkey"], "o_orderdate", "v", "pay", AS_OF, 1)
    last = paid.groupBy("c_custkey").agg(F.max(F.col("o_orderdate").cast("date")).alias("last_day"))
    customers = t.customer.select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("segment"))
    rows = label_inputs(customers, last, pays, ["c_custkey"])
    named = rows.withColumnRenamed("c_custkey", "first_customer").withColumnRenamed("pay_00mm", "amount")
    return label_base(named, ["c_nationkey"], ["segment", "first_customer"], ["amount"], "last_day")


@query(
    "feature_month",
    "select o_orderkey, cast(cast(date_trunc('month', o_orderdate) - to_months(3) as date) as varchar) as month from orders",
)
def feature_months(t: Tables):
    return t.orders.select("o_orderkey", feature_month(F.col("o_orderdate"), 3).alias("month"))


@query(
    "holdout_anti",
    """
    select o_orderkey, o_custkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey)
    """,
)
def holdout_anti(t: Tables):
    taken = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return holdout(t.orders.select("o_orderkey", "o_custkey"), taken, ["o_orderkey"])


@query(
    "holdout_null_safe",
    """
    with a as (select o_orderkey, case when o_orderstatus <> 'P' then o_custkey end as k from orders),
    b as (select distinct case when c_nationkey < 20 then c_custkey end as k from customer)
    select o_orderkey, k from a where not exists (select 1 from b where a.k is not distinct from b.k)
    """,
)
def holdout_null_safe(t: Tables):
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("k"))
    taken = t.customer.select(F.when(F.col("c_nationkey") < 20, F.col("c_custkey")).alias("k"))
    return holdout(rows, taken, ["k"], null_safe=True)


@query(
    "positives_holdout",
    with_ctes(
        LABEL_CTES,
        """
        with h as (select *, md5('3|' || mobile_id || '|' || mobile_acc_id || '|' || mobile_msisdn) as d from labelled),
        r as (select *, row_number() over (order by substr(d, 1, 8), mobile_id, mobile_acc_id, mobile_msisdn) as rn from h)
        select mobile_id, mobile_acc_id, mobile_msisdn, cast(case when rn <= 200 then 1 else 0 end as bigint) as target_active_churn
        from r where rn <= 700
        """,
    ),
    LABEL_ROLES,
)
def positives_holdout(t: Tables):
    keys = training.label_keys()
    rows = training.positives_and_holdout(labels_frame(t), keys, 200, 500, seed=3)
    return rows.select(*keys, "target_active_churn")


# ---------------------------------------------------------------- cohorts


@query(
    "global_row_number",
    """
    select l_orderkey, l_partkey, l_suppkey, cast(l_linenumber as bigint) as l_linenumber, row_number() over (
      order by l_orderkey, l_partkey, l_suppkey, l_linenumber) as row_num from lineitem
    """,
)
def global_numbers(t: Tables):
    columns = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return global_row_number(t.lineitem.select(*columns), columns)


@query(
    "cohort_rank",
    """
    select o_orderkey, rn as row_num, cast(case when rn <= 1000 then 1 else 0 end as bigint) as target_active_churn
    from (select o_orderkey, row_number() over (order by o_orderdate, o_orderkey) as rn from orders)
    """,
)
def cohort_ranks(t: Tables):
    ranked = cohort_rank(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], 1000, unique=True)
    return ranked.drop("o_orderdate")


COHORTS = [Cohort(date(2001, 5, 1), 800, 80), Cohort(date(2001, 6, 1), 300, 30), Cohort(date(2001, 7, 1), 500, 50)]


def cohort_sql(source: str, order: str, columns: str) -> str:
    start, month, number, positive = 0, "", "", ""
    for c in COHORTS:
        test = f"when rn > {start} and rn <= {start + c.rows}"
        month += f" {test} then '{c.month}'"
        number += f" {test} then rn - {start}"
        positive += f" {test} then case when rn - {start} <= {c.positives} then 1 else 0 end"
        start += c.rows
    return f"""
    select {columns}, case{number} end as row_num, cast(case{positive} end as bigint) as target_active_churn,
      case{month} end as table_business_month
    from (select *, row_number() over (order by {order}) as rn from {source}) where rn <= {start}
    """


@query("monthly_cohorts", cohort_sql("orders", "o_orderkey", "o_orderkey"))
def monthly_cohort_rows(t: Tables):
    return monthly_cohorts(t.orders.select("o_orderkey"), ["o_orderkey"], COHORTS, unique=True)


_LINE_COLUMNS = "mobile_id, mobile_acc_id, mobile_msisdn"
COHORT_CTES = {
    **LABEL_CTES,
    "cohorts": cohort_sql("labelled", "mobile_msisdn, mobile_acc_id, mobile_id", _LINE_COLUMNS),
}


def targets_frame(t: Tables):
    rows = training.cohort_targets(labels_frame(t), COHORTS)
    return rows.select(*training.label_keys(), "row_num", training.LABEL, training.MONTH)


@query("cohort_targets", with_ctes(COHORT_CTES, "select * from cohorts"), LABEL_ROLES)
def cohort_targets(t: Tables):
    return targets_frame(t)


@query(
    "class_counts",
    "select lang, cast(toxic as bigint) as toxic, count(*) as cnt from labels join documents using (doc_id) group by all",
)
def label_class_counts(t: Tables):
    rows = t.labels.join(t.documents.select("doc_id", "lang"), "doc_id")
    return class_counts(rows, ["lang"], "toxic")


@query(
    "label_share",
    """
    select source, cast(sum(quality) as bigint) as sum_quality, count(quality) as total_cnt,
      floor(cast(sum(quality) * 20000 + count(quality) as double) / (2 * count(quality))) / 100 as main_target_share
    from labels join documents using (doc_id) group by source
    """,
)
def label_shares(t: Tables):
    rows = t.labels.join(t.documents.select("doc_id", "source"), "doc_id")
    return label_share(rows, ["source"], "quality")


@query(
    "month_slice",
    "select o_orderkey, o_custkey from orders where date_trunc('month', o_orderdate) = date '2001-07-01'",
)
def month_sliced(t: Tables):
    window = within_days("o_orderdate", month_end(AS_OF, 1), month_end(AS_OF))
    dated = t.orders.where(window).withColumn("month", F.trunc("o_orderdate", "month"))
    return month_slice(dated, "month", START, ["o_orderkey", "o_custkey"])


@query(
    "labels_union",
    "select doc_id, cast(toxic as bigint) as toxic from labels where toxic = 1"
    " union all select doc_id, toxic from labels where toxic = 0",
)
def labels_union(t: Tables):
    rows = t.labels.select("doc_id", "toxic")
    return stack(rows.where("toxic = 1"), rows.where("toxic = 0").select("toxic", "doc_id"))


# ---------------------------------------------------------------- training sets


def _sample_sql(source: str, label: str, key: str, ratio: int, columns: str) -> str:
    return f"""
    select {columns} from {source}, (select sum({label}) * {float(ratio)} / nullif(sum(1 - {label}), 0) as share from {source})
    where {label} = 1 or cast('0x' || substr(md5({key}), 1, 8) as bigint) / 4294967296.0 < share
    """


def _negative_sql(ratio: int) -> str:
    return _sample_sql(
        "labels",
        "toxic",
        "'7|' || cast(doc_id as varchar)",
        ratio,
        f"doc_id, {casts('bigint', ['quality', 'toxic'])}",
    )


@query("negative_sample", _negative_sql(4))
def negative_sample(t: Tables):
    return downsample(t.labels, "toxic", 4, ["doc_id"], seed=7)


@query("negative_sample_all", _negative_sql(1000))
def negative_sample_all(t: Tables):
    """More negatives asked for than there are."""
    return downsample(t.labels, "toxic", 1000, ["doc_id"], seed=7)


@query(
    "negatives_by_month",
    with_ctes(
        COHORT_CTES,
        """
        with h as (select *, md5('7|' || mobile_id || '|' || mobile_acc_id || '|' || mobile_msisdn) as d,
            sum(target_active_churn) over (partition by table_business_month) as positives from cohorts),
        r as (select *, row_number() over (partition by table_business_month, target_active_churn
            order by substr(d, 1, 8), mobile_id, mobile_acc_id, mobile_msisdn) as rn from h)
        select mobile_id, mobile_acc_id, mobile_msisdn, target_active_churn, table_business_month from r
        where target_active_churn = 1 or rn <= floor(positives * 2.5)
        """,
    ),
    LABEL_ROLES,
)
def negatives_by_month(t: Tables):
    """Two and a half negatives for each positive, in every month."""
    rows = targets_frame(t).drop("row_num")
    return downsample_strata(rows, training.LABEL, 2.5, training.label_keys(), [training.MONTH], seed=7)


@query(
    "training_set",
    """
    select l.doc_id, cast(l.quality as bigint) as quality, d.lang, d.n_chars, e.label
    from labels l left join documents d on l.doc_id = d.doc_id
    left join (select vec_id, cast(label as bigint) as label from embeddings) e on l.doc_id = e.vec_id
    """,
)
def training_rows(t: Tables):
    docs = t.documents.select("doc_id", "lang", "n_chars")
    vectors = t.embeddings.select(F.col("vec_id").alias("doc_id"), "label")
    return enrich(enrich(t.labels.select("doc_id", "quality"), docs, ["doc_id"]), vectors, ["doc_id"])


_FEATURES = ["live_dur_contract", "pay_00mm", "active_serv_cnt"]
_MOBILE_FEATURES = ["balance", "segment", "model_age"]
LABEL_MONTHS = (date(2001, 5, 1), date(2001, 6, 1))
#: Months before that of ``AS_OF`` whose marts are stored; the label of June finds its own month, that of May an older one.
STORED = (4, 2)
_SAMPLED_CTES = {
    **COHORT_CTES,
    "wanted": "select * from cohorts where table_business_month between '2001-05-01' and '2001-06-01'",
    "sampled": _sample_sql(
        "wanted",
        "target_active_churn",
        "'5|' || mobile_id || '|' || mobile_acc_id || '|' || mobile_msisdn || '|' || table_business_month",
        3,
        "*",
    ),
}
_SPLIT_ROLES = tuple(dict.fromkeys([*fixed_queries.FIXED_SOURCES, *LABEL_ROLES]))


def _marts_sql(back: int) -> dict[str, str]:
    """Both marts as of ``back`` months earlier, with the columns that the split takes."""
    fixed_sql = with_ctes(fixed_queries.MART_CTES, f"select {', '.join([*_LINE, *_FEATURES])} from fixed_mart")
    mobile_sql = f"select msisdn, {', '.join(_MOBILE_FEATURES)} from ({mobile_queries.MART_CTE})"
    return {f"fixed_{back}": moved(fixed_sql, back), f"mobile_{back}": moved(mobile_sql, back)}


# what the label of May may know: the marts of April serve May and June
_SPLIT_AS_OF = month_end(AS_OF, 3)


@query(
    "training_split",
    with_ctes(
        {**_marts_sql(3), **_SAMPLED_CTES},
        f"""
        select sampled.mobile_id, sampled.mobile_acc_id, sampled.mobile_msisdn as msisdn, target_active_churn,
          sampled.table_business_month, {', '.join(f'f.{c}' for c in _FEATURES)}, {', '.join(f'm.{c}' for c in _MOBILE_FEATURES)}
        from sampled left join fixed_3 f using (mobile_id, mobile_acc_id, mobile_msisdn)
        left join mobile_3 m on m.msisdn = sampled.mobile_msisdn
        """,
    ),
    _SPLIT_ROLES,
)
def training_split(t: Tables):
    """One snapshot, older than every label month, serves all of them."""
    keys = training.label_keys()
    marts = (
        fixed_queries.fixed_mart_frame(t, _SPLIT_AS_OF).select(*keys, *_FEATURES),
        mobile_queries.mart_frame(t, _SPLIT_AS_OF).select("msisdn", *_MOBILE_FEATURES),
    )
    targets = targets_frame(t).drop("row_num")
    return training.build_split(targets, *marts, LABEL_MONTHS, ratio=3, seed=5)


def _all_months_sql(mart: str, columns: list[str]) -> str:
    return " union all ".join(f"select {', '.join(columns)}, {day(month_start(AS_OF, k))} as m from {mart}_{k}" for k in STORED)


@query(
    "training_split_by_month",
    with_ctes(
        {
            **{name: text for k in STORED for name, text in _marts_sql(k).items()},
            **_SAMPLED_CTES,
            "fixed_months": _all_months_sql("fixed", [*_LINE, *_FEATURES]),
            "mobile_months": _all_months_sql("mobile", ["msisdn", *_MOBILE_FEATURES]),
        },
        f"""
        select s.mobile_id, s.mobile_acc_id, s.mobile_msisdn as msisdn, target_active_churn, s.table_business_month,
          {', '.join(f'f.{c}' for c in _FEATURES)}, {', '.join(f'm.{c}' for c in _MOBILE_FEATURES)},
          cast(f.m as varchar) as fixed_feature_month, cast(m.m as varchar) as mobile_feature_month
        from sampled s
        left join lateral (select * from fixed_months f where f.mobile_id = s.mobile_id and f.mobile_acc_id = s.mobile_acc_id
          and f.mobile_msisdn = s.mobile_msisdn and f.m <= cast(s.table_business_month as date) - to_months(1) order by f.m desc limit 1) f on true
        left join lateral (select * from mobile_months m where m.msisdn = s.mobile_msisdn
          and m.m <= cast(s.table_business_month as date) - to_months(1) order by m.m desc limit 1) m on true
        """,
    ),
    _SPLIT_ROLES,
)
def training_split_by_month(t: Tables):
    """Both marts stored for two months; each label meets the newest features at least a month older than it."""
    names = {}
    grains = {"fixed": fixed_queries.MART_KEYS, "mobile": ["msisdn"]}
    for mart, frame in (("fixed", fixed_queries.fixed_mart_frame), ("mobile", mobile_queries.mart_frame)):
        names[mart], path = fresh_table(t.spark, f"{mart}_months")
        for k in STORED:
            training.publish_month(frame(t, month_end(AS_OF, k)), names[mart], unique=grains[mart], path=path)
    marts = (
        load(t.spark, names["fixed"]).select(*training.label_keys(), *_FEATURES, training.MONTH),
        load(t.spark, names["mobile"]).select("msisdn", *_MOBILE_FEATURES, training.MONTH),
    )
    targets = targets_frame(t).drop("row_num")
    return training.build_split(targets, *marts, LABEL_MONTHS, ratio=3, seed=5, lag=1, within=None)


_ORDER_LABEL = "cast(date_trunc('month', o_orderdate) as date)"


@query(
    "training_point_in_time",
    f"""
    with lab as (select distinct o_custkey, {_ORDER_LABEL} as m from orders),
    feat as (select o_custkey, {_ORDER_LABEL} as m, count(*) as n_orders from orders group by all),
    mob as (select o_custkey, m, cast(max(o_totalprice) as double) as top_price
      from (select *, cast(date_trunc('month', o_orderdate) as date) as m from orders) group by 1, 2)
    select cast(0 as bigint) as mobile_id, lab.o_custkey as mobile_acc_id, lab.o_custkey as msisdn,
      cast(lab.m as varchar) as table_business_month, n_orders, top_price
    from lab left join feat on lab.o_custkey = feat.o_custkey and feat.m = cast(lab.m - to_months(1) as date)
    left join mob on lab.o_custkey = mob.o_custkey and mob.m = cast(lab.m - to_months(1) as date)
    """,
)
def training_point_in_time(t: Tables):
    """Labels meet the features of the month before."""
    month = F.trunc("o_orderdate", "month").alias("table_business_month")
    line = [
        F.lit(0).alias("mobile_id"),
        F.col("o_custkey").alias("mobile_acc_id"),
        F.col("o_custkey").alias("mobile_msisdn"),
    ]
    labels = t.orders.select(*line, month).distinct()
    features = t.orders.groupBy(*line, month).agg(F.count("*").alias("n_orders"))
    mobile_mart = t.orders.groupBy(F.col("o_custkey").alias("msisdn"), month).agg(
        F.max("o_totalprice").alias("top_price")
    )
    return training.training_set(labels, features, mobile_mart, lag=1)


# ---------------------------------------------------------------- profiles

_ITEM = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]
_NULLABLE = """(select o_orderkey, case when o_orderstatus = 'F' then o_custkey end as o_custkey, o_orderstatus,
  'x' as constant, case when o_orderpriority = '5-LOW' then null else o_orderpriority end as priority, o_totalprice from orders)"""
_NULLABLE_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "constant", "priority", "o_totalprice"]


def nullable_orders(t: Tables):
    return t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).alias("o_custkey"),
        "o_orderstatus",
        F.lit("x").alias("constant"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"),
        "o_totalprice",
    )


def profile_sql(source: str, columns) -> str:
    return " union all ".join(
        f"""
        select '{c}' as "column", cast(count(v) as bigint) as n_unique,
          cast(coalesce(sum(case when v is not null then n end), 0) as double) / cast(sum(n) as double) as fill_rate,
          coalesce(cast(max(case when v is not null then n end) as double) / cast(sum(case when v is not null then n end) as double), 0.0) as top_1_share
        from (select {c} as v, count(*) as n from {source} group by 1)
        """
        for c in columns
    )


@query("column_profile", profile_sql("lineitem", _ITEM))
def column_profile(t: Tables):
    return profile.column_profile(t.lineitem)


@query(
    "feature_metric_pivot",
    f'select "column", cast(n_unique as double) as n_unique, fill_rate, top_1_share from ({profile_sql(_NULLABLE, _NULLABLE_COLUMNS)})',
)
def feature_metric_pivot(t: Tables):
    return profile.metric_pivot(profile.metric_rows(profile.column_profile(nullable_orders(t))))


_SELECTED = f"""
select "column" from ({profile_sql(_NULLABLE, _NULLABLE_COLUMNS)})
where n_unique >= 2 and fill_rate >= 0.8 and top_1_share <= 0.9 and "column" <> 'o_orderkey'
"""


@query("feature_select", _SELECTED)
def feature_select(t: Tables):
    return profile.select_features(profile.column_profile(nullable_orders(t)), exclude=["o_orderkey"])


@query(
    "feature_catalog",
    f"""
    select "column" as feature_name, dtype, case when dtype = 'string' then 'cat' else 'num' end as type
    from ({_SELECTED}) join (values ('o_orderstatus', 'string'), ('priority', 'string'), ('o_totalprice', 'double')) v(c, dtype) on c = "column"
    """,
)
def feature_catalog(t: Tables):
    return training.feature_catalogue(nullable_orders(t), {"exclude": ["o_orderkey"]})


@query(
    "null_profile",
    f"""
    select v.c as name, v.dtype, cast(n as bigint) as non_null_cnt from ({' union all '.join(f"select '{c}' as c, count({c}) as n from {_NULLABLE}" for c in _NULLABLE_COLUMNS)})
    join (values ('o_orderkey', 'bigint'), ('o_custkey', 'bigint'), ('o_orderstatus', 'string'), ('constant', 'string'),
      ('priority', 'string'), ('o_totalprice', 'double')) v(c, dtype) using (c)
    """,
)
def null_profile(t: Tables):
    return profile.null_profile(nullable_orders(t))


@query(
    "feature_join",
    """
    select c_custkey as msisdn, c_mktsegment, n from customer
    join (select o_custkey, count(*) as n from orders group by 1) on c_custkey = o_custkey
    """,
)
def feature_join(t: Tables):
    counts = t.orders.groupBy(F.col("o_custkey").alias("mobile_msisdn")).agg(F.count("*").alias("n"))
    customers = t.customer.select(F.col("c_custkey").alias("msisdn"), "c_mktsegment")
    return training.feature_join(counts, customers)


# ---------------------------------------------------------------- model quality


def scored(t: Tables):
    docs = t.documents.select("doc_id", F.expr("n_chars div 50").alias("score"))
    return t.labels.select("doc_id", "quality").join(docs, "doc_id")


_SCORED = "(select doc_id, quality, n_chars // 50 as score from labels join documents using (doc_id))"


@query(
    "confusion_matrix",
    f"""
    select 'act_POS' as actual, count(case when quality = 1 and score > 30 then 1 end) as pred_POS,
      count(case when quality = 1 and score <= 30 then 1 end) as pred_NEG from {_SCORED}
    union all select 'act_NEG', count(case when quality = 0 and score > 30 then 1 end),
      count(case when quality = 0 and score <= 30 then 1 end) from {_SCORED}
    """,
)
def confusion_matrix(t: Tables):
    return confusion(scored(t), "quality", "score", 30)


def lift_sql(source: str, n: int) -> str:
    return f"""
    with b as (select quality, ntile({n}) over (order by score desc, doc_id) as top from {source}),
    g as (select top, sum(quality) as target_cnt, count(*) as cnt from b group by top),
    c as (select *, sum(target_cnt) over (order by top) as tc, sum(cnt) over (order by top) as cc,
      sum(target_cnt) over () as ta, sum(cnt) over () as na from g)
    select cast(top as bigint) as top, cast(target_cnt as bigint) as target_cnt, cast(cnt as bigint) as cnt,
      cast(tc as bigint) as target_cnt_cum, cast(cc as bigint) as cnt_cum,
      cast(target_cnt as double) / cnt as target_share, cast(tc as double) / cast(cc as double) as target_share_cum,
      (cast(target_cnt as double) / cnt) / (cast(ta as double) / cast(na as double)) as lift,
      (cast(tc as double) / cast(cc as double)) / (cast(ta as double) / cast(na as double)) as cum_lift,
      cast(tc as double) / cast(ta as double) as coverage from c
    """


@query("lift_table", lift_sql(_SCORED, 10))
def lift(t: Tables):
    """Many scores are equal, so the key decides within a bucket border."""
    return lift_table(scored(t), "quality", "score", ["doc_id"], unique=True)




@query(
    "lift_sketches",
    f"""
    with s as (select quality, cast(score as double) as score from {_SCORED}),
    r as (select quality, score, count(*) over (order by score) as upto, count(*) over () as n from s),
    borders as (select distinct min(score) as b from r, (select unnest(range(1, 10)) as i) where upto >= (1 - i / 10.0) * n group by i),
    placed as (select quality, (select count(*) from borders where b >= score) as above from r),
    ranked as (select quality, dense_rank() over (order by above) as top from placed)
    select * from ({lift_sql('LIFTED', 10)})
    """.replace("select quality, ntile(10) over (order by score desc, doc_id) as top from LIFTED", "select quality, top from ranked"),
)
def lift_sketches(t: Tables):
    """Two scoring runs sketched apart and added up; small enough for the sketches to be exact."""
    rows = scored(t)
    runs = score_sketches(rows.withColumn("run", F.col("doc_id") % 2), "quality", "score", ["run"])
    return lift_from_sketches(merge_score_sketches(runs))


_PROFILED = ["o_orderstatus", "o_orderpriority", "o_clerk_group", "nothing"]


def _profile_months(t: Tables):
    month = F.date_format("o_orderdate", "yyyy-MM").alias("month")
    rows = t.orders.select(
        month, "o_orderstatus", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("o_orderpriority"),
        (F.col("o_custkey") % 7).alias("o_clerk_group"), F.lit(None).cast("string").alias("nothing"),
    )
    return rows.where("month in ('2001-06', '2001-07')")


_PROFILE_ROWS = """(select strftime(o_orderdate, '%Y-%m') as month, o_orderstatus, case when o_orderpriority <> '5-LOW' then o_orderpriority end as o_orderpriority,
  o_custkey % 7 as o_clerk_group, cast(null as varchar) as nothing from orders where strftime(o_orderdate, '%Y-%m') in ('2001-06', '2001-07'))"""


def _profile_parts(*months: str) -> str:
    part = lambda m: f"(select * from {_PROFILE_ROWS} where '{m}' in (month, 'both'))"
    return " union all ".join(f"select '{m}' as month, * from ({profile_sql(part(m), _PROFILED)})" for m in months)


@query("profile_months", _profile_parts("2001-06", "2001-07", "both"))
def profile_months(t: Tables):
    """Sketches stored by month; the months' profiles and that of both together come from them."""
    name, path = fresh_table(t.spark, "profile_months")
    for month in ("2001-06", "2001-07"):
        part = _profile_months(t).where(F.col("month") == month)
        replace_partition(profile.profile_sketches(part, ["month"]), name, "month", fmt="parquet", path=path)
    stored = load(t.spark, name)
    both = profile.profile_of(profile.merge_profiles(stored)).withColumn("month", F.lit("both"))
    return stack(profile.profile_of(stored, ["month"]), both)


@query(
    "profile_drift",
    f"""
    with p as ({_profile_parts("2001-06", "2001-07")})
    select b.month, "column", b.n_unique - a.n_unique as n_unique_change, b.fill_rate - a.fill_rate as fill_rate_change,
      b.top_1_share - a.top_1_share as top_1_share_change
    from p a join p b using ("column") where a.month = '2001-06' and b.month = '2001-07'
    """,
)
def profile_drift(t: Tables):
    return profile.profile_drift(profile.profile_of(profile.profile_sketches(_profile_months(t), ["month"]), ["month"]), "month")


_REPORT = ["target_cnt", "cnt", "target_share", "lift", "cum_lift", "coverage"]
_CONFUSION = f"""
select 'act_POS' as item, count(case when quality = 1 and score > 30 then 1 end) as pred_POS,
  count(case when quality = 1 and score <= 30 then 1 end) as pred_NEG from {_SCORED}
union all select 'act_NEG', count(case when quality = 0 and score > 30 then 1 end),
  count(case when quality = 0 and score <= 30 then 1 end) from {_SCORED}
"""


def _long_sql(part: str, source: str, item: str, metrics: list[str]) -> str:
    return " union all ".join(
        f"select '{part}' as part, {item} as item, '{m}' as metric, cast({m} as double) as value from {source}" for m in metrics
    )


@query(
    "quality_report",
    f"with c as ({_CONFUSION}), l as (select * from ({lift_sql(_SCORED, 10)})) "
    + _long_sql("confusion", "c", "item", ["pred_POS", "pred_NEG"])
    + " union all "
    + _long_sql("lift", "l", "cast(top as varchar)", _REPORT),
)
def quality_report(t: Tables):
    """Both tables of the report, in long form."""
    matrix, lifts = training.quality_report(scored(t), "quality", "score", ["doc_id"], 30, 10)

    def long(df, part, item, metrics):
        numbers = df.select(F.col(item).cast("string").alias("item"), *[F.col(m).cast("double").alias(m) for m in metrics])
        return numbers.unpivot("item", metrics, "metric", "value").select(F.lit(part).alias("part"), "item", "metric", "value")

    return stack(long(matrix, "confusion", "actual", ["pred_POS", "pred_NEG"]), long(lifts, "lift", "top", _REPORT))
