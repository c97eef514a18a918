"""Queries of the mobile part."""

from __future__ import annotations

from datetime import date
from itertools import combinations

from pyspark.sql import functions as F

from featuremart.catalogue.registry import AS_OF, Tables, casts, day, query, role_sql, with_ctes
from featuremart.functions.calendar import add_months, month_end, month_start
from featuremart.functions.geo import great_circle_m
from featuremart.functions.temporal import within_days
from featuremart.functions.text import prefixed, slug
from featuremart.operators.categorical import (
    category_matrix,
    contact_counts,
    merge_vectors,
    pivot_counts,
    spread_vectors,
)
from featuremart.operators.joins import (
    assemble,
    attach_history,
    explode_list,
    fill_typed,
    full_merge,
    spine,
    stack,
    stamp,
)
from featuremart.operators.moves import pair_moves
from featuremart.operators.ranking import cap_rows
from featuremart.operators.snapshots import lag_columns, one_per_key
from featuremart.plans import mobile
from featuremart.sources.tables import small_table

D = day(AS_OF)
BUILD_DT = date(2001, 8, 1)
DATES = ["tp_change_dt", "max_subs_fee_dt_day_31d", "last_active_roam_dt_day_90d"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
PRIORITIES = ["1.URGENT", "2.HIGH", "3.MEDIUM", "4.NOT SPECIFIED", "5.LOW"]

# ---------------------------------------------------------------- base block

_AGES = ", ".join(f"cast({D} - {c} as bigint) as {mobile.age_name(c)}" for c in DATES)
_BASE = f"""
select msisdn, app_n, cast(regid as bigint) as regid, {casts('varchar', DATES)}, tariff, segment, balance,
  cast(m_reg_cd as bigint) as m_reg_cd, {_AGES}, calls_m1, revenue_specavg_month_3m, hist_dt
from daily_profile left join (select app_n, regid, cast(calls_m1 as bigint) as calls_m1,
  cast(revenue_specavg_month_3m as double) as revenue_specavg_month_3m, cast(version_dt as varchar) as hist_dt
  from monthly_history) using (app_n, regid)
"""


def base_frame(t: Tables, as_of=AS_OF):
    history = t.monthly_history.withColumnRenamed("version_dt", "hist_dt")
    return mobile.mobile_base(t.daily_profile, history, as_of, DATES)


_NO_NAN = "* replace (case when isnan(balance) or balance is null then -1 else balance end as balance)"


@query(
    "mobile_base",
    f"select {_NO_NAN} from ({_BASE})",
    ("daily_profile", "monthly_history"),
)
def mobile_base(t: Tables):
    return fill_typed(base_frame(t), num=-1, columns=["balance"])


_CURATED = ["msisdn", "tariff", mobile.age_name(DATES[0]), "calls_m1"]


@query(
    "curated_columns",
    f"select {', '.join(_CURATED)} from ({_BASE})",
    ("daily_profile", "monthly_history"),
)
def curated_columns(t: Tables):
    history = t.monthly_history.withColumnRenamed("version_dt", "hist_dt")
    return mobile.mobile_base(t.daily_profile, history, AS_OF, DATES, columns=_CURATED)


@query(
    "monthly_history_join",
    """
    select c_custkey, c_mktsegment, month, n, cast(amount as double) as amount from customer left join (
      select o_custkey, cast(cast(date_trunc('month', o_orderdate) as date) as varchar) as month, count(*) as n,
        sum(cast(o_totalprice as decimal(18, 2))) as amount from orders group by all) on c_custkey = o_custkey
    """,
)
def monthly_history_join(t: Tables):
    history = t.orders.groupBy(
        F.col("o_custkey").alias("c_custkey"), F.trunc("o_orderdate", "month").alias("month")
    ).agg(
        F.count("*").alias("n"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("amount"),
        F.first("o_orderstatus").alias("c_mktsegment"),
    )
    base = t.customer.select("c_custkey", "c_mktsegment")
    return attach_history(base, history, ["c_custkey"], drop=["c_mktsegment"])


@query(
    "row_cap",
    """
    select o_orderkey, o_custkey from (select o_orderkey, o_custkey, row_number() over (
      order by substr(md5('11|' || cast(o_orderkey as varchar)), 1, 8), o_orderkey) as rn from orders)
    where rn <= 1000
    """,
)
def row_cap(t: Tables):
    return cap_rows(t.orders.select("o_orderkey", "o_custkey"), 1000, ["o_orderkey"], seed=11)


@query("phone_prefix", "select c_custkey, '7' || cast(c_custkey as varchar) as phone from customer")
def phone_prefix(t: Tables):
    return t.customer.select("c_custkey", prefixed("7", "c_custkey").alias("phone"))


# ---------------------------------------------------------------- scores

_SCORES = """
select coalesce(a.msisdn, b.msisdn, c.msisdn) as msisdn, cast(model_sex as bigint) as model_sex,
  cast(model_age as bigint) as model_age, cast(model_income as bigint) as model_income
from (select msisdn, max(model_sex) as model_sex from score_sex group by msisdn) a
full join (select msisdn, max(model_age) as model_age from score_age group by msisdn) b on a.msisdn = b.msisdn
full join (select msisdn, max(model_income) as model_income from score_income group by msisdn) c
  on coalesce(a.msisdn, b.msisdn) = c.msisdn
"""
_SCORE_ROLES = ("score_sex", "score_age", "score_income")


def scores_frame(t: Tables):
    return mobile.demographic_scores(t.score_sex, t.score_age, t.score_income)


@query("mobile_scores", _SCORES, _SCORE_ROLES)
def mobile_scores(t: Tables):
    return scores_frame(t)


@query(
    "score_merge",
    """
    select doc_id, cast(quality as bigint) as quality, n_chars, cast(toxic as bigint) as toxic
    from (select doc_id, quality from labels) full join (select doc_id, n_chars from documents) using (doc_id)
      full join (select doc_id, toxic from labels) using (doc_id)
    """,
)
def score_merge(t: Tables):
    return full_merge(
        [
            t.labels.select("doc_id", "quality"),
            t.documents.select("doc_id", "n_chars"),
            t.labels.select("doc_id", "toxic"),
        ],
        ["doc_id"],
    )


# ---------------------------------------------------------------- contacts


def clean(text: str) -> str:
    return text.replace(".", "").lower()


_NET = ["Net.A", "Net.N", "Net.R"]
_CHANNELS = [
    ("sms", "call_sms", mobile.SMS_PREFIX, PRIORITIES),
    ("calls", "call_cnt", mobile.CALLS_PREFIX, EVENT_TYPES),
    ("web", "request_cnt", mobile.WEB_PREFIX, _NET),
]


def _contacts_sql() -> str:
    columns = [
        f"cast(coalesce(sum(case when ch = '{role}' and competitor = '{v}' then n end), 0) as bigint)"
        f' as "{prefix}{clean(v)}"'
        for role, _, prefix, values in _CHANNELS
        for v in values
    ]
    rows = " union all ".join(
        f"select msisdn, '{role}' as ch, competitor, {measure} as n from {role}" for role, measure, *_ in _CHANNELS
    )
    return f"select msisdn, {', '.join(columns)} from ({rows}) group by msisdn"


_CONTACTS = _contacts_sql()


def contacts_frame(t: Tables):
    known = {role: [clean(v) for v in values] for role, _, _, values in _CHANNELS}
    return mobile.competitor_contacts(t.sms, t.calls, t.web, values=known)


@query("mobile_contacts", _CONTACTS, ("sms", "calls", "web"))
def mobile_contacts(t: Tables):
    return contacts_frame(t)


@query("mobile_contacts_discovered", _CONTACTS, ("sms", "calls", "web"))
def mobile_contacts_discovered(t: Tables):
    """The same with the competitors looked up in the data."""
    return mobile.competitor_contacts(t.sms, t.calls, t.web)


@query(
    "contact_counts",
    """
    select o_custkey, lower(replace(o_orderpriority, '-', '')) as priority, count(*) * 2 as cnt
    from orders group by all
    """,
)
def contact_counts_rows(t: Tables):
    rows = t.orders.select(
        "o_custkey", F.translate("o_orderpriority", "-", ".").alias("priority"), F.lit(2).alias("two")
    )
    return contact_counts(rows, ["o_custkey"], "priority", "two", "cnt")


@query(
    "contact_pivot",
    "select key, "
    + ", ".join(f"max(ev_{e}) as ev_{e}" for e in [*EVENT_TYPES[:3], "other"])
    + ", "
    + ", ".join(f"max(st_{s}) as st_{s}" for s in "FOP")
    + " from (select user_id as key, "
    + ", ".join(f"cast(sum(case when event_type = '{e}' then 1 end) as bigint) as ev_{e}" for e in EVENT_TYPES[:3])
    + ", cast(sum(case when event_type not in ('click', 'error', 'purchase') then 1 end) as bigint) as ev_other"
    + ", null as st_F, null as st_O, null as st_P from events group by user_id"
    + " union all select o_custkey, null, null, null, null, "
    + ", ".join(f"cast(sum(case when o_orderstatus = '{s}' then 1 end) as bigint)" for s in "FOP")
    + " from orders group by o_custkey) group by key",
)
def contact_pivot(t: Tables):
    """Pivots of events and orders, merged full outer; unlisted event types go to ``other``."""
    events = t.events.select(F.col("user_id").alias("key"), "event_type", F.lit(1).alias("n"))
    orders = t.orders.select(F.col("o_custkey").alias("key"), "o_orderstatus", F.lit(1).alias("n"))
    return full_merge(
        [
            pivot_counts(events, ["key"], "event_type", "n", "ev_", EVENT_TYPES[:3], other="other"),
            pivot_counts(orders, ["key"], "o_orderstatus", "n", "st_"),
        ],
        ["key"],
    )


@query("name_cleaning", "select page_id, lower(replace(url, '.', '')) as name from pages")
def name_cleaning(t: Tables):
    return t.pages.select("page_id", slug("url").alias("name"))


# ---------------------------------------------------------------- places

_DAYS = [add_months(AS_OF.replace(day=mobile.PLACE_DAY), -k) for k in range(4)]


def _distance(p: str, a: int, b: int) -> str:
    lat_a, lon_a, lat_b, lon_b = (f"{p}_{x}_{k}" for k in (a, b) for x in ("lat", "lon"))
    cosine = (
        f"sin(radians({lat_a})) * sin(radians({lat_b})) + cos(radians({lat_a})) * cos(radians({lat_b}))"
        f" * cos(radians({lon_a}) - radians({lon_b}))"
    )
    return (
        f"round(case when {lat_a} = {lat_b} and {lon_a} = {lon_b} then 0.0"
        f" else acos(case when {cosine} > 1 then 1 when {cosine} < -1 then -1 else {cosine} end) * 6371000.0 end)"
    )


_LAGS = (
    "select msisdn, "
    + ", ".join(
        f"max(case when business_dt = {day(d)} then {c} end) as {c}_{k}"
        for k, d in enumerate(_DAYS)
        for c in ("home_lat", "home_lon", "work_lat", "work_lon")
    )
    + f" from places group by msisdn having max(case when business_dt = {day(_DAYS[0])} then 1 else 0 end) = 1"
)
_MOVES = (
    "select msisdn, "
    + ", ".join(
        f"cast({_distance(p, a, b)} as double) as {p}_diff_{a}_{b}"
        for a, b in combinations(range(4), 2)
        for p in ("home", "work")
    )
    + f" from ({_LAGS})"
)


def home_work(t: Tables):
    """The places as the location source has them, with nested coordinates."""
    coordinates = [
        F.struct(F.col(f"{p}_lat").alias("lat"), F.col(f"{p}_lon").alias("lon")).alias(f"{p}_place_coord")
        for p in ("home", "work")
    ]
    return t.places.select("msisdn", "business_dt", *coordinates)


def moves_frame(t: Tables, as_of=AS_OF):
    moves = mobile.relocations(home_work(t), as_of)
    return moves.select("msisdn", *[F.round(c).alias(c) for c in moves.columns[1:]])


@query("home_work_moves", _MOVES, ("places",))
def home_work_moves(t: Tables):
    """Whole metres, since the last digits of trigonometric functions differ between engines."""
    return moves_frame(t)


@query("month_lag", f"select msisdn, home_lat_0, home_lat_1, home_lat_2, home_lat_3 from ({_LAGS})", ("places",))
def month_lag(t: Tables):
    places = {"home_lat": F.col("home_place_coord.lat"), "home_lon": F.col("home_place_coord.lon")}
    lagged = lag_columns(home_work(t), ["msisdn"], "business_dt", places, _DAYS)
    return lagged.select("msisdn", *[f"home_lat_{k}" for k in range(4)])


@query("nested_fields", "select msisdn, cast(business_dt as varchar) as business_dt, home_lat, work_lon from places", ("places",))
def nested_fields(t: Tables):
    return home_work(t).select(
        "msisdn",
        "business_dt",
        F.col("home_place_coord.lat").alias("home_lat"),
        F.col("work_place_coord.lon").alias("work_lon"),
    )


@query(
    "great_circle",
    f"""
    select msisdn, cast(business_dt as varchar) as business_dt, cast({_distance('x', 0, 1)} as double) as metres
    from (select *, home_lat as x_lat_0, home_lon as x_lon_0, work_lat as x_lat_1, work_lon as x_lon_1 from places)
    """,
    ("places",),
)
def great_circle(t: Tables):
    here = great_circle_m(F.col("home_lon"), F.col("home_lat"), F.col("work_lon"), F.col("work_lat"))
    return t.places.select("msisdn", "business_dt", F.round(here).alias("metres"))


@query(
    "pairwise_moves",
    f"""
    select o_orderkey, cast({_distance('x', 0, 1)} as double) as x_diff_0_1 from (
      select o_orderkey, 54 + cast(o_orderkey % 700 as double) / 100 as x_lat_0, 30 + cast(o_custkey % 900 as double) / 100 as x_lon_0,
        54 + cast(o_custkey % 700 as double) / 100 as x_lat_1, 30 + cast(o_orderkey % 900 as double) / 100 as x_lon_1 from orders)
    """,
)
def pairwise_moves(t: Tables):
    def place(base: int, col: str, mod: int):
        return F.lit(base) + (F.col(col) % mod).cast("double") / 100

    points = t.orders.select(
        "o_orderkey",
        place(54, "o_orderkey", 700).alias("x_lat_0"),
        place(30, "o_custkey", 900).alias("x_lon_0"),
        place(54, "o_custkey", 700).alias("x_lat_1"),
        place(30, "o_orderkey", 900).alias("x_lon_1"),
    )
    moved = points.select("o_orderkey", *pair_moves(["x"], 2))
    return moved.select("o_orderkey", F.round("x_diff_0_1").alias("x_diff_0_1"))


@query(
    "one_per_line",
    """
    select user_id, event_id, event_type from (select *, row_number() over (
      partition by user_id order by ts, event_id) as rn from events) where rn = 1
    """,
)
def one_per_line(t: Tables):
    rows = t.events.select("user_id", "event_id", "event_type", "ts")
    return one_per_key(rows, ["user_id"], ["ts", "event_id"]).drop("ts")


# ---------------------------------------------------------------- interests


def _metric(column: str) -> str:
    return f"case when isnan({column}) or {column} is null then 0 else {column} end"


def _matrix(keys: str, category: str, metrics: dict[str, str], values, source: str) -> str:
    columns = ", ".join(
        f'cast(sum(case when {category} = {v} then {_metric(m)} else 0 end) as double) as "{name.format(v)}"'
        for v in values
        for m, name in metrics.items()
    )
    return f"select {keys}, {columns} from {source} group by {keys}"


_INTERESTS = _matrix(
    "regid, app_n, msisdn",
    "category_id",
    mobile.INTEREST_METRICS,
    range(1, mobile.CATEGORIES + 1),
    f"(select * from interest where cast(business_dt as date) = {D})",
)


def interests_frame(t: Tables):
    return mobile.host_interests(t.interest, AS_OF)


@query(
    "mobile_interests",
    f"select * replace (cast(regid as bigint) as regid) from ({_INTERESTS})",
    ("interest",),
)
def mobile_interests(t: Tables):
    return interests_frame(t)


# a line under several regions and applications, with interests in several months
_WIDE_LINES = """
select l_suppkey as msisdn, cast(l_orderkey % 3 as int) as app_n, l_linenumber as regid, l_partkey % 97 as category_id,
  last_day(cast(l_shipdate as date)) as business_dt, cast(floor(l_quantity) as double) as num_requests_to_overall_by_user,
  cast(l_linenumber as double) as num_active_days_to_overall_by_user,
  case when l_linenumber = 2 then cast('NaN' as double) when l_linenumber = 4 then null
    else cast(floor(l_extendedprice) as double) end as num_requests_to_mean_by_category,
  cast(floor(l_tax * 100) as double) as num_active_days_to_mean_by_category
from {lineitem}
"""


@query(
    "interests_per_line",
    _matrix("msisdn", "category_id", mobile.INTEREST_METRICS, range(1, mobile.CATEGORIES + 1), f"({_WIDE_LINES.format(lineitem='lineitem')})"),
)
def interests_per_line(t: Tables):
    """Vectors per region and application, added up per line and spread at the end."""
    rows = t.spark.sql(_WIDE_LINES, lineitem=t.lineitem)
    finer = mobile.interest_vectors(rows, AS_OF, keys=("msisdn", "regid", "app_n"), month_col=None)
    merged = merge_vectors(finer, ["msisdn"], mobile.INTERESTS)
    return spread_vectors(merged, mobile.INTERESTS, mobile.INTEREST_METRICS, range(1, mobile.CATEGORIES + 1))


_PART_METRICS = {"l_quantity": "cat_{}_quantity", "n": "cat_{}_lines", "l_linenumber": "cat_{}_numbers", "cents": "cat_{}_cents"}


@query(
    "interest_matrix",
    _matrix(
        "o_custkey",
        "p_size",
        _PART_METRICS,
        range(1, 51),
        """(select o_custkey, p_size, l_quantity, cast(1 as double) as n, cast(l_linenumber as double) as l_linenumber,
        round(l_extendedprice * 100) as cents from lineitem join orders on l_orderkey = o_orderkey
        join part on l_partkey = p_partkey)""",
    ),
)
def interest_matrix(t: Tables):
    rows = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            "o_custkey",
            "p_size",
            "l_quantity",
            "l_linenumber",
            F.lit(1.0).alias("n"),
            F.round(F.col("l_extendedprice") * 100).alias("cents"),
        )
    )
    return category_matrix(rows, ["o_custkey"], "p_size", _PART_METRICS, range(1, 51))


# ---------------------------------------------------------------- the mart

_MART_ROLES = (
    "daily_profile", "monthly_history", *_SCORE_ROLES, "sms", "calls", "web", "places", "interest",
)
_CONTACT_NAMES = [f"{prefix}{clean(v)}" for _, _, prefix, values in _CHANNELS for v in values]
_MOVE_NAMES = [f"{p}_diff_{a}_{b}" for a, b in combinations(range(4), 2) for p in ("home", "work")]
_INTEREST_NAMES = [
    name.format(v) for v in range(1, mobile.CATEGORIES + 1) for name in mobile.INTEREST_METRICS.values()
]
_BASE_NUMBERS = {
    **{c: "bigint" for c in ("app_n", "regid", "m_reg_cd", "calls_m1", *[mobile.age_name(d) for d in DATES])},
    "revenue_specavg_month_3m": "double",
}


def _zero(names, kind: str) -> str:
    return ", ".join(f'cast(coalesce("{n}", 0) as {kind}) as "{n}"' for n in names)


MART_SQL = f"""
select msisdn, {', '.join(f'cast(coalesce({c}, -1) as {k}) as {c}' for c, k in _BASE_NUMBERS.items())},
  cast(case when isnan(balance) or balance is null then -1 else balance end as double) as balance,
  tp_change_dt, max_subs_fee_dt_day_31d, last_active_roam_dt_day_90d, hist_dt,
  coalesce(tariff, 'unk') as tariff, coalesce(segment, 'unk') as segment,
  {_zero(['model_sex', 'model_age', 'model_income'], 'bigint')}, {_zero(_CONTACT_NAMES, 'bigint')},
  {_zero(_MOVE_NAMES, 'double')}, {_zero(_INTEREST_NAMES, 'double')},
  '{BUILD_DT.isoformat()}' as build_dt, '{month_start(AS_OF).isoformat()}' as table_business_month
from ({_BASE}) left join ({_SCORES}) using (msisdn) left join ({_CONTACTS}) using (msisdn)
  left join ({_MOVES}) using (msisdn)
  left join (select * exclude (app_n, regid) from ({_INTERESTS})) using (msisdn)
"""


def mart_frame(t: Tables, as_of=AS_OF):
    interests = mobile.interest_vectors(t.interest, as_of)
    base, moves = base_frame(t, as_of), moves_frame(t, as_of)
    return mobile.mobile_mart(base, scores_frame(t), contacts_frame(t), moves, interests, as_of, BUILD_DT)


@query("mobile_mart", MART_SQL, _MART_ROLES)
def mobile_mart(t: Tables):
    return mart_frame(t)


MART_CTE = with_ctes({r: role_sql(r) for r in _MART_ROLES}, MART_SQL)


@query(
    "typed_fill",
    """
    select c_custkey, coalesce(segment, 'unk') as segment, cast(coalesce(n, -1) as bigint) as n,
      case when isnan(x) or x is null then -1 else x end as x, cast(first_day as varchar) as first_day
    from customer left join (select o_custkey, min(o_orderpriority) as segment, count(*) as n,
      case when count(*) > 8 then cast('NaN' as double) else cast(count(*) as double) end as x,
      min(case when o_orderstatus = 'F' then cast(o_orderdate as date) end) as first_day
      from orders group by o_custkey) on c_custkey = o_custkey
    """,
)
def typed_fill(t: Tables):
    n = F.count("*")
    stats = (
        t.orders.groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.min("o_orderpriority").alias("segment"),
            n.alias("n"),
            F.when(n > 8, F.lit(float("nan"))).otherwise(n.cast("double")).alias("x"),
            F.min(F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate").cast("date"))).alias("first_day"),
        )
    )
    return fill_typed(assemble(t.customer.select("c_custkey"), [(stats, ["c_custkey"])]), num=-1, text="unk")


@query(
    "mart_assembly",
    f"""
    select c_custkey, n_orders, n_events, seg_size, '{BUILD_DT.isoformat()}' as build_dt from customer
    left join (select o_custkey, count(*) as n_orders from orders group by 1) on c_custkey = o_custkey
    left join (select user_id, count(*) as n_events from events group by 1) on c_custkey = user_id
    left join (select c_mktsegment, count(*) as seg_size from customer group by 1) using (c_mktsegment)
    """,
)
def mart_assembly(t: Tables):
    orders = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_orders"))
    events = t.events.groupBy(F.col("user_id").alias("c_custkey")).agg(F.count("*").alias("n_events"))
    segments = t.customer.groupBy("c_mktsegment").agg(F.count("*").alias("seg_size"))
    joined = assemble(
        t.customer.select("c_custkey", "c_mktsegment"),
        [(segments, ["c_mktsegment"]), (orders, ["c_custkey"]), (events, ["c_custkey"])],
    )
    return stamp(joined.drop("c_mktsegment"), {"build_dt": BUILD_DT})


# ---------------------------------------------------------------- spines


@query(
    "calendar_spine",
    """
    select c_custkey, cast(m as bigint) as month_offset, count(o_orderkey) as n
    from customer cross join (select unnest([0, 1, 2, 3, 4]) as m) left join orders on o_custkey = c_custkey
      and cast(date_trunc('month', o_orderdate) as date) = date '2001-07-01' - to_months(cast(m as integer))
    group by c_custkey, m
    """,
)
def calendar_spine(t: Tables):
    months = small_table(t.spark, [(k,) for k in range(5)], "month_offset int")
    grid = spine(t.customer.select("c_custkey"), months)
    start = F.lit(month_start(AS_OF))
    counts = t.orders.groupBy(
        F.col("o_custkey").alias("c_custkey"),
        F.months_between(start, F.trunc("o_orderdate", "month")).cast("int").alias("month_offset"),
    ).agg(F.count("*").alias("n"))
    return assemble(grid, [(counts, ["c_custkey", "month_offset"])]).fillna(0, ["n"])


@query(
    "list_explode",
    """
    select c_custkey, cast(s as bigint) as service_id
    from customer, unnest(range(1, cast(c_nationkey % 7 + 2 as bigint))) u(s)
    """,
)
def list_explode(t: Tables):
    lists = t.customer.select(
        "c_custkey", F.sequence(F.lit(1), F.col("c_nationkey") % 7 + 1).alias("ids")
    )
    return explode_list(lists, "ids", "service_id")


@query(
    "monthly_fold",
    "select o_orderkey, cast(k as bigint) as month_offset from orders, (select unnest([0, 1, 2]) as k)"
    " where cast(date_trunc('month', o_orderdate) as date) = date '2001-07-01' - to_months(cast(k as integer))",
)
def monthly_fold(t: Tables):
    """A union of any number of monthly frames."""
    months = [within_days("o_orderdate", month_end(AS_OF, k + 1), month_end(AS_OF, k)) for k in range(3)]
    parts = [t.orders.where(m).select("o_orderkey", F.lit(k).alias("month_offset")) for k, m in enumerate(months)]
    return stack(*parts)
