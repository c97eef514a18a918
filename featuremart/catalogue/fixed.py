"""Queries of the fixed-line part."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from featuremart.catalogue.registry import (
    AS_OF,
    Tables,
    casts,
    day,
    in_month,
    in_months,
    moved,
    query,
    with_ctes,
)
from featuremart.catalogue.roles import FIXED_SOURCES
from featuremart.functions.calendar import month_end, month_start, slots
from featuremart.functions.temporal import days_since
from featuremart.functions.units import to_gb
from featuremart.operators import categorical, services, tickets
from featuremart.operators.identity import dual_identity, mask_by_role
from featuremart.operators.intervals import interval_join
from featuremart.operators.joins import attach_by, attach_flags, enrich, merge_counters, stack
from featuremart.operators.rollup import rollup_entity
from featuremart.operators.slots import dominant_by_month, month_slots, payment_block, slot_name
from featuremart.operators.snapshots import (
    any_per_key,
    latest_by,
    repair_open_date,
    snapshot,
    with_closed_flag,
    with_days_since,
    with_open_flags,
    with_tenure,
)
from featuremart.operators.states import STATE, merge_states, month_state, windows
from featuremart.plans import fixed
from featuremart.plans.fixed import ACCOUNT, EQUIPMENT_VALUES, SERVICES

D = day(AS_OF)
SLOTS = range(5)
OPEN = f"(dt_from <= {D} and coalesce(cast(dt_to as date), date '9999-12-31') > {D})"
AMOUNT = "cast(o_totalprice as decimal(18, 2))"


def slot_sum(col: str, value: str, prefix: str, style: str = "mm", kind: str = "double") -> str:
    return ", ".join(
        f"cast(sum(case when {in_month(col, k)} then {value} else 0 end) as {kind}) as {slot_name(prefix, k, style)}"
        for k in SLOTS
    )


def dominant(table: str, keys: str, col: str, class_col: str, value: str, none: str | None, kind: str) -> str:
    """Top class per month by a window, then one column per month."""
    columns = []
    for k, end in enumerate(slots(AS_OF)):
        top = f"max(case when m = {day(end)} then c end)"
        top = f"coalesce({top}, {none})" if none is not None else top
        columns.append(f"cast({top} as {kind}) as {slot_name('pay_class', k)}")
    return f"""
    select {keys}, {', '.join(columns)} from (
      select {keys}, m, c, row_number() over (partition by {keys}, m order by s desc, c) as rn from (
        select {keys}, last_day(cast({col} as date)) as m, {class_col} as c, sum({value}) as s
        from {table} where {in_months(col)} group by all)) where rn = 1 group by {keys}
    """


# ---------------------------------------------------------------- month slots


@query(
    "pay_month_slots",
    f"select o_custkey, {slot_sum('o_orderdate', AMOUNT, 'pay')} from orders where {in_months('o_orderdate')} group by o_custkey",
)
def pay_month_slots(t: Tables):
    paid = t.orders.withColumn("amount", F.col("o_totalprice").cast("decimal(18,2)"))
    return month_slots(paid, ["o_custkey"], "o_orderdate", "amount", "pay", AS_OF)


@query(
    "pay_dominant_class",
    dominant("orders", "o_custkey", "o_orderdate", "o_orderpriority", AMOUNT, None, "varchar"),
)
def pay_dominant_class(t: Tables):
    paid = t.orders.withColumn("amount", F.col("o_totalprice").cast("decimal(18,2)"))
    return dominant_by_month(
        paid, ["o_custkey"], "o_orderdate", "o_orderpriority", "amount", "pay_class", AS_OF
    )


_PAY_NAMES = ", ".join([slot_name("pay", k) for k in SLOTS] + [slot_name("pay_class", k) for k in SLOTS])


@query(
    "pay_block",
    f"""
    with sums as (select o_custkey, {slot_sum('o_orderdate', AMOUNT, 'pay')} from orders
      where {in_months('o_orderdate')} group by o_custkey),
    tops as ({dominant('orders', 'o_custkey', 'o_orderdate', 'o_orderpriority', AMOUNT, None, 'varchar')})
    select o_custkey, {_PAY_NAMES}, cast(1 as bigint) as is_pay from sums left join tops using (o_custkey)
    """,
)
def pay_block(t: Tables):
    paid = t.orders.withColumn("amount", F.col("o_totalprice").cast("decimal(18,2)"))
    return payment_block(
        paid, ["o_custkey"], AS_OF, date_col="o_orderdate", class_col="o_orderpriority", none_value=None
    )


def gb_cents(units: str, code: str) -> str:
    """Hundredths of a gigabyte in whole numbers; the divisors are powers of two."""
    cents = f"cast(round({units} * 100) as hugeint)"
    cases = " ".join(
        f"when {c} then ({cents} + {1 << (bits - 1)}) >> {bits}" for c, bits in {2: 33, 3: 30, 4: 20, 5: 10}.items()
    )
    return f"(case {code} {cases} else 0 end)"


def gb_slots(table: str, keys: str, col: str, units: str, code: str, exact: bool) -> str:
    columns = []
    for k, end in enumerate(slots(AS_OF)):
        test = f"cast({col} as date) = {day(end)}" if exact else in_month(col, k)
        columns.append(
            f"cast(sum(case when {test} then {gb_cents(units, code)} else 0 end) as double) / 100 as shpd_gb_{k}"
        )
    return f"select {keys}, {', '.join(columns)}, cast(1 as bigint) as is_traffic from {table} where {in_months(col)} group by {keys}"


@query(
    "traffic_unit_slots",
    gb_slots(
        "(select o_custkey, l_shipdate, l_extendedprice * 1000 as units, l_linenumber from lineitem join orders on l_orderkey = o_orderkey)",
        "o_custkey",
        "l_shipdate",
        "units",
        "l_linenumber",
        exact=True,
    ),
)
def traffic_unit_slots(t: Tables):
    """Only line items shipped on the last day of a month count."""
    units = t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"),
        "l_shipdate",
        "l_linenumber",
        (F.col("l_extendedprice") * 1000).cast("decimal(18,2)").alias("units"),
    )
    rows = units.join(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey")
    gb = to_gb("units", "l_linenumber")
    return month_slots(
        rows, ["o_custkey"], "l_shipdate", gb, "shpd_gb", AS_OF, align="exact", style="plain", present="is_traffic"
    )


# ---------------------------------------------------------------- categories

_FLAGS = {"l_returnflag": ["A", "N", "R"], "l_linestatus": ["F", "O"]}


def matrix_sql(values: dict, agg: str, where: str = "true") -> str:
    names = list(values)
    out = []
    for combo in product(*values.values()):
        test = " and ".join(f"{n} = {v!r}" for n, v in zip(names, combo))
        label = "_".join(f"{n}_{v}" for n, v in zip(names, combo))
        out.append(f'cast({agg}(case when {where} and {test} then 1 else 0 end) as bigint) as "{label}"')
    return ", ".join(out)


@query(
    "equipment_matrix",
    f"select l_suppkey, {matrix_sql(_FLAGS, 'max')} from lineitem group by l_suppkey",
)
def equipment_matrix(t: Tables):
    return categorical.presence_matrix(t.lineitem, ["l_suppkey"], _FLAGS)


@query(
    "equipment_one_hot",
    f"select l_partkey, {matrix_sql(_FLAGS, 'sum')} from lineitem group by l_partkey",
)
def equipment_one_hot(t: Tables):
    rows = t.lineitem.select("l_partkey", *categorical.one_hot(_FLAGS))
    return rollup_entity(rows, ["l_partkey"], {c: "sum" for c in categorical.one_hot_names(_FLAGS)})


@query(
    "ever_flags",
    """
    select s_suppkey, max(case when l_suppkey is not null then cast(1 as bigint) end) as had_old_eq,
      max(case when l_returnflag = 'R' and l_discount > 0.09 then cast(1 as bigint) end) as had_block_eq
    from supplier left join lineitem on s_suppkey = l_suppkey group by s_suppkey
    """,
)
def ever_flags(t: Tables):
    lines = t.lineitem.withColumnRenamed("l_suppkey", "s_suppkey")
    blocked = (F.col("l_returnflag") == "R") & (F.col("l_discount") > 0.09)
    both = [
        categorical.ever_flag(lines, ["s_suppkey"], "had_old_eq"),
        categorical.ever_flag(lines, ["s_suppkey"], "had_block_eq", blocked),
    ]
    return attach_flags(t.supplier.select("s_suppkey"), both, ["s_suppkey"])


# ---------------------------------------------------------------- snapshots


@query(
    "snapshot_open_orders",
    """
    with shipped as (select l_orderkey, max(cast(l_shipdate as date)) as last_ship from lineitem group by l_orderkey),
    spans as (select o_orderkey, o_custkey, cast(o_orderdate as date) as dt_from,
      case when o_orderstatus = 'O' then null else last_ship end as dt_to
      from orders left join shipped on o_orderkey = l_orderkey)
    select o_orderkey, o_custkey, cast(dt_from as varchar) as dt_from, cast(dt_to as varchar) as dt_to from spans
    where dt_from <= date '1999-06-15' and coalesce(dt_to, date '9999-12-31') > date '1999-06-15'
    """,
)
def snapshot_open_orders(t: Tables):
    shipped = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max(F.col("l_shipdate").cast("date")).alias("last_ship")
    )
    spans = enrich(t.orders, shipped, ["o_orderkey"]).select(
        "o_orderkey",
        "o_custkey",
        F.col("o_orderdate").cast("date").alias("dt_from"),
        F.when(F.col("o_orderstatus") != "O", F.col("last_ship")).alias("dt_to"),
    )
    return snapshot(spans, AS_OF.replace(year=1999, month=6, day=15))


@query(
    "latest_order",
    """
    select o_custkey, o_orderkey, o_orderstatus, cast(cast(o_orderdate as date) as varchar) as o_orderdate from (
      select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn from orders)
    where rn = 1
    """,
)
def latest_order(t: Tables):
    return latest_by(
        t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate"),
        ["o_custkey"],
        "o_orderdate",
        ["o_orderkey"],
    )


@query(
    "any_per_key",
    """
    select l_orderkey, l_partkey, l_suppkey, cast(l_linenumber as bigint) as l_linenumber from (
      select *, row_number() over (partition by l_orderkey order by l_partkey, l_suppkey, l_linenumber) as rn from lineitem)
    where rn = 1
    """,
)
def any_row_per_order(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return any_per_key(rows, ["l_orderkey"])


_IDENTITY = """
select mobile_id, mobile_acc_id, personal_account_number, mobile_id as billing_id, mobile_acc_id as acc_id,
  personal_account_number as acc_num, mobile_msisdn, mobile_tariff_plan, 1 as is_mobile from {src}
union select mobile_id, mobile_acc_id, personal_account_number, fix_billing_id, fix_acc_id, fix_acc_num,
  mobile_msisdn, mobile_tariff_plan, 0 from {src}
"""
_CURRENT = f"""
select * from (select mobile_id, mobile_acc_id, personal_account_number, mobile_msisdn, mobile_tariff_plan,
  fix_billing_id, fix_acc_id, fix_acc_num, dt_from, dt_to from convergent_a
  union all select mobile_id, mobile_acc_id, personal_account_number, mobile_msisdn, mobile_tariff_plan,
  fix_billing_id, fix_acc_id, fix_acc_num, dt_from, dt_to from convergent_b) where {OPEN}
"""
_ID_INTS = [
    "mobile_id", "mobile_acc_id", "personal_account_number", "billing_id", "acc_id", "acc_num",
    "mobile_msisdn", "mobile_tariff_plan", "is_mobile",
]


@query(
    "dual_identity",
    "select l_orderkey as line, l_orderkey as id, l_suppkey as num, cast(1 as bigint) as is_order from lineitem"
    " union select l_orderkey, l_partkey, cast(l_linenumber as bigint), 0 from lineitem",
)
def dual_identity_rows(t: Tables):
    rows = t.lineitem.withColumn("line", F.col("l_orderkey"))
    roles = {1: {"id": "l_orderkey", "num": "l_suppkey"}, 0: {"id": "l_partkey", "num": "l_linenumber"}}
    return dual_identity(rows, ["line"], roles, "is_order")


@query(
    "fixed_identities",
    f"with cur as ({_CURRENT}), ids as ({_IDENTITY.format(src='cur')}) select {casts('bigint', _ID_INTS)} from ids",
    ("convergent_a", "convergent_b"),
)
def fixed_identities(t: Tables):
    return fixed.line_identities(snapshot(stack(t.convergent_a, t.convergent_b), AS_OF))


_LATEST_CONTRACT = """
select billing_id, acc_id, dt_from, contract_num, contract_id, customer_id, is_noncommercial, is_closed,
  is_archive, orders_credit, credit
from (select *, row_number() over (partition by billing_id, acc_id order by dt_from desc, contract_id desc) as rn
  from contracts) where rn = 1
"""
_CONTRACT_INTS = [
    "contract_num", "contract_id", "customer_id", "is_noncommercial", "is_closed", "is_archive",
    "orders_credit", "credit",
]
_BASE_CTES = {
    "cur": _CURRENT,
    "ids": _IDENTITY.format(src="cur"),
    "con": _LATEST_CONTRACT,
    "base": "select ids.*, con.* exclude (billing_id, acc_id) from ids left join con using (billing_id, acc_id)",
}


@query(
    "fixed_identity_base",
    with_ctes(
        _BASE_CTES,
        f"select {casts('bigint', _ID_INTS + _CONTRACT_INTS)}, cast(dt_from as varchar) as dt_from from base",
    ),
    ("convergent_a", "convergent_b", "contracts"),
)
def fixed_identity_base(t: Tables):
    return fixed.identity_base(t.convergent_a, t.convergent_b, t.contracts, AS_OF)


YEAR_ENDS = [month_end(AS_OF, k) for k in range(12)]
_DAYS_SQL = f"(select unnest([{', '.join(map(day, YEAR_ENDS))}]) as snapshot_day)"
_VALID = "dt_from <= {d} and coalesce(cast(dt_to as date), date '9999-12-31') > {d}"


@query(
    "identity_months",
    with_ctes(
        {
            "cur": f"select * from ({_CURRENT.split(' where ')[0]}), {_DAYS_SQL} where {_VALID.format(d='snapshot_day')}",
            "ids": f"""
            select mobile_id, mobile_acc_id, personal_account_number, mobile_id as billing_id, mobile_acc_id as acc_id,
              personal_account_number as acc_num, mobile_msisdn, mobile_tariff_plan, 1 as is_mobile, snapshot_day from cur
            union select mobile_id, mobile_acc_id, personal_account_number, fix_billing_id, fix_acc_id, fix_acc_num,
              mobile_msisdn, mobile_tariff_plan, 0, snapshot_day from cur""",
            "con": _LATEST_CONTRACT,
        },
        f"""
        select {casts('bigint', _ID_INTS + _CONTRACT_INTS)}, cast(dt_from as varchar) as dt_from, cast(snapshot_day as varchar) as snapshot_day
        from (select ids.*, con.* exclude (billing_id, acc_id) from ids left join con using (billing_id, acc_id))
        """,
    ),
    ("convergent_a", "convergent_b", "contracts"),
)
def identity_months(t: Tables):
    """Twelve month ends from one read of the identities."""
    return fixed.identity_months(t.convergent_a, t.convergent_b, t.contracts, YEAR_ENDS)


def _validity_sql(join: str) -> str:
    return f"""
    with days as (select billing_id, acc_id, last_day(dt) as day, count(*) as n_payments from payments group by all)
    select cast(d.billing_id as bigint) as billing_id, d.acc_id, cast(d.day as varchar) as day, n_payments,
      count(e.dt_from) as n_valid, cast(max(e.equipment_type) as bigint) as top_type
    from days d {join} equipment e on d.billing_id = e.billing_id and d.acc_id = e.acc_id and {_VALID.format(d='d.day')} group by all
    """


def _validity_join(t: Tables, how: str):
    days = t.payments.groupBy("billing_id", "acc_id", F.last_day("dt").alias("day")).agg(F.count("*").alias("n_payments"))
    spans = t.equipment.select(*ACCOUNT, "dt_from", F.col("dt_to").cast("date").alias("dt_to"), "equipment_type")
    rows = interval_join(days, spans, ACCOUNT, "day", how=how)
    return rows.groupBy("billing_id", "acc_id", "day", "n_payments").agg(F.count("dt_from").alias("n_valid"), F.max("equipment_type").alias("top_type"))


@query("validity_join", _validity_sql("join"), ("payments", "equipment"))
def validity_join(t: Tables):
    """Equipment valid at the end of each month in which the account paid."""
    return _validity_join(t, "inner")


@query("validity_join_left", _validity_sql("left join"), ("payments", "equipment"))
def validity_join_left(t: Tables):
    return _validity_join(t, "left")


@query(
    "contract_enrich",
    """
    with latest as (select o_custkey, o_orderkey, o_orderstatus from (select *, row_number() over (
        partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn from orders) where rn = 1)
    select c_custkey, cast(c_nationkey as bigint) as c_nationkey, o_orderkey, o_orderstatus
    from customer left join latest on c_custkey = o_custkey
    """,
)
def contract_enrich(t: Tables):
    latest = latest_by(t.orders, ["o_custkey"], "o_orderdate", ["o_orderkey"]).select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus"
    )
    return enrich(t.customer.select("c_custkey", "c_nationkey"), latest, ["c_custkey"])


@query(
    "role_mask",
    f"""
    select o_orderkey, case when o_orderstatus = 'F' then o_custkey end as o_custkey,
      case when o_orderstatus = 'F' then o_orderpriority end as o_orderpriority,
      cast({D} - cast(o_orderdate as date) as bigint) as total_live_dur from orders
    """,
)
def role_mask(t: Tables):
    masked = mask_by_role(t.orders, F.col("o_orderstatus") == "F", ["o_custkey", "o_orderpriority"])
    aged = masked.withColumn("total_live_dur", days_since("o_orderdate", AS_OF))
    return aged.select("o_orderkey", "o_custkey", "o_orderpriority", "total_live_dur")


@query(
    "days_since",
    f"""
    select o_custkey, cast({D} - max(cast(o_orderdate as date)) as bigint) as last_order_days,
      cast({D} - min(cast(o_orderdate as date)) as bigint) as first_order_days from orders group by o_custkey
    """,
)
def days_since_events(t: Tables):
    ends = t.orders.groupBy("o_custkey").agg(
        F.max("o_orderdate").alias("last"), F.min("o_orderdate").alias("first")
    )
    aged = with_days_since(ends, {"last_order_days": "last", "first_order_days": "first"}, AS_OF)
    return aged.drop("last", "first")


# ---------------------------------------------------------------- lifetimes

_OPENED = [f"dt_open_{s}" for s in SERVICES]
_REPAIRED = f"""
select * from (select * replace (case when dt_open < date '2000-01-01' or dt_open is null
  then least({', '.join(_OPENED)}) else dt_open end as dt_open) from lifetimes) where dt_open is not null
"""


@query(
    "open_date_repair",
    f"""
    with rep as ({_REPAIRED}) select cast(billing_id as bigint) as billing_id, acc_id,
      cast(dt_open as varchar) as dt_open, cast(case when cast(dt_close as date) <= {D} then 1 else 0 end as bigint) as closed
    from rep
    """,
    ("lifetimes",),
)
def open_date_repair(t: Tables):
    repaired = repair_open_date(t.lifetimes, "dt_open", _OPENED)
    flagged = with_closed_flag(repaired, "closed", "dt_close", AS_OF)
    return flagged.select(*ACCOUNT, "dt_open", "closed")


def tenure_sql(open_: str, close: str) -> str:
    return (
        f"cast(case when cast({close} as date) <= {D} then cast({close} as date) - cast({open_} as date)"
        f" else {D} - cast({open_} as date) end as bigint)"
    )


def open_sql(open_: str, close: str) -> str:
    return (
        f"cast(case when (cast({close} as date) > {D} or {close} is null) and cast({open_} as date) <= {D}"
        " then 1 else 0 end as bigint)"
    )


_SPAN = {s: (f"dt_open_{s}", f"dt_close_{s}") for s in SERVICES}


@query(
    "tenure_days",
    "select cast(billing_id as bigint) as billing_id, acc_id, "
    + ", ".join(f"{tenure_sql(*pair)} as live_{s}" for s, pair in _SPAN.items())
    + " from lifetimes",
    ("lifetimes",),
)
def tenures(t: Tables):
    out = with_tenure(t.lifetimes, {f"live_{s}": pair for s, pair in _SPAN.items()}, AS_OF)
    return out.select(*ACCOUNT, *[f"live_{s}" for s in SERVICES])


@query(
    "open_flags",
    "select cast(billing_id as bigint) as billing_id, acc_id, "
    + ", ".join(f"{open_sql(*pair)} as has_{s}" for s, pair in _SPAN.items())
    + " from lifetimes",
    ("lifetimes",),
)
def open_flags(t: Tables):
    out = with_open_flags(t.lifetimes, {f"has_{s}": pair for s, pair in _SPAN.items()}, AS_OF)
    return out.select(*ACCOUNT, *[f"has_{s}" for s in SERVICES])


_DURATIONS = {f"live_dur_fix_{fixed.DURATION_NAMES[s]}": pair for s, pair in _SPAN.items()}
_LIFETIME = f"""
select billing_id, acc_id, dt_open, {', '.join(_OPENED)},
  cast(case when cast(dt_close as date) <= {D} then 1 else 0 end as bigint) as is_contract_closed_flg,
  {tenure_sql('dt_open', 'dt_close')} as live_dur_contract,
  {', '.join(f'{tenure_sql(*pair)} as {name}' for name, pair in _DURATIONS.items())},
  {', '.join(f'{open_sql(*pair)} as has_opened_{s}' for s, pair in _SPAN.items())},
  cast(1 as bigint) as is_acc_att
from ({_REPAIRED})
"""


@query(
    "fixed_lifetimes",
    f"select * replace (cast(billing_id as bigint) as billing_id, {casts('varchar', ['dt_open', *_OPENED])}) from ({_LIFETIME})",
    ("lifetimes",),
)
def fixed_lifetimes(t: Tables):
    return fixed.lifetime_block(t.lifetimes, AS_OF)


# ---------------------------------------------------------------- account blocks

_PAY = f"""
select sums.*, tops.* exclude (billing_id, acc_id), cast(1 as bigint) as is_pay from (
  select billing_id, acc_id, {slot_sum('dt', 'amount', 'pay')} from payments where {in_months('dt')}
  group by billing_id, acc_id) sums
left join ({dominant('payments', 'billing_id, acc_id', 'dt', 'pay_class', 'amount', '0', 'bigint')}) tops
  using (billing_id, acc_id)
"""
_LONG_ACCOUNT = "* replace (cast(billing_id as bigint) as billing_id)"


WINDOW_DAYS = [month_end(AS_OF, k) for k in range(6)]


@query(
    "payment_windows",
    " union all ".join(
        f"select {_LONG_ACCOUNT}, '{end}' as as_of from (select * exclude (is_pay) from ({moved(_PAY, k)}))" for k, end in enumerate(WINDOW_DAYS)
    ),
    ("payments",),
)
def payment_windows(t: Tables):
    """Six windows from one state, to which late payments were added."""
    late = (F.col("acc_id") % 4 == 1) & (F.col("dt") >= F.lit(month_end(AS_OF, 3)))
    kinds = [F.col(k) for k in ACCOUNT]
    state, more = (month_state(t.payments.where(rows), ACCOUNT, "dt", "amount", "pay_class") for rows in (~late, late))
    merged = merge_states(ACCOUNT, state.select(*kinds, *STATE), more.select(*kinds, *STATE))
    return windows(merged, ACCOUNT, WINDOW_DAYS, "pay", class_prefix="pay_class", none_class=0)


@query("fixed_payments", f"select {_LONG_ACCOUNT} from ({_PAY})", ("payments",))
def fixed_payments(t: Tables):
    return fixed.payments_block(t.payments, AS_OF)


_TRAFFIC = gb_slots("traffic", "billing_id, acc_id", "dt", "number_of_units", "metric_unit_number", exact=False)


@query("fixed_traffic", f"select {_LONG_ACCOUNT} from ({_TRAFFIC})", ("traffic",))
def fixed_traffic(t: Tables):
    return fixed.traffic_block(t.traffic, AS_OF)


_EQUIP = f"""
select billing_id, acc_id, {matrix_sql(EQUIPMENT_VALUES, 'max', OPEN)}, cast(1 as bigint) as is_equip,
  cast(1 as bigint) as had_old_eq, max(case when is_blocked = 1 then cast(1 as bigint) end) as had_block_eq
from equipment group by billing_id, acc_id having max(case when {OPEN} then 1 else 0 end) = 1
"""


@query("fixed_equipment", f"select {_LONG_ACCOUNT} from ({_EQUIP})", ("equipment",))
def fixed_equipment(t: Tables):
    return fixed.equipment_block(t.equipment, AS_OF)


# ---------------------------------------------------------------- requests

_TICKET_COLS = tickets.TicketColumns()
_SCOPE = f"""
select distinct request_id, status, priority, contract_num, closetime_dt_orig, createdate_dt_orig from complaints
where raw_dt > {day(slots(AS_OF, 6)[5])} and dogtype = 'Фиксированный' and {in_months('createdate_dt_orig')}
  and request_id is not null
"""
_GUARDED = """
select scope.* from scope join (select request_id from scope group by request_id
  having count(distinct contract_num) = 1) using (request_id)
"""
_HOURS = """case when status in ('Закрыт', 'Решен')
  then cast(closetime_dt_orig - createdate_dt_orig as double) * 24 else 0 end"""


def _flag_sql() -> dict[str, str]:
    tests = {n: f"status = '{v}'" for n, v in _TICKET_COLS.status_flags.items()}
    tests |= {n: f"priority = '{v}'" for n, v in _TICKET_COLS.priority_flags.items()}
    tests |= {slot_name("cnt_zhalobi", k): in_month("createdate_dt_orig", k) for k in SLOTS}
    return {n: f"case when {test} then 1 else 0 end" for n, test in tests.items()}


def _per_request(keys: str, source: str) -> str:
    columns = ", ".join(f"cast(max({sql}) as bigint) as {n}" for n, sql in _flag_sql().items())
    return f"select {keys}, request_id, {columns}, max({_HOURS}) as zhalobi_lifetime_hours from {source} group by {keys}, request_id"


def _per_account(keys: str, source: str) -> str:
    columns = ", ".join(f"cast(sum({n}) as bigint) as {n}" for n in _flag_sql())
    return f"""
    select {keys}, count(distinct request_id) as cnt_zhalobi, min(zhalobi_lifetime_hours) as min_zhalobi_lifetime_hours,
      max(zhalobi_lifetime_hours) as max_zhalobi_lifetime_hours, {columns} from {source} group by {keys}
    """


@query(
    "complaint_scope",
    f"with scope as ({_SCOPE}) select * replace ({casts('varchar', ['closetime_dt_orig', 'createdate_dt_orig'])}) from scope",
    ("complaints",),
)
def complaint_scope(t: Tables):
    return tickets.scoped(t.complaints, AS_OF)


@query(
    "complaint_guard",
    f"""
    with scope as ({_SCOPE}), guarded as ({_GUARDED})
    select * replace ({casts('varchar', ['closetime_dt_orig', 'createdate_dt_orig'])}) from guarded
    """,
    ("complaints",),
)
def complaint_guard(t: Tables):
    return tickets.keep_unambiguous(tickets.scoped(t.complaints, AS_OF), "request_id", "contract_num")


@query(
    "complaint_flags",
    """
    select l_orderkey, l_partkey, l_suppkey, cast(l_linenumber as bigint) as l_linenumber,
      cast(case when l_returnflag = 'A' then 1 else 0 end as bigint) as is_a,
      cast(case when l_returnflag = 'R' then 1 else 0 end as bigint) as is_r from lineitem
    """,
)
def complaint_flags(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    return categorical.flags(rows, "l_returnflag", {"is_a": "A", "is_r": "R"}).drop("l_returnflag")


@query(
    "complaint_per_request",
    f"with scope as ({_SCOPE}), guarded as ({_GUARDED}) {_per_request('contract_num', 'guarded')}",
    ("complaints",),
)
def complaint_per_request(t: Tables):
    kept = tickets.keep_unambiguous(tickets.scoped(t.complaints, AS_OF), "request_id", "contract_num")
    return tickets.per_request(tickets.with_ticket_flags(kept, AS_OF), ["contract_num"])


@query(
    "complaint_rollup",
    f"""
    with scope as ({_SCOPE}), guarded as ({_GUARDED}), req as ({_per_request('contract_num', 'guarded')})
    {_per_account('contract_num', 'req')}
    """,
    ("complaints",),
)
def complaint_rollup(t: Tables):
    return tickets.contract_statistics(t.complaints, AS_OF)


_REQUEST_CTES = {
    "scope": _SCOPE,
    "guarded": _GUARDED,
    "owned": "select * from (select distinct billing_id, acc_id, acc_num, contract_num from base) join guarded using (contract_num)",
    "req": _per_request("billing_id, acc_id, acc_num, contract_num", "owned"),
    "request_stats": _per_account("billing_id, acc_id, acc_num, contract_num", "req"),
}


@query(
    "fixed_complaints",
    with_ctes(
        {**_BASE_CTES, **_REQUEST_CTES},
        "select * replace (cast(billing_id as bigint) as billing_id), cast(1 as bigint) as is_zhalobi from request_stats",
    ),
    ("convergent_a", "convergent_b", "contracts", "complaints"),
)
def fixed_complaints(t: Tables):
    base = fixed.identity_base(t.convergent_a, t.convergent_b, t.contracts, AS_OF)
    return fixed.complaint_block(t.complaints, base, AS_OF)


@query(
    "complaint_attach",
    f"""
    with scope as ({_SCOPE}) select o_orderkey, o_custkey, request_id, status
    from orders join scope on o_orderkey = contract_num
    """,
    ("complaints",),
)
def complaint_attach(t: Tables):
    requests = tickets.scoped(t.complaints, AS_OF).withColumnRenamed("contract_num", "o_orderkey")
    return attach_by(t.orders, requests, "o_orderkey").select("o_orderkey", "o_custkey", "request_id", "status")


# ---------------------------------------------------------------- services

_ACTIVE = f"select * from services where {OPEN} and is_closed = 0"
_CLOSED_CNT = """
select billing_id, acc_id, sum(is_closed) as closed_cnt from (
  select distinct billing_id, acc_id, app_service_id, is_closed from services) group by billing_id, acc_id
"""
_BASIC_CNT = """
select billing_id, acc_id, sum(is_b2c_basic_service) as basic_serv_cnt,
  count(is_b2c_basic_service) - sum(is_b2c_basic_service) as not_basic_serv_cnt
from (select distinct billing_id, acc_id, app_service_id, is_b2c_basic_service from act) group by billing_id, acc_id
"""
_ACTIVE_CNT = "select billing_id, acc_id, count(distinct app_service_id) as active_serv_cnt from act group by billing_id, acc_id"
_DISC = f"""
select billing_id, acc_id, sum(discount_price) as all_disc_sum
from (select distinct billing_id, acc_id, app_service_id from act)
left join (select distinct * from discounts where {OPEN}) using (billing_id, acc_id, app_service_id)
group by billing_id, acc_id
"""
_COUNTS = ["active_serv_cnt", "closed_cnt", "basic_serv_cnt", "not_basic_serv_cnt"]


@query(
    "service_counts",
    f"""
    with act as ({_ACTIVE}) select {casts('bigint', ['billing_id', 'acc_id', *_COUNTS])} from ({_ACTIVE_CNT})
    left join ({_CLOSED_CNT}) using (billing_id, acc_id) left join ({_BASIC_CNT}) using (billing_id, acc_id)
    """,
    ("services",),
)
def service_counts(t: Tables):
    active = services.active(t.services, AS_OF)
    return merge_counters(
        [
            services.active_services(active, ACCOUNT),
            services.closed_services(t.services, ACCOUNT),
            services.basic_services(active, ACCOUNT),
        ],
        ACCOUNT,
    )


@query(
    "discount_totals",
    f"with act as ({_ACTIVE}), d as ({_DISC}) select {casts('bigint', ['billing_id', 'acc_id', 'all_disc_sum'])} from d",
    ("services", "discounts"),
)
def discount_totals(t: Tables):
    return services.discount_totals(t.services, t.discounts, ACCOUNT, AS_OF)


_SERVICE_CTES = {
    "act": _ACTIVE,
    "serv": f"""
    select * from ({_ACTIVE_CNT}) left join ({_CLOSED_CNT}) using (billing_id, acc_id)
    left join ({_BASIC_CNT}) using (billing_id, acc_id) left join ({_DISC}) using (billing_id, acc_id)
    """,
}


@query(
    "fixed_services",
    with_ctes(
        _SERVICE_CTES, f"select {casts('bigint', ['billing_id', 'acc_id', *_COUNTS, 'all_disc_sum'])} from serv"
    ),
    ("services", "discounts"),
)
def fixed_services(t: Tables):
    return fixed.service_block(t.services, t.discounts, AS_OF)


_PROFILE_VALUES = [
    "bb_rent_amount", "tv_rent_amount", "tlf_rent_amount", "tv_line_coast", "tv_mult_coast", "gender",
    "customer_age", "sale_channel", "lk_use_count", "lk_use_count_3m", "all_sr_count_30d",
    "complaint_sr_count_30d", "cm_sr_count_30d", "cm_sr_count_180d",
]
_PROFILE = f"""
select billing_id, customer_id, {', '.join(_PROFILE_VALUES)} from (select *, row_number() over (
  partition by billing_id, customer_id order by version_dt desc, {', '.join(f'{c} desc' for c in _PROFILE_VALUES)}) as rn
  from profiles) where rn = 1
"""


@query(
    "fixed_profiles",
    f"select {casts('bigint', ['billing_id', 'customer_id', *_PROFILE_VALUES])} from ({_PROFILE})",
    ("profiles",),
)
def fixed_profiles(t: Tables):
    return fixed.profile_block(t.profiles)


# ---------------------------------------------------------------- the mart

MART_KEYS = ["mobile_id", "mobile_acc_id", "personal_account_number", "mobile_msisdn", "mobile_tariff_plan"]
_DOUBLES = {
    *[slot_name("pay", k) for k in SLOTS],
    *[slot_name("shpd_gb", k, "plain") for k in SLOTS],
    "min_zhalobi_lifetime_hours",
    "max_zhalobi_lifetime_hours",
}
_SQL_RULE = {"first": "min", "max": "max", "sum": "sum"}
_ONE_ROW = {"row:account": ["billing_id", "acc_id", "acc_num"], "row:person": ["gender", "sale_channel"]}


def one_row(source: str, keys: list[str], columns: list[str]) -> str:
    """The first row per key that has any of the columns."""
    return (
        f"select {', '.join(keys + columns)} from (select *, row_number() over (partition by {', '.join(keys)} order by "
        f"{', '.join(f'{c} nulls first' for c in columns)}) as rn from {source} where {' or '.join(f'{c} is not null' for c in columns)}) where rn = 1"
    )


def same_keys(left: str, right: str, keys: list[str]) -> str:
    return " and ".join(f"{left}.{k} is not distinct from {right}.{k}" for k in keys)


def _mart_column(name: str, rule: str) -> str:
    if rule in _ONE_ROW:
        return f'cast(any_value(first_{rule[4:]}."{name}") as bigint) as "{name}"'
    name = f'masked"."{name}'
    return _mart_aggregate(name, rule).replace('as "masked".', "as ")


def _mart_aggregate(name: str, rule: str) -> str:
    bare = name.rpartition('"')[2]
    kind = "double" if bare in _DOUBLES else "bigint"
    # money and volumes are summed in hundredths, as whole numbers
    if bare in _DOUBLES and rule == "sum":
        return f'cast(sum(cast(round("{name}" * 100) as hugeint)) as double) / 100 as "{name}"'
    return f'cast({_SQL_RULE[rule]}("{name}") as {kind}) as "{name}"'


MART_CTES = {
    **_BASE_CTES,
    **_REQUEST_CTES,
    **_SERVICE_CTES,
    "masked": f"""
    select base.* replace (case when is_mobile = 0 then billing_id end as billing_id,
        case when is_mobile = 0 then acc_id end as acc_id, case when is_mobile = 0 then acc_num end as acc_num),
      case when is_mobile = 1 then contract_num end as mobile_contract_num, {D} - dt_from as total_live_dur,
      att.* exclude (billing_id, acc_id), pay.* exclude (billing_id, acc_id), tra.* exclude (billing_id, acc_id),
      equ.* exclude (billing_id, acc_id), rem.* exclude (billing_id, acc_id, acc_num, contract_num),
      serv.* exclude (billing_id, acc_id), prof.* exclude (billing_id, customer_id)
    from base left join ({_LIFETIME}) att using (billing_id, acc_id) left join ({_PAY}) pay using (billing_id, acc_id)
    left join ({_TRAFFIC}) tra using (billing_id, acc_id) left join ({_EQUIP}) equ using (billing_id, acc_id)
    left join request_stats rem using (billing_id, acc_id, acc_num, contract_num)
    left join serv using (billing_id, acc_id) left join ({_PROFILE}) prof using (billing_id, customer_id)
    """,
    **{f"first_{rule[4:]}": one_row("masked", MART_KEYS, columns) for rule, columns in _ONE_ROW.items()},
    "fixed_mart": "select "
    + ", ".join(f"cast(masked.{k} as bigint) as {k}" for k in MART_KEYS)
    + ", "
    + ", ".join(_mart_column(c, rule) for c, rule in fixed.entity_spec().items())
    + " from masked "
    + " ".join(f"left join first_{r[4:]} on {same_keys('masked', f'first_{r[4:]}', MART_KEYS)}" for r in _ONE_ROW)
    + f" group by {', '.join(f'masked.{k}' for k in MART_KEYS)}",
}


def fixed_mart_frame(t: Tables, as_of=AS_OF):
    return fixed.fixed_mart({name: getattr(t, name) for name in FIXED_SOURCES}, as_of)


@query("fixed_mart", with_ctes(MART_CTES, f"select *, '{month_start(AS_OF)}' as table_business_month from fixed_mart"), FIXED_SOURCES)
def fixed_mart(t: Tables):
    return fixed_mart_frame(t)


@query(
    "entity_rollup",
    """
    with f as (select *, row_number() over (partition by o_custkey order by o_orderpriority, o_orderkey) as rn
      from orders where o_orderstatus = 'F')
    select a.*, f.o_orderpriority as first_priority, f.o_orderkey as first_order from
      (select o_custkey, max(o_orderkey) as o_orderkey, cast(sum(cast(o_totalprice as decimal(18, 2))) as double) as amount
       from orders group by o_custkey) a left join f on a.o_custkey = f.o_custkey and f.rn = 1
    """,
)
def entity_rollup(t: Tables):
    rows = t.orders.withColumns(
        {
            "first_priority": F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")),
            "first_order": F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")),
            "amount": F.col("o_totalprice").cast("decimal(18,2)"),
        }
    )
    spec = {"first_priority": "row:order", "first_order": "row:order", "o_orderkey": "max", "amount": "sum"}
    return rollup_entity(rows, ["o_custkey"], spec)


