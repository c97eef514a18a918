"""Source tables of the marts, derived from the test tables.

The texts run unchanged in Spark and in DuckDB; ``{name}`` stands for a table.
Accounts and lines are customers, orders or parts, whose ids overlap, so that
joins find partners and also leave rows without one.
"""

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

_CONVERGENT_A = """
select cast(o_custkey % 25 as int) as fix_billing_id, o_custkey as fix_acc_id,
  o_custkey + 1000000 as fix_acc_num, cast(o_orderkey % 25 as int) as mobile_id,
  o_orderkey as mobile_acc_id, o_orderkey + 500 as personal_account_number,
  o_orderkey as mobile_msisdn, cast(o_orderdate as date) as dt_from,
  case o_orderstatus when 'O' then '9999-12-31' when 'P' then null
    else cast(cast(o_orderdate as date) + 900 as string) end as dt_to,
  cast(substr(o_orderpriority, 1, 1) as int) as mobile_tariff_plan
from {orders}
"""

_CONVERGENT_B = """
select cast(c_custkey % 25 as int) as fix_billing_id, c_custkey as fix_acc_id,
  c_custkey + 1000000 as fix_acc_num, cast(c_custkey % 25 as int) as mobile_id,
  c_custkey + 100000000 as mobile_acc_id, c_custkey + 100000500 as personal_account_number,
  c_custkey + 100000000 as mobile_msisdn, date '1999-01-01' + c_nationkey as dt_from,
  '9999-12-31' as dt_to, c_nationkey as mobile_tariff_plan
from {customer}
"""

_CONTRACTS = """
select cast(o_custkey % 25 as int) as billing_id, o_custkey as acc_id, o_custkey + 1000000 as acc_num,
  cast(o_orderdate as date) as dt_from, '9999-12-31' as dt_to, o_orderkey as contract_num,
  o_orderkey + 7 as contract_id, o_custkey + 5000000 as customer_id,
  case o_orderstatus when 'P' then 1 else 0 end as is_noncommercial,
  case o_orderstatus when 'F' then 1 else 0 end as is_closed,
  case when o_orderpriority = '5-LOW' then 1 else 0 end as is_archive,
  cast(o_orderkey % 3 as int) as orders_credit, cast(o_orderkey % 7 as int) as credit
from {orders}
"""

_LIFETIMES = """
select cast(o_custkey % 25 as int) as billing_id, o_custkey as acc_id,
  min(cast(o_orderdate as date)) as dt_open,
  coalesce(cast(max(case when o_orderstatus = 'F' then cast(o_orderdate as date) end) as string), '9999-12-31') as dt_close,
  min(case when o_orderpriority = '1-URGENT' then cast(o_orderdate as date) end) as dt_open_spd,
  min(case when o_orderpriority = '2-HIGH' then cast(o_orderdate as date) end) as dt_open_ctv,
  min(case when o_orderpriority = '3-MEDIUM' then cast(o_orderdate as date) end) as dt_open_atv,
  min(case when o_orderpriority = '4-NOT SPECIFIED' then cast(o_orderdate as date) end) as dt_open_tlf,
  min(case when o_orderpriority = '5-LOW' and o_orderstatus <> 'F' then cast(o_orderdate as date) end) as dt_open_ictv,
  cast(max(case when o_orderpriority = '1-URGENT' and o_orderstatus = 'F' then cast(o_orderdate as date) end) as string) as dt_close_spd,
  cast(max(case when o_orderpriority = '2-HIGH' then cast(o_orderdate as date) end) as string) as dt_close_ctv,
  '9999-12-31' as dt_close_atv,
  cast(max(case when o_orderpriority = '4-NOT SPECIFIED' and o_orderstatus = 'O' then cast(o_orderdate as date) + 300 end) as string) as dt_close_tlf,
  cast(max(case when o_orderpriority = '5-LOW' and o_orderstatus = 'P' then cast(o_orderdate as date) end) as string) as dt_close_ictv
from {orders} group by o_custkey
"""

_PAYMENTS = """
select cast(o_custkey % 25 as int) as billing_id, o_custkey as acc_id,
  cast(o_orderdate as date) as dt, cast(o_totalprice as decimal(10, 2)) as amount,
  cast(substr(o_orderpriority, 1, 1) as int) as pay_class
from {orders}
"""

_TRAFFIC = """
select cast(l_partkey % 25 as int) as billing_id, l_partkey as acc_id,
  last_day(cast(l_shipdate as date)) as dt,
  cast(l_extendedprice * 1000 as decimal(18, 2)) as number_of_units,
  l_linenumber as metric_unit_number
from {lineitem}
"""

_EQUIPMENT = """
select cast(l_partkey % 25 as int) as billing_id, l_partkey as acc_id,
  cast(l_shipdate as date) as dt_from,
  case l_returnflag when 'R' then cast(cast(l_shipdate as date) + 200 as string)
    when 'A' then null else '9999-12-31' end as dt_to,
  cast(l_suppkey % 21 as int) as equipment_type, l_linenumber - 2 as provide_type,
  case when l_discount > 0.09 then 1 else 0 end as is_blocked
from {lineitem}
"""

_COMPLAINTS = """
select l_partkey as request_id, l_orderkey as contract_num,
  cast(l_shipdate as date) as createdate_dt_orig, cast(l_shipdate as date) as raw_dt,
  case when l_linenumber = 3 then null
    else cast(l_shipdate as date) + cast(floor(l_quantity) as int) end as closetime_dt_orig,
  case when l_linenumber = 7 then 'Мобильный' else 'Фиксированный' end as dogtype,
  case when l_returnflag = 'A' and l_linestatus = 'F' then 'Активное ожидание'
    when l_returnflag = 'A' then 'В работе' when l_returnflag = 'N' then 'Решен' else 'Закрыт' end as status,
  case l_linenumber when 1 then 'Низкий' when 2 then 'Ниже среднего' when 3 then 'Средний'
    when 4 then 'Выше среднего' when 5 then 'Высокий' else 'Наивысший' end as priority
from {lineitem}
"""

_SERVICES = """
select cast(l_partkey % 25 as int) as billing_id, l_partkey as acc_id,
  cast(l_suppkey % 20 + 1 as int) as app_service_id,
  case l_linestatus when 'F' then 1 else 0 end as is_closed,
  case l_returnflag when 'N' then 1 else 0 end as is_b2c_basic_service,
  cast(l_shipdate as date) as dt_from,
  case when l_linenumber = 1 then cast(cast(l_shipdate as date) + 365 as string) else '9999-12-31' end as dt_to
from {lineitem}
"""

_DISCOUNTS = """
select cast(l_partkey % 25 as int) as billing_id, l_partkey as acc_id,
  cast(l_suppkey % 20 + 1 as int) as app_service_id, cast(l_shipdate as date) as dt_from,
  case when l_linenumber < 4 then '9999-12-31' else cast(cast(l_shipdate as date) + 500 as string) end as dt_to,
  cast(floor(l_quantity) as int) as discount_price
from {lineitem}
"""

_PROFILES = """
select cast(o_custkey % 25 as int) as billing_id, o_custkey + 5000000 as customer_id,
  cast(cast(o_orderdate as date) as string) as version_dt,
  cast(o_orderkey % 101 as int) as bb_rent_amount, cast(o_orderkey % 103 as int) as tv_rent_amount,
  cast(o_orderkey % 107 as int) as tlf_rent_amount, cast(o_orderkey % 11 as int) as tv_line_coast,
  cast(o_orderkey % 13 as int) as tv_mult_coast, cast(o_orderkey % 2 as int) as gender,
  cast(18 + o_orderkey % 50 as int) as customer_age, cast(o_orderkey % 5 as int) as sale_channel,
  cast(o_orderkey % 17 as int) as lk_use_count, cast(o_orderkey % 19 as int) as lk_use_count_3m,
  cast(o_orderkey % 23 as int) as all_sr_count_30d, cast(o_orderkey % 29 as int) as complaint_sr_count_30d,
  cast(o_orderkey % 31 as int) as cm_sr_count_30d, cast(o_orderkey % 37 as int) as cm_sr_count_180d
from {orders}
"""

_DAILY_PROFILE = """
select c_custkey as msisdn, c_custkey * 2 as app_n, c_nationkey as regid,
  date '1998-01-01' + cast(c_custkey % 1200 as int) as tp_change_dt,
  case when c_nationkey = 3 then null else date '2001-06-01' + c_nationkey end as max_subs_fee_dt_day_31d,
  date '2001-05-01' + cast(c_custkey % 90 as int) as last_active_roam_dt_day_90d,
  'tp_' || cast(c_nationkey as string) as tariff,
  case when c_mktsegment = 'BUILDING' then null else c_mktsegment end as segment,
  case when c_nationkey = 5 then cast('NaN' as double) when c_nationkey = 6 then null else c_acctbal end as balance,
  1 as m_reg_cd
from {customer}
"""

_MONTHLY_HISTORY = """
select o_custkey * 2 as app_n, c_nationkey as regid, 2 as m_reg_cd,
  sum(case when o_orderstatus = 'F' then 1 else 0 end) as calls_m1,
  sum(cast(o_totalprice as decimal(18, 2))) as revenue_specavg_month_3m,
  max(cast(o_orderdate as date)) as version_dt
from {orders} join {customer} on o_custkey = c_custkey
group by o_custkey, c_nationkey
"""

_SCORE_SEX = "select doc_id as msisdn, quality as model_sex from {labels}"
_SCORE_AGE = "select o_custkey as msisdn, cast(18 + o_orderkey % 50 as int) as model_age from {orders}"
_SCORE_INCOME = "select user_id as msisdn, cast(floor(value * 10) as bigint) as model_income from {events}"

_SMS = """
select o_custkey as msisdn, replace(o_orderpriority, '-', '.') as competitor,
  cast(o_orderkey % 5 as int) as call_sms
from {orders}
"""
_CALLS = "select user_id as msisdn, event_type as competitor, cast(floor(value) as int) as call_cnt from {events}"
_WEB = """
select l_suppkey as msisdn, 'Net.' || l_returnflag as competitor, cast(floor(l_quantity) as int) as request_cnt
from {lineitem}
"""

_PLACES = """
select o_custkey as msisdn, cast(date_trunc('month', o_orderdate) as date) + 21 as business_dt,
  54 + cast(max(o_orderkey * 37) % 1000 as double) / 100 as home_lat,
  30 + cast(max(o_orderkey * 53) % 2000 as double) / 100 as home_lon,
  54 + cast(min(o_custkey * 41) % 1000 as double) / 100 as work_lat,
  30 + cast(min(o_custkey * 59) % 2000 as double) / 100 as work_lon
from {orders} group by o_custkey, date_trunc('month', o_orderdate)
"""

_INTEREST = """
select l_suppkey as msisdn, l_suppkey as app_n, cast(l_suppkey % 10 as int) as regid,
  l_partkey % 97 as category_id, cast(last_day(cast(l_shipdate as date)) as string) as business_dt,
  cast(floor(l_quantity) as double) as num_requests_to_overall_by_user,
  cast(l_linenumber as double) as num_active_days_to_overall_by_user,
  case when l_linenumber = 2 then cast('NaN' as double) when l_linenumber = 4 then null
    else cast(floor(l_extendedprice) as double) end as num_requests_to_mean_by_category,
  cast(floor(l_tax * 100) as double) as num_active_days_to_mean_by_category
from {lineitem}
"""

ROLES = {
    "convergent_a": _CONVERGENT_A,
    "convergent_b": _CONVERGENT_B,
    "contracts": _CONTRACTS,
    "lifetimes": _LIFETIMES,
    "payments": _PAYMENTS,
    "traffic": _TRAFFIC,
    "equipment": _EQUIPMENT,
    "complaints": _COMPLAINTS,
    "services": _SERVICES,
    "discounts": _DISCOUNTS,
    "profiles": _PROFILES,
    "daily_profile": _DAILY_PROFILE,
    "monthly_history": _MONTHLY_HISTORY,
    "score_sex": _SCORE_SEX,
    "score_age": _SCORE_AGE,
    "score_income": _SCORE_INCOME,
    "sms": _SMS,
    "calls": _CALLS,
    "web": _WEB,
    "places": _PLACES,
    "interest": _INTEREST,
}

FIXED_SOURCES = tuple(ROLES)[:11]
