"""Fixed-line mart: account blocks, and one row per mobile line.

``mobile`` is the column prefix of the mobile billing system and ``fixed`` that
of the fixed-line one; pass your own to keep your column names.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featuremart.functions.calendar import month_start
from featuremart.functions.temporal import days_since, valid_on
from featuremart.functions.units import to_gb
from featuremart.operators import categorical, services, tickets
from featuremart.operators.identity import dual_identity, mask_by_role
from featuremart.operators.intervals import day_masks, mask_names, masked_days
from featuremart.operators.joins import assemble, attach_by, enrich_spread, stack, stamp, unused
from featuremart.operators.rollup import pair_is_exact, rollup_entity, rollup_pair
from featuremart.operators.slots import month_slots, payment_block, slot_name
from featuremart.operators.snapshots import (
    latest_by,
    repair_open_date,
    snapshot,
    with_closed_flag,
    with_open_flags,
    with_tenure,
)

ACCOUNT = ("billing_id", "acc_id")
PROFILE_KEY = ("billing_id", "customer_id")

# The five services, by the suffix of their date columns, and the
# name each one has in its duration column.
SERVICES = ("spd", "ctv", "atv", "tlf", "ictv")
DURATION_NAMES = {"spd": "spd", "tlf": "telef", "atv": "atv", "ctv": "ctv", "ictv": "ictv"}

# Equipment and provision codes with a column of their own.
EQUIPMENT_VALUES = {"equipment_type": list(range(1, 20)), "provide_type": [1, 2, 3, 4]}
EQUIPMENT_MASK = "_equipment"


def line_identities(
    df: DataFrame,
    mobile: str = "mobile",
    fixed: str = "fix",
    number: str = "personal_account_number",
    *,
    distinct: bool = True,
    also: Sequence[str] = (),
) -> DataFrame:
    """Both identities of each row: ``is_{mobile}`` 1 with the mobile account, 0 with the fixed one.

    ``also`` names further columns that tell identities apart, such as the day of a snapshot.
    """
    return dual_identity(
        df,
        [f"{mobile}_id", f"{mobile}_acc_id", number, f"{mobile}_msisdn", f"{mobile}_tariff_plan", *also],
        {
            1: {"billing_id": f"{mobile}_id", "acc_id": f"{mobile}_acc_id", "acc_num": number},
            0: {
                "billing_id": f"{fixed}_billing_id",
                "acc_id": f"{fixed}_acc_id",
                "acc_num": f"{fixed}_acc_num",
            },
        },
        f"is_{mobile}",
        distinct=distinct,
    )


def latest_contracts(contracts: DataFrame, ties: Sequence[str] = ("contract_id",)) -> DataFrame:
    """The newest contract per account, without the columns the identity already has."""
    return latest_by(contracts, ACCOUNT, "dt_from", ties).drop("acc_num", "dt_to")


def identity_base(
    convergent_a: DataFrame,
    convergent_b: DataFrame,
    contracts: DataFrame,
    as_of: date,
    *,
    mobile: str = "mobile",
    fixed: str = "fix",
    ties: Sequence[str] = ("contract_id",),
) -> DataFrame:
    """Identities valid on ``as_of`` with the attributes of the newest contract."""
    current = snapshot(stack(convergent_a, convergent_b), as_of)
    return enrich_spread(line_identities(current, mobile, fixed), latest_contracts(contracts, ties), ACCOUNT)


def identity_months(
    convergent_a: DataFrame,
    convergent_b: DataFrame,
    contracts: DataFrame,
    days: Sequence[date],
    *,
    mobile: str = "mobile",
    fixed: str = "fix",
    ties: Sequence[str] = ("contract_id",),
    day: str = "snapshot_day",
) -> DataFrame:
    """:func:`identity_base` for many days, each identity with the ``day`` it is valid on; all sources are read once.

    The days of an identity travel as bits of longs, so that it is made distinct and meets its contract once, not once per day.
    """
    rows = stack(convergent_a, convergent_b)
    newest = latest_contracts(contracts, ties)
    masks = mask_names(days, unused("_days", rows, newest))
    current = rows.select("*", *day_masks(days, masks)).where(reduce(Column.__or__, [F.col(m) != 0 for m in masks], F.lit(False)))
    versions = line_identities(current, mobile, fixed, distinct=False, also=masks)
    identities = versions.groupBy(*[c for c in versions.columns if c not in masks]).agg(*[F.bit_or(m).alias(m) for m in masks])
    joined = enrich_spread(identities, newest, ACCOUNT).withColumn(day, F.explode(masked_days(days, masks)))
    named = dict.fromkeys([*ACCOUNT, *[day if c in masks else c for c in versions.columns], *newest.columns])
    return joined.select(*named)


def lifetime_block(lifetimes: DataFrame, as_of: date) -> DataFrame:
    """Tenure and open-service flags, one row per account.

    Of several rows of an account the one closed last counts.
    """
    opened = [f"dt_open_{s}" for s in SERVICES]
    repaired = repair_open_date(lifetimes, "dt_open", opened)
    others = [c for c in repaired.columns if c not in (*ACCOUNT, "dt_close")]
    single = latest_by(repaired, ACCOUNT, "dt_close", others)
    pairs = {s: (f"dt_open_{s}", f"dt_close_{s}") for s in SERVICES}
    tenures = {f"live_dur_fix_{DURATION_NAMES[s]}": pair for s, pair in pairs.items()}
    out = with_closed_flag(single, "is_contract_closed_flg", "dt_close", as_of)
    out = with_tenure(out, {"live_dur_contract": ("dt_open", "dt_close"), **tenures}, as_of)
    out = with_open_flags(out, {f"has_opened_{s}": pair for s, pair in pairs.items()}, as_of)
    out = out.withColumn("is_acc_att", F.lit(1))
    return out.drop("dt_close", *[close for _, close in pairs.values()])


def payments_block(payments: DataFrame, as_of: date, none_class=0) -> DataFrame:
    """Five month sums and dominant payment classes."""
    return payment_block(payments, ACCOUNT, as_of, none_value=none_class)


def traffic_block(traffic: DataFrame, as_of: date, align: str = "month") -> DataFrame:
    """Gigabytes per month slot; ``align='exact'`` counts rows dated on a month end only."""
    gb = to_gb("number_of_units", "metric_unit_number")
    return month_slots(
        traffic, ACCOUNT, "dt", gb, "shpd_gb", as_of, align=align, style="plain", present="is_traffic"
    )


def equipment_masks(
    equipment: DataFrame, as_of: date, values: Mapping[str, Sequence[int]] = EQUIPMENT_VALUES
) -> DataFrame:
    """:func:`equipment_block` with the presence matrix still packed into longs.

    One read and one shuffle: the current rows are told apart inside the
    aggregates.
    """
    current = valid_on(as_of, "dt_from", "dt_to")
    return (
        equipment.groupBy(*ACCOUNT)
        .agg(
            *categorical.presence_masks(values, current, EQUIPMENT_MASK),
            F.max(F.when(current, 1)).alias("is_equip"),
            F.max(F.when(F.col("is_blocked") == 1, 1)).alias("had_block_eq"),
        )
        .where(F.col("is_equip") == 1)
        .withColumn("had_old_eq", F.lit(1))
    )


def equipment_block(
    equipment: DataFrame, as_of: date, values: Mapping[str, Sequence[int]] = EQUIPMENT_VALUES
) -> DataFrame:
    """Presence matrix of accounts with current equipment, and flags over all history."""
    return unpack_equipment(equipment_masks(equipment, as_of, values), values)


def unpack_equipment(
    df: DataFrame, values: Mapping[str, Sequence[int]] = EQUIPMENT_VALUES
) -> DataFrame:
    """Replace the packed equipment flags by one column per combination."""
    return df.select("*", *categorical.presence_columns(values, EQUIPMENT_MASK)).drop(
        *categorical.mask_names(values, EQUIPMENT_MASK)
    )


def complaint_block(
    complaints: DataFrame,
    base: DataFrame,
    as_of: date,
    cols: tickets.TicketColumns = tickets.TicketColumns(),
) -> DataFrame:
    """Request statistics per account and contract of the identity base."""
    accounts = base.select(*ACCOUNT, "acc_num", cols.contract)
    block = tickets.request_statistics(complaints, accounts, as_of, cols=cols)
    return block.withColumn("is_zhalobi", F.lit(1))


def service_block(service_rows: DataFrame, discounts: DataFrame, as_of: date) -> DataFrame:
    """Service counters and discount totals of accounts with an active service."""
    return services.service_block(service_rows, discounts, ACCOUNT, as_of)


def profile_block(profiles: DataFrame) -> DataFrame:
    """The newest profile per customer; equal versions are settled by their values."""
    others = [c for c in profiles.columns if c not in (*PROFILE_KEY, "version_dt")]
    return latest_by(profiles, PROFILE_KEY, "version_dt", others).drop("version_dt")


def entity_spec(
    mobile: str = "mobile",
    equipment: Mapping[str, Sequence[int]] = EQUIPMENT_VALUES,
    n: int = 5,
    cols: tickets.TicketColumns = tickets.TicketColumns(),
    *,
    packed: bool = False,
) -> dict[str, str]:
    """Column -> rule of the final rollup; ``packed`` for equipment flags that are still masks."""
    # fixed values: the column names of the mart
    durations = [f"live_dur_fix_{DURATION_NAMES[s]}" for s in SERVICES]
    complaint_slots = [slot_name(cols.count, k) for k in range(n)]
    rules = {
        # columns that describe one thing come from one row
        "row:account": [*ACCOUNT, "acc_num"],
        "row:person": ["gender", "sale_channel"],
        "first": [f"{mobile}_contract_num", "is_noncommercial"],
        "max": [
            "total_live_dur", "is_closed", "is_archive", "is_contract_closed_flg", "live_dur_contract",
            *durations,
            *[f"has_opened_{s}" for s in SERVICES],
            f"min_{cols.hours}", f"max_{cols.hours}", *cols.flag_names(),
            *[slot_name("pay_class", k) for k in range(n)],
            *([] if packed else categorical.one_hot_names(equipment)), "had_old_eq", "had_block_eq",
            "bb_rent_amount", "tv_rent_amount", "tlf_rent_amount", "tv_line_coast", "tv_mult_coast",
            "customer_age",
        ],
        "sum": [
            "orders_credit", "credit",
            *[slot_name("pay", k) for k in range(n)],
            *[slot_name("shpd_gb", k, "plain") for k in range(n)],
            cols.count, *complaint_slots,
            "active_serv_cnt", "closed_cnt", "basic_serv_cnt", "not_basic_serv_cnt", "all_disc_sum",
            "lk_use_count", "lk_use_count_3m", "all_sr_count_30d", "complaint_sr_count_30d",
            "cm_sr_count_30d", "cm_sr_count_180d",
        ],
        "bits": categorical.mask_names(equipment, EQUIPMENT_MASK) if packed else [],
    }
    return {c: rule for rule, names in rules.items() for c in names}


def finish_entities(
    df: DataFrame,
    as_of: date,
    *,
    mobile: str = "mobile",
    spec: Mapping[str, str] | None = None,
    number: str = "personal_account_number",
) -> DataFrame:
    """Mask ids by role, add the whole-life duration and roll up to one row per line."""
    role = F.col(f"is_{mobile}")
    masked = df.withColumn(f"{mobile}_contract_num", F.when(role == 1, F.col("contract_num")))
    masked = mask_by_role(masked, role == 0, [*ACCOUNT, "acc_num"])
    masked = masked.withColumn("total_live_dur", days_since("dt_from", as_of))
    keys = [f"{mobile}_id", f"{mobile}_acc_id", number, f"{mobile}_msisdn", f"{mobile}_tariff_plan"]
    return rollup_entity(masked, keys, entity_spec(mobile) if spec is None else spec)


def account_rows(
    accounts: DataFrame,
    sources: Mapping[str, DataFrame],
    as_of: date,
    wanted: Sequence[str],
    *,
    align: str = "month",
    ties: Sequence[str] = ("contract_id",),
    equipment: Mapping[str, Sequence[int]] = EQUIPMENT_VALUES,
    cols: tickets.TicketColumns = tickets.TicketColumns(),
) -> tuple[DataFrame, dict[str, str]]:
    """Per account with any row in a block, all blocks as one column ``_blocks``; and the field of it that holds each column.

    Joins are on unique keys. Each block is one struct, null for accounts it lacks, so that
    most accounts stay narrow. Contracts meet their requests and profiles first, when no
    account without a contract is with them; the other joins share one partitioning.
    """
    requests = tickets.contract_statistics(sources["complaints"], as_of, cols=cols)
    contracts = attach_by(accounts, latest_contracts(sources["contracts"], ties), ACCOUNT)
    contracts = enrich_spread(contracts, requests, [cols.contract], ACCOUNT)
    contracts = enrich_spread(contracts, profile_block(sources["profiles"]), PROFILE_KEY, ACCOUNT)
    blocks = {
        "contract": contracts.withColumn("total_live_dur", days_since("dt_from", as_of)),
        "lifetime": lifetime_block(sources["lifetimes"], as_of),
        "payment": payments_block(sources["payments"], as_of),
        "traffic": traffic_block(sources["traffic"], as_of, align),
        "equipment": equipment_masks(sources["equipment"], as_of, equipment),
        "service": service_block(sources["services"], sources["discounts"], as_of),
    }
    fields, packed = {}, []
    for name, block in blocks.items():
        own = [c for c in block.columns if c not in ACCOUNT]
        if clash := set(own) & set(fields):
            raise ValueError(f"two blocks have {sorted(clash)}")
        fields |= dict.fromkeys(own, name)
        packed.append((block.select(*ACCOUNT, F.struct(*[c for c in own if c in wanted]).alias(name)), ACCOUNT))
    known = reduce(Column.__or__, [F.col(name).isNotNull() for name in blocks])
    rows = assemble(accounts, packed).where(known).select(*ACCOUNT, F.struct(*blocks).alias("_blocks"))
    return rows, {c: f"{name}.{c}" for c, name in fields.items()}


def fixed_mart(
    sources: Mapping[str, DataFrame],
    as_of: date,
    *,
    mobile: str = "mobile",
    fixed: str = "fix",
    align: str = "month",
    ties: Sequence[str] = ("contract_id",),
    equipment: Mapping[str, Sequence[int]] = EQUIPMENT_VALUES,
    cols: tickets.TicketColumns = tickets.TicketColumns(),
) -> DataFrame:
    """One row per mobile line with all blocks, stamped with the month of ``as_of``.

    Everything but the role of a line depends on the account alone, so the blocks are joined once per account.
    A line has one mobile account, and hardly any has more than one fixed account: these lines meet the rows of
    both accounts in two joins and merge them in a projection. Only the identities of the
    others go through an aggregation of wide rows.
    """
    current = snapshot(stack(sources["convergent_a"], sources["convergent_b"]), as_of)
    identities = line_identities(current, mobile, fixed, distinct=False)
    accounts = identities.select(*ACCOUNT).distinct()
    # packed, the flags take two columns through the joins and the rollup, not 76
    spec = entity_spec(mobile, equipment, cols=cols, packed=True)
    own = [*ACCOUNT, "acc_num", f"{mobile}_contract_num"]
    wanted = [*[c for c in spec if c not in own], "contract_num"]
    rows, fields = account_rows(accounts, sources, as_of, wanted, align=align, ties=ties, equipment=equipment, cols=cols)
    if clash := set(fields) & set(identities.columns):
        raise ValueError(f"both sides have {sorted(clash)}")
    # an account without a number has no complaint row of its own
    request_columns = {f"min_{cols.hours}", f"max_{cols.hours}", cols.count, *tickets.flag_names(cols=cols)}

    def of_account(blocks: str, role: Column, account: Mapping[str, Column]) -> dict[str, Column]:
        """The columns of the rollup for one identity, ``blocks`` being the row of its account."""
        field = lambda c: F.col(f"{blocks}.{fields[c]}")
        values = {c: F.when(account["acc_num"].isNotNull(), field(c)) if c in request_columns else field(c) for c in wanted}
        masked = {c: F.when(role == 0, column) for c, column in account.items()}
        return values | masked | {f"{mobile}_contract_num": F.when(role == 1, values["contract_num"])}

    number = "personal_account_number"
    keys = [f"{mobile}_id", f"{mobile}_acc_id", number, f"{mobile}_msisdn", f"{mobile}_tariff_plan"]
    triple = [*ACCOUNT, "acc_num"]
    kinds = {c: identities.schema[c].dataType for c in triple}
    exact = all(pair_is_exact(rows.select(f"_blocks.{fields[c]}").schema[0].dataType) for c, rule in spec.items() if rule == "sum")
    one, lines = _lines(current, keys, dict(zip(triple, (f"{fixed}_billing_id", f"{fixed}_acc_id", f"{fixed}_acc_num"))), kinds)

    one = one & F.lit(exact)
    several = lines.where(~one).select(*[F.col(k).alias(f"_of_{k}") for k in keys])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    many = line_identities(current.join(several, same, "left_semi"), mobile, fixed)
    joined = enrich_spread(many, rows, ACCOUNT)
    columns = of_account("_blocks", F.col(f"is_{mobile}"), {c: F.col(c) for c in triple})
    rolled = rollup_entity(joined.select(*keys, *[columns[c].alias(c) for c in spec]), keys, spec)

    types = {c: rolled.schema[c].dataType for c in spec}
    placed = lines.where(one).select(
        *keys,
        *[F.col(source).cast(kinds[c]).alias(f"_{c}_1") for c, source in zip(triple, (f"{mobile}_id", f"{mobile}_acc_id", number))],
        *[F.col(f"_least_{c}").alias(f"_{c}_0") for c in triple],
        # not as literals: the optimizer would cut unused fields from the rows of one role, which then are made once more
        *[F.when(F.col("_rows") > 0, role).alias(f"_role_{role}") for role in (1, 0)],
    )
    for role in (1, 0):
        names = {c: f"_{c}_{role}" for c in ACCOUNT} | {"_blocks": f"_blocks_{role}"}
        placed = enrich_spread(placed, rows.withColumnsRenamed(names), [names[c] for c in ACCOUNT], keys)
    sides = [of_account(f"_blocks_{role}", F.col(f"_role_{role}"), {c: F.col(f"_{c}_{role}") for c in triple}) for role in (1, 0)]
    merged = placed.select(*keys, *rollup_pair(spec, *sides, types))
    mart = unpack_equipment(stack(merged, rolled), equipment)
    return stamp(mart, {"table_business_month": month_start(as_of).isoformat()})


def _lines(
    current: DataFrame, keys: Sequence[str], account: Mapping[str, str], kinds: Mapping[str, T.DataType]
) -> tuple[Column, DataFrame]:
    """One narrow row per line with the least fixed ``account``; and whether it is its only one."""
    known = current.select(*keys, *[F.col(source).cast(kinds[c]).alias(f"_{c}") for c, source in account.items()])
    lines = known.groupBy(*keys).agg(
        F.count("*").alias("_rows"),
        *[f(f"_{c}").alias(f"_{name}_{c}") for c in account for name, f in (("least", F.min), ("most", F.max), ("held", F.count))],
    )
    alike = [
        (F.col(f"_held_{c}") == 0) | ((F.col(f"_held_{c}") == F.col("_rows")) & (F.col(f"_least_{c}") == F.col(f"_most_{c}")))
        for c in account
    ]
    return F.coalesce(reduce(Column.__and__, alike), F.lit(False)), lines
