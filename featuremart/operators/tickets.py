"""Support requests: scope, ambiguity guard and two-level statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremart.functions.calendar import month_end, window_start
from featuremart.functions.temporal import elapsed_hours, next_day, within_days
from featuremart.operators.joins import attach_by, spread_join
from featuremart.operators.slots import in_slot, slot_name

# The texts in the request system.
CONTRACT_TYPE = "Фиксированный"
STATUS_FLAGS = {
    "complaints_num_active_expec": "Активное ожидание",
    "complaints_num_active": "В работе",
    "complaints_num_close": "Закрыт",
}
PRIORITY_FLAGS = {
    "complaints_num_priority_low": "Низкий",
    "complaints_num_priority_mid": "Средний",
    "complaints_num_priority_lowmid": "Ниже среднего",
    "complaints_num_priority_high": "Высокий",
    "complaints_num_priority_highmid": "Выше среднего",
    "complaints_num_priority_highest": "Наивысший",
}
DONE_STATUSES = ("Закрыт", "Решен")


@dataclass(frozen=True)
class TicketColumns:
    """Column names and texts of the request table."""

    request: str = "request_id"
    contract: str = "contract_num"
    status: str = "status"
    priority: str = "priority"
    created: str = "createdate_dt_orig"
    closed: str = "closetime_dt_orig"
    recorded: str = "raw_dt"
    kind: str = "dogtype"
    status_flags: Mapping[str, str] = field(default_factory=lambda: dict(STATUS_FLAGS))
    priority_flags: Mapping[str, str] = field(default_factory=lambda: dict(PRIORITY_FLAGS))
    done: Sequence[str] = DONE_STATUSES
    hours: str = "zhalobi_lifetime_hours"
    count: str = "cnt_zhalobi"

    def flag_names(self) -> list[str]:
        return [*self.status_flags, *self.priority_flags]

    def flag_columns(self) -> dict[str, Column]:
        """0/1 columns of status and priority."""
        pairs = [(self.status, self.status_flags), (self.priority, self.priority_flags)]
        return {
            name: F.when(F.col(col) == F.lit(value), 1).otherwise(0)
            for col, names in pairs
            for name, value in names.items()
        }


def scoped_rows(
    df: DataFrame,
    as_of: date,
    n: int = 5,
    *,
    kind: str | None = CONTRACT_TYPE,
    cols: TicketColumns = TicketColumns(),
) -> DataFrame:
    """Requests of one contract type, recorded and created in the window."""
    start = window_start(as_of, n)
    kept = df.where(
        (F.col(cols.recorded) >= next_day(start))
        & within_days(cols.created, start, month_end(as_of))
        & F.col(cols.request).isNotNull()
    )
    return kept if kind is None else kept.where(F.col(cols.kind) == kind)


def scoped(
    df: DataFrame,
    as_of: date,
    n: int = 5,
    *,
    kind: str | None = CONTRACT_TYPE,
    cols: TicketColumns = TicketColumns(),
) -> DataFrame:
    """The distinct rows of :func:`scoped_rows`, without the scope columns."""
    wanted = (cols.request, cols.status, cols.priority, cols.contract, cols.closed, cols.created)
    return scoped_rows(df, as_of, n, kind=kind, cols=cols).select(*wanted).distinct()


def unambiguous(df: DataFrame, key: str, other: str) -> DataFrame:
    """Keys whose rows all name the same ``other``; nulls in it do not count.

    Least equals greatest is the same as one distinct value and needs no second
    shuffle of the distinct pairs.
    """
    ends = df.groupBy(key).agg(F.min(other).alias("_lo"), F.max(other).alias("_hi"))
    return ends.where(F.col("_lo") == F.col("_hi")).select(key)


def keep_unambiguous(df: DataFrame, key: str, other: str) -> DataFrame:
    """Rows of the keys found by :func:`unambiguous`."""
    return spread_join(df, unambiguous(df, key, other), [key], "left_semi")


def with_ticket_flags(
    df: DataFrame, as_of: date, n: int = 5, cols: TicketColumns = TicketColumns()
) -> DataFrame:
    """Status, priority and month-slot flags plus hours to resolution."""
    slots = {
        slot_name(cols.count, k): F.when(in_slot(cols.created, as_of, k), 1).otherwise(0)
        for k in range(n)
    }
    done = F.col(cols.status).isin(list(cols.done))
    ends = [F.col(cols.created), F.col(cols.closed)]
    if {t for c, t in df.dtypes if c in (cols.created, cols.closed)} == {"date"}:
        # whole days, whatever clock changes the session's time zone has
        ends = [c.cast("timestamp_ntz") for c in ends]
    hours = {cols.hours: elapsed_hours(*ends, done)}
    return df.withColumns({**cols.flag_columns(), **hours, **slots})


def flag_names(n: int = 5, cols: TicketColumns = TicketColumns()) -> list[str]:
    return [*cols.flag_names(), *[slot_name(cols.count, k) for k in range(n)]]


def per_request(
    df: DataFrame, keys: Sequence[str], n: int = 5, cols: TicketColumns = TicketColumns()
) -> DataFrame:
    """One row per request (and account): the greatest of each flag and of the hours."""
    names = [*flag_names(n, cols), cols.hours]
    return df.groupBy(*keys, cols.request).agg(*[F.max(c).alias(c) for c in names])


def per_account(
    df: DataFrame, keys: Sequence[str], n: int = 5, cols: TicketColumns = TicketColumns()
) -> DataFrame:
    """Statistics over the rows of :func:`per_request`, which are one per request."""
    return df.groupBy(*keys).agg(
        F.count(cols.request).alias(cols.count),
        F.min(cols.hours).alias(f"min_{cols.hours}"),
        F.max(cols.hours).alias(f"max_{cols.hours}"),
        *[F.sum(c).alias(c) for c in flag_names(n, cols)],
    )


def contract_statistics(
    df: DataFrame,
    as_of: date,
    n: int = 5,
    *,
    kind: str | None = CONTRACT_TYPE,
    cols: TicketColumns = TicketColumns(),
) -> DataFrame:
    """Per contract, the statistics of its unambiguous requests.

    A request that names one contract belongs to it entirely, so guard, request
    level and contract level are plain aggregations in a row. Many rows of one
    request or contract are combined before each shuffle.
    """
    contract = F.col(cols.contract)
    rows = scoped_rows(df, as_of, n, kind=kind, cols=cols).where(contract.isNotNull())
    names = [*flag_names(n, cols), cols.hours]
    requests = (
        with_ticket_flags(rows, as_of, n, cols)
        .groupBy(cols.request)
        .agg(
            F.min(contract).alias("_lo"),
            F.max(contract).alias("_hi"),
            *[F.max(c).alias(c) for c in names],
        )
        .where(F.col("_lo") == F.col("_hi"))
        .withColumnRenamed("_lo", cols.contract)
    )
    return per_account(requests, [cols.contract], n, cols)


def request_statistics(
    df: DataFrame,
    accounts: DataFrame,
    as_of: date,
    n: int = 5,
    *,
    kind: str | None = CONTRACT_TYPE,
    cols: TicketColumns = TicketColumns(),
) -> DataFrame:
    """:func:`contract_statistics` brought onto the distinct accounts of each contract."""
    contracts = contract_statistics(df, as_of, n, kind=kind, cols=cols)
    return attach_by(accounts.distinct(), contracts, cols.contract)
