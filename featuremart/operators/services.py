"""Service counters and discount totals per account."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.functions.temporal import valid_on
from featuremart.operators.joins import enrich
from featuremart.operators.snapshots import snapshot

SERVICE = "app_service_id"
CLOSED = "is_closed"
BASIC = "is_b2c_basic_service"
PRICE = "discount_price"


def active(services: DataFrame, as_of: date) -> DataFrame:
    """Rows valid on the day and not closed."""
    return snapshot(services, as_of).where(F.col(CLOSED) == 0)


def closed_services(services: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct services ever closed, over all history."""
    pairs = services.select(*keys, SERVICE, CLOSED).distinct()
    return pairs.groupBy(*keys).agg(F.sum(CLOSED).alias("closed_cnt"))


def basic_services(active_rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct basic and other services among the active ones."""
    pairs = active_rows.select(*keys, SERVICE, BASIC).distinct()
    counts = pairs.groupBy(*keys).agg(
        F.sum(BASIC).alias("basic_serv_cnt"), F.count(BASIC).alias("_all")
    )
    return counts.withColumn("not_basic_serv_cnt", F.col("_all") - F.col("basic_serv_cnt")).drop("_all")


def active_services(active_rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return active_rows.groupBy(*keys).agg(F.count_distinct(SERVICE).alias("active_serv_cnt"))


def attach_discounts(active_rows: DataFrame, discounts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each active service of an account with the sum of its discounts.

    Both sides are reduced to one row per service first, so that a repeated
    service row cannot multiply a discount.
    """
    each = active_rows.select(*keys, SERVICE).distinct()
    totals = discounts.distinct().groupBy(*keys, SERVICE).agg(F.sum(PRICE).alias(PRICE))
    return enrich(each, totals, [*keys, SERVICE])


def discount_totals(
    services: DataFrame, discounts: DataFrame, keys: Sequence[str], as_of: date
) -> DataFrame:
    """Discounts on active services, per account; null where there are none."""
    attached = attach_discounts(active(services, as_of), snapshot(discounts, as_of), keys)
    return attached.groupBy(*keys).agg(F.sum(PRICE).alias("all_disc_sum"))


def service_block(
    services: DataFrame, discounts: DataFrame, keys: Sequence[str], as_of: date
) -> DataFrame:
    """All counters of accounts with an active service, reading the services once.

    The rows are reduced to one per account and service with 0/1 marks; the
    discount totals join there and a second aggregation adds everything up.
    """
    on = valid_on(as_of, "dt_from", "dt_to") & (F.col(CLOSED) == 0)

    def mark(cond):
        return F.max(F.when(cond, 1).otherwise(0))

    per_service = services.groupBy(*keys, SERVICE).agg(
        mark(F.col(CLOSED) == 1).alias("_closed"),
        mark(on).alias("_active"),
        mark(on & (F.col(BASIC) == 1)).alias("_basic"),
        mark(on & (F.col(BASIC) == 0)).alias("_other"),
    )
    totals = (
        snapshot(discounts, as_of).distinct().groupBy(*keys, SERVICE).agg(F.sum(PRICE).alias("_price"))
    )
    block = enrich(per_service, totals, [*keys, SERVICE]).groupBy(*keys).agg(
        # a missing service id is no service to count, but makes the account active
        F.sum(F.when(F.col(SERVICE).isNotNull(), F.col("_active")).otherwise(0)).alias("active_serv_cnt"),
        F.sum("_closed").alias("closed_cnt"),
        F.sum("_basic").alias("basic_serv_cnt"),
        F.sum("_other").alias("not_basic_serv_cnt"),
        F.sum(F.when(F.col("_active") == 1, F.col("_price"))).alias("all_disc_sum"),
        F.max("_active").alias("_any_active"),
    )
    return block.where(F.col("_any_active") == 1).drop("_any_active")
