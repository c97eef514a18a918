"""Churn labels and their reports."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.functions.calendar import add_months, month_start
from featuremart.functions.churn import active_churn, passive_churn
from featuremart.operators.joins import enrich, stamp
from featuremart.operators.rollup import least_row


def label_inputs(
    identities: DataFrame, close: DataFrame, pay: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Identity rows with the account's close date and payments."""
    return enrich(enrich(identities, close, keys), pay, keys)


def label_base(
    df: DataFrame,
    keys: Sequence[str],
    ids: Sequence[str],
    pays: Sequence[str],
    close: str = "dt_close",
) -> DataFrame:
    """One row per line: account ids, payment sums (0 if none) and last close date.

    The ids are those of one account, the least of the line.
    """
    out = df.groupBy(*keys).agg(
        least_row(ids).alias("_ids"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in pays],
        F.max(close).alias(close),
    )
    return out.select(*keys, *[F.col(f"_ids.{c}").alias(c) for c in ids], *pays, close)


def with_churn_labels(
    df: DataFrame,
    month: date,
    pays: Sequence[str] = ("pay_00mm", "pay_01mm", "pay_02mm"),
    close: str = "dt_close",
) -> DataFrame:
    """Active and passive churn labels, each with the month its features come from."""
    start = month_start(month)
    labels = {
        "target_active_churn": active_churn(close, month),
        "target_passive_churn_3m": passive_churn(pays[:3]),
        "target_passive_churn_2m": passive_churn(pays[:2]),
    }
    months = {
        "business_month_join_target_active_churn": add_months(start, -1),
        "business_month_join_target_passive_churn_3m": add_months(start, -3),
        "business_month_join_target_passive_churn_2m": add_months(start, -2),
        "table_business_month": start,
    }
    return stamp(df.withColumns(labels), months).drop(close)


def class_counts(df: DataFrame, by: Sequence[str], label: str) -> DataFrame:
    return df.groupBy(*by, label).agg(F.count(label).alias("cnt"))


def label_share(df: DataFrame, by: Sequence[str], label: str) -> DataFrame:
    """Positives, rows and the share of positives in percent."""
    counts = df.groupBy(*by).agg(
        F.sum(label).alias(f"sum_{label}"), F.count(label).alias("total_cnt")
    )
    share = F.try_divide(F.col(f"sum_{label}") * 100, F.col("total_cnt"))
    return counts.withColumn("main_target_share", F.round(share, 2))
