"""Labels, cohorts, training sets, feature catalogue and model quality."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.functions.calendar import month_start
from featuremart.functions.temporal import feature_month
from featuremart.operators import profile
from featuremart.operators.identity import mask_by_role
from featuremart.operators.joins import (
    as_of_join,
    assemble_known,
    attach_by,
    enrich_spread,
    full_merge,
    holdout,
    stack,
    unused,
)
from featuremart.operators.labels import label_base, with_churn_labels
from featuremart.operators.quality import confusion, lift_table
from featuremart.operators.ranking import Cohort, cap_rows, monthly_cohorts
from featuremart.operators.sampling import downsample, downsample_strata
from featuremart.operators.slots import month_slots, slot_name
from featuremart.operators.snapshots import latest_by
from featuremart.plans.fixed import ACCOUNT, line_identities
from featuremart.sources.storage import checkpoint_dir
from featuremart.sources.tables import export_parquet, replace_partition, write_table

LABEL = "target_active_churn"
MONTH = "table_business_month"


def label_keys(mobile: str = "mobile") -> list[str]:
    return [f"{mobile}_id", f"{mobile}_acc_id", f"{mobile}_msisdn"]


def churn_labels(
    convergent_a: DataFrame,
    convergent_b: DataFrame,
    lifetimes: DataFrame,
    payments: DataFrame,
    month: date,
    *,
    mobile: str = "mobile",
    fixed: str = "fix",
) -> DataFrame:
    """Churn labels of one month, one row per line.

    Close date and payments are merged per account first; the identities then
    need a single join.
    """
    rows = stack(convergent_a, convergent_b)
    owner = [f"{fixed}_billing_id", f"{fixed}_acc_id"]
    ties = [f"{mobile}_msisdn", f"{mobile}_acc_id", f"{mobile}_id", f"{fixed}_acc_num"]
    newest = latest_by(rows, owner, "dt_from", [*ties, "personal_account_number", f"{mobile}_tariff_plan"])
    identities = line_identities(newest, mobile, fixed)
    # the row closed last is the one with the greatest close date
    closes = lifetimes.groupBy(*ACCOUNT).agg(F.max(F.col("dt_close").cast("date")).alias("dt_close"))
    pays = month_slots(payments, ACCOUNT, "dt", "amount", "pay", month, n=3)
    facts = enrich_spread(identities, full_merge([closes, pays], ACCOUNT), ACCOUNT)
    masked = mask_by_role(facts, F.col(f"is_{mobile}") == 0, [*ACCOUNT, "acc_num"])
    names = [slot_name("pay", k) for k in range(3)]
    lines = label_base(masked, label_keys(mobile), [*ACCOUNT, "acc_num"], names)
    return with_churn_labels(lines, month, names)


def positives_and_holdout(
    labels: DataFrame,
    keys: Sequence[str],
    n_positive: int,
    n_negative: int,
    label: str = LABEL,
    seed: int = 0,
) -> DataFrame:
    """A labelled set by row counts: ``n_positive`` rows as 1 and ``n_negative`` others as 0.

    The labels are checkpointed, since they are read several times.
    """
    checkpoint_dir(labels.sparkSession)
    labels = labels.checkpoint()
    first = cap_rows(labels, n_positive, keys, seed)
    rest = cap_rows(holdout(labels, first, keys), n_negative, keys, seed)
    return stack(first.withColumn(label, F.lit(1)), rest.withColumn(label, F.lit(0)))


def cohort_targets(
    labels: DataFrame, cohorts: Sequence[Cohort], *, mobile: str = "mobile", label: str = LABEL
) -> DataFrame:
    """Disjoint monthly cohorts in line order; the labels must be one row per line.

    They are checkpointed, since the cohorts look at them several times.
    """
    _, account, line = label_keys(mobile)
    order = [line, account, f"{mobile}_id"]
    checkpoint_dir(labels.sparkSession)
    bare = labels.drop(label, MONTH).checkpoint()
    return monthly_cohorts(bare, order, cohorts, label, MONTH, unique=True)


def target_table(
    targets: DataFrame, name: str, months: Sequence[date], *, mobile: str = "mobile", label: str = LABEL
) -> None:
    """Write the label columns of the given months; rerunning a month replaces it.

    All months go in one write, each into its own partition.
    """
    wanted = targets.where(F.col(MONTH).isin(list(months)))
    replace_partition(wanted.select(*label_keys(mobile), label, MONTH), name, MONTH)


def publish_month(
    mart: DataFrame, name: str, *, unique: Sequence[str] = (), fmt: str = "orc", path: str | None = None
) -> list[str]:
    """Store a mart under the month it is stamped with; rerunning a month replaces it and no other.

    With ``unique``, the columns of its grain, a mart that repeats a key is refused. The wide rows
    have one month, so they are written where the last join leaves them and not shuffled again.
    """
    return replace_partition(mart, name, MONTH, fmt=fmt, path=path, unique=unique, sized=True)


def training_set(
    labels: DataFrame,
    fixed: DataFrame,
    mobile_mart: DataFrame,
    *,
    mobile: str = "mobile",
    line: str = "msisdn",
    lag: int | None = None,
    within: int | None = 0,
) -> DataFrame:
    """Labels with the fixed and mobile features of their line.

    With ``lag``, both marts carry a month column and a label gets the features
    of ``lag`` months before it, never of a later month; otherwise one snapshot
    serves all months. ``within`` is how many months older than that the
    features of a line may be (``None``: any). Unless it is 0, the newest month
    of each line counts, and ``fixed_feature_month`` and ``mobile_feature_month``
    tell which it is.
    """
    keys = label_keys(mobile)
    if lag is None:
        features = assemble_known(labels, [(fixed.drop(MONTH), keys)])
        renamed = features.withColumnRenamed(f"{mobile}_msisdn", line)
        return assemble_known(renamed, [(mobile_mart.drop(MONTH), [line])])
    target = feature_month(F.col(MONTH).cast("date"), lag)
    if within != 0:
        features = as_of_join(labels, fixed, keys, target, MONTH, within=within, out="fixed_feature_month")
        renamed = features.withColumnRenamed(f"{mobile}_msisdn", line)
        return as_of_join(renamed, mobile_mart, [line], target, MONTH, within=within, out="mobile_feature_month")
    at = unused("_month", labels, fixed, mobile_mart)
    dated = labels.withColumn(at, target)

    def at_month(mart: DataFrame) -> DataFrame:
        return mart.withColumn(at, F.col(MONTH).cast("date")).drop(MONTH)

    features = assemble_known(dated, [(at_month(fixed), [*keys, at])])
    renamed = features.withColumnRenamed(f"{mobile}_msisdn", line)
    return assemble_known(renamed, [(at_month(mobile_mart), [line, at])]).drop(at)


def usable_months(mart: DataFrame, months: tuple[date, date], lag: int, within: int | None = 0) -> DataFrame:
    """The months of a mart that labels of ``[first, last]`` can meet; prunes the partitions of a stored mart."""
    first, last = months
    kept = mart.where(F.col(MONTH) <= F.lit(month_start(last, lag).isoformat()))
    if within is None:
        return kept
    return kept.where(F.col(MONTH) >= F.lit(month_start(first, lag + within).isoformat()))


def feature_join(fixed: DataFrame, mobile_mart: DataFrame, *, mobile: str = "mobile", line: str = "msisdn"):
    """Lines present in both marts; where both are stamped with a month, that of the mobile mart stays."""
    if MONTH in mobile_mart.columns:
        fixed = fixed.drop(MONTH)
    return attach_by(fixed.withColumnRenamed(f"{mobile}_msisdn", line), mobile_mart, line)


def build_split(
    targets: DataFrame,
    fixed: DataFrame,
    mobile_mart: DataFrame,
    months: tuple[date, date],
    *,
    ratio: float = 10,
    seed: int = 0,
    label: str = LABEL,
    mobile: str = "mobile",
    lag: int | None = None,
    within: int | None = 0,
    by_month: bool = False,
) -> DataFrame:
    """Train, validation or test set of the label months ``[first, last]``.

    One share of negatives serves all months; ``by_month`` gives each month its
    exact ratio instead.

    ``lag`` and ``within`` as in :func:`training_set`; with ``lag`` only the
    months of the marts that can matter are read.

    The negatives are drawn before the features join: the draw needs only label
    and key, and the dropped rows then never meet the wide marts.
    """
    first, last = months
    rows = targets.where(F.col(MONTH).between(F.lit(first), F.lit(last)))
    key = [*label_keys(mobile), MONTH]
    sampled = downsample_strata(rows, label, ratio, key, [MONTH], seed) if by_month else downsample(rows, label, ratio, key, seed)
    if lag is not None:
        fixed, mobile_mart = (usable_months(mart, months, lag, within) for mart in (fixed, mobile_mart))
    return training_set(sampled, fixed, mobile_mart, mobile=mobile, lag=lag, within=within)


def save_split(df: DataFrame, table: str, export_path: str) -> None:
    """Store a split as a table and export it from there as parquet."""
    write_table(df, table)
    export_parquet(df.sparkSession.table(table), export_path)


def feature_catalogue(
    features: DataFrame, rules: Mapping[str, object] | None = None
) -> DataFrame:
    """Usable columns with data type and kind, chosen by their profile."""
    metrics = profile.metric_pivot(profile.metric_rows(profile.column_profile(features)))
    return profile.feature_catalog(features, profile.select_features(metrics, **(rules or {})))


def quality_report(
    scored: DataFrame, label: str, score: str, key: Sequence[str], threshold: float = 0.5, n: int = 10
) -> tuple[DataFrame, DataFrame]:
    """Confusion matrix and lift table of a scored set."""
    return confusion(scored, label, score, threshold), lift_table(scored, label, score, key, n)
