"""Mobile mart: five feature blocks and their assembly.

The blocks stay DataFrames until the mart is written, so columns nobody asks for
are pruned through all of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.functions.calendar import add_months, month_end, month_start
from featuremart.functions.text import prefixed
from featuremart.operators.categorical import category_matrix, category_vectors, contact_matrix, merge_vectors, spread_vectors
from featuremart.operators.joins import assemble_known, attach_history, fill_typed, full_merge, stamp
from featuremart.operators.moves import pair_moves
from featuremart.operators.snapshots import lag_columns, with_days_since

LINE = "msisdn"
HISTORY_KEY = ("app_n", "regid")

# Columns of the monthly history that the daily profile has too.
HISTORY_CLASHES = ("sappn", "sappn_str", "m_reg_cd", "table_business_month")

# Number of interest categories, and the metrics with their columns.
CATEGORIES = 95
INTEREST_METRICS = {
    "num_requests_to_overall_by_user": "cat_{}_interest_num_requests_to_overall_by_user",
    "num_active_days_to_overall_by_user": "cat_{}_interest_num_active_days_to_overall_by_user",
    "num_requests_to_mean_by_category": "cat_{}_num_requests_to_mean_by_category",
    "num_active_days_to_mean_by_category": "cat_{}_num_active_days_to_mean_by_category",
}

#: The column of a line's interest vector.
INTERESTS = "interests"

# Column prefixes of the contact channels, and the snapshot day.
SMS_PREFIX = "fix_comp_sms_cnt_"
CALLS_PREFIX = "fix_comp_calls_cnt_"
WEB_PREFIX = "fix_comp_web_cnt_"
PLACE_DAY = 22


def age_name(date_col: str) -> str:
    """``x_dt`` ages as ``x_days``, ``x_dt_day_90d`` as ``x_day_90d_days_ago``."""
    if date_col.endswith("_dt"):
        return date_col.removesuffix("_dt") + "_days"
    return date_col.replace("_dt_", "_") + "_days_ago"


def mobile_base(
    daily: DataFrame,
    history: DataFrame,
    logical_date: date,
    date_columns: Sequence[str],
    *,
    keys: Sequence[str] = HISTORY_KEY,
    clashes: Sequence[str] = HISTORY_CLASHES,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Daily profile with event ages at month end and the monthly history.

    ``columns`` keeps a curated list of the result.
    """
    aged = with_days_since(daily, {age_name(c): c for c in date_columns}, month_end(logical_date))
    joined = attach_history(aged, history, keys, clashes)
    return joined.select(*columns) if columns else joined


def demographic_scores(
    sex: DataFrame, age: DataFrame, income: DataFrame, *, key: str = LINE, age_prefix: str | None = None
) -> DataFrame:
    """Three score tables merged to one row per line.

    ``age_prefix`` is put before the line number of the age table, for sources
    that store it without the country code.
    """
    ages = age.select(key, "model_age")
    if age_prefix is not None:
        ages = ages.withColumn(key, prefixed(age_prefix, key))
    return full_merge([sex.select(key, "model_sex"), ages, income.select(key, "model_income")], [key])


def competitor_contacts(
    sms: DataFrame,
    calls: DataFrame,
    web: DataFrame,
    *,
    key: str = LINE,
    dim: str = "competitor",
    sms_dim: str | None = None,
    values: Mapping[str, Sequence[str]] | None = None,
    other: str | None = None,
) -> DataFrame:
    """Contacts per line: one column per channel and competitor.

    ``values`` fixes the competitors per channel (``sms``, ``calls``, ``web``);
    without it they are looked up in the data. ``other`` names the column of
    contacts with no or an unlisted name, which raise an error otherwise.
    """
    known = values or {}
    return contact_matrix(
        [
            (sms, sms_dim or dim, "call_sms", SMS_PREFIX, known.get("sms")),
            (calls, dim, "call_cnt", CALLS_PREFIX, known.get("calls")),
            (web, dim, "request_cnt", WEB_PREFIX, known.get("web")),
        ],
        key,
        other=other,
    )


def relocations(home_work: DataFrame, logical_date: date, *, key: str = LINE, n: int = 4) -> DataFrame:
    """Distances moved between the snapshots of the last ``n`` months."""
    first = logical_date.replace(day=PLACE_DAY)
    days = [add_months(first, -k) for k in range(n)]
    places = {
        f"{place}_{axis}": F.col(f"{place}_place_coord.{axis}")
        for place in ("home", "work")
        for axis in ("lat", "lon")
    }
    lagged = lag_columns(home_work, [key], "business_dt", places, days)
    return lagged.select(key, *pair_moves(("home", "work"), n))


def host_interests(
    interest: DataFrame,
    logical_date: date,
    *,
    key: str = LINE,
    month_col: str | None = "business_dt",
    categories: int = CATEGORIES,
) -> DataFrame:
    """Interest metrics of one month, a column per category and metric."""
    keys = ["regid", "app_n", key]
    values = range(1, categories + 1)
    rows = _month_of_interest(interest, logical_date, month_col)
    return category_matrix(rows, keys, "category_id", INTEREST_METRICS, values, shuffle_by=key)


def _month_of_interest(interest: DataFrame, logical_date: date, month_col: str | None) -> DataFrame:
    return interest if month_col is None else interest.where(F.col(month_col) == F.lit(month_end(logical_date)))


def interest_vectors(
    interest: DataFrame,
    logical_date: date,
    *,
    keys: Sequence[str] = (LINE,),
    month_col: str | None = "business_dt",
    categories: int = CATEGORIES,
) -> DataFrame:
    """:func:`host_interests` per line, over all its regions and applications, with one array in place of the matrix.

    ``keys`` may name finer keys too (``regid``, ``app_n``); ``merge_vectors``
    adds such rows up, also those of several months.
    """
    rows = _month_of_interest(interest, logical_date, month_col)
    return category_vectors(rows, keys, "category_id", list(INTEREST_METRICS), range(1, categories + 1), INTERESTS, shuffle_by=keys[0])


def mobile_mart(
    base: DataFrame,
    scores: DataFrame,
    contacts: DataFrame,
    moves: DataFrame,
    interests: DataFrame,
    logical_date: date,
    build_dt: date,
    *,
    key: str = LINE,
    categories: int = CATEGORIES,
) -> DataFrame:
    """All blocks per line, without nulls in numbers and texts.

    Missing numbers of the base become -1, those of the other blocks 0, and
    missing texts ``unk``. Interests of a line under several regions or
    applications are added up, so every line of the base keeps one row.

    ``interests`` are vectors (:func:`interest_vectors`), which stay one column
    until the finished row is spread, or a stored wide matrix
    (:func:`host_interests`), which has to be summed column by column.
    """
    sparse = INTERESTS in interests.columns
    if sparse:
        finer = [c for c in interests.columns if c not in (key, INTERESTS)]
        per_line = merge_vectors(interests, [key], INTERESTS) if finer else interests
    else:
        metrics = [c for c in interests.columns if c not in (*HISTORY_KEY, key)]
        per_line = interests.groupBy(key).agg(*[F.sum(c).alias(c) for c in metrics])
    # lines without a number stay null until after the joins, so that they don't meet in one task
    filled = fill_typed(base, num=-1, columns=[c for c in base.columns if c != key])
    blocks = [(b, [key]) for b in (scores, contacts, moves, per_line)]
    joined = fill_typed(assemble_known(filled, blocks), num=-1, columns=[key])
    dated = {"build_dt": build_dt, "table_business_month": month_start(logical_date).isoformat()}
    mart = fill_typed(joined, num=0, text="unk")
    if sparse:
        mart = spread_vectors(mart, INTERESTS, INTEREST_METRICS, range(1, categories + 1))
    return stamp(mart, dated)
