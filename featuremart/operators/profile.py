"""Column profiles and feature selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

METRICS = ("n_unique", "fill_rate", "top_1_share")


def column_profile(df: DataFrame, columns: Sequence[str] | None = None, *, approx: bool = False) -> DataFrame:
    """Distinct values, share of filled rows and share of the top value among them.

    All columns are profiled in one read. Values are compared by a 64-bit hash, so
    what is shuffled is the column's number and the hash, and equal values are
    counted before it: a value that fills a third of a column costs one row per
    task. With ``approx`` nothing is shuffled but one row of sketches per task;
    distinct values and the top share are then estimates, the filled share is exact.
    """
    names = list(columns or df.columns)
    name = F.element_at(F.array(*[F.lit(c) for c in names]), F.col("i") + 1).alias("column")
    hashes = [F.when(F.col(f"`{c}`").isNotNull(), F.xxhash64(F.col(f"`{c}`"))) for c in names]
    if approx:
        return _estimates(df, names, hashes)
    cells = F.array(*[F.struct(F.lit(i).alias("i"), h.alias("h")) for i, h in enumerate(hashes)])
    counts = df.select(F.inline(cells)).groupBy("i", "h").agg(F.count("*").alias("n"))
    filled = F.when(F.col("h").isNotNull(), F.col("n"))
    out = counts.groupBy("i").agg(
        F.count("h").alias("n_unique"),
        (F.coalesce(F.sum(filled), F.lit(0)) / F.sum("n")).alias("fill_rate"),
        F.coalesce(F.max(filled) / F.sum(filled), F.lit(0.0)).alias("top_1_share"),
    )
    return out.select(name, *METRICS)


def _estimates(df: DataFrame, names: Sequence[str], hashes: Sequence[Column]) -> DataFrame:
    numbered = df.select(*[h.alias(f"h{i}") for i, h in enumerate(hashes)])
    one = numbered.agg(
        F.count("*").alias("rows"),
        *[
            F.struct(
                F.approx_count_distinct(f"h{i}").alias("u"), F.count(f"h{i}").alias("f"), F.expr(f"approx_top_k(h{i}, 1)").alias("t")
            ).alias(f"m{i}")
            for i in range(len(names))
        ],
    )
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("m"), F.col("rows").alias("rows")) for i, c in enumerate(names)]
    long = one.where("rows > 0").select(F.inline(F.array(*cells)))
    top = F.coalesce(F.get("m.t", F.lit(0))["count"], F.lit(0))
    return long.select(
        "column",
        F.col("m.u").alias("n_unique"),
        (F.col("m.f") / F.col("rows")).alias("fill_rate"),
        F.coalesce(F.try_divide(top, F.col("m.f")), F.lit(0.0)).alias("top_1_share"),
    )


#: Values that a sketch of frequent ones tracks; with fewer distinct values its counts are exact.
TRACKED = 1000


def profile_sketches(df: DataFrame, by: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """One row of sketches per group and column, for :func:`merge_profiles`: one read, a few kilobytes a row.

    ``by`` is what the profiles are kept by, such as the month. Rows and filled rows are counted
    exactly, distinct and frequent values are sketched over their 64-bit hashes.
    """
    names = list(columns or [c for c in df.columns if c not in by])
    hashes = [F.when(F.col(f"`{c}`").isNotNull(), F.xxhash64(F.col(f"`{c}`"))).alias(f"h{i}") for i, c in enumerate(names)]
    metrics = [
        F.struct(
            F.lit(c).alias("column"), F.count("*").alias("rows"), F.count(f"h{i}").alias("filled"), F.hll_sketch_agg(f"h{i}").alias("distinct"),
            F.expr(f"approx_top_k_accumulate(h{i}, {TRACKED}) filter (where h{i} is not null)").alias("frequent"),
        ).alias(f"m{i}")
        for i, c in enumerate(names)
    ]
    wide = df.select(*by, *hashes).groupBy(*by).agg(*metrics)
    return wide.select(*by, F.inline(F.array(*[f"m{i}" for i in range(len(names))])))


def merge_profiles(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of disjoint rows added up per column, and per ``by``."""
    return sketches.groupBy(*by, "column").agg(
        F.sum("rows").alias("rows"),
        F.sum("filled").alias("filled"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.expr(f"approx_top_k_combine(frequent, {TRACKED})").alias("frequent"),
    )


def profile_of(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The metrics of :func:`column_profile` from sketches; groups without rows have none."""
    top = F.expr("approx_top_k_estimate(case when filled > 0 then frequent end, 1)")
    return sketches.where("rows > 0").select(
        *by,
        "column",
        F.hll_sketch_estimate("distinct").alias("n_unique"),
        (F.col("filled") / F.col("rows")).alias("fill_rate"),
        F.coalesce(F.try_divide(F.get(top, F.lit(0))["count"], F.col("filled")), F.lit(0.0)).alias("top_1_share"),
    )


def profile_drift(profiles: DataFrame, by: str) -> DataFrame:
    """How each metric of a column differs from the group before, in the order of ``by``; the first group is left out."""
    before = Window.partitionBy("column").orderBy(by)
    change = [(F.col(m) - F.lag(m).over(before)).alias(f"{m}_change") for m in METRICS]
    return profiles.select(by, "column", *change).where(f"{METRICS[0]}_change is not null")


def metric_rows(profile: DataFrame) -> DataFrame:
    """The profile in long form: column, metric, value."""
    wide = profile.select("column", *[F.col(m).cast("double").alias(m) for m in METRICS])
    return wide.unpivot("column", list(METRICS), "metric", "value")


def metric_pivot(df: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """Long metrics to one row per column; repeated entries are averaged."""
    return df.groupBy("column").pivot("metric", list(metrics)).agg(F.avg("value"))


def select_features(
    profile: DataFrame,
    *,
    min_unique: int = 2,
    min_fill: float = 0.8,
    max_top: float = 0.9,
    exclude: Sequence[str] = ("app_n", "regid"),
) -> DataFrame:
    """Names of the columns that vary, are filled and are not dominated by one value."""
    keep: Column = (
        (F.col("n_unique") >= min_unique)
        & (F.col("fill_rate") >= min_fill)
        & (F.col("top_1_share") <= max_top)
    )
    return profile.where(keep & ~F.col("column").isin(list(exclude))).select("column")


def feature_types(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, tuple[str, str]]:
    """``{column: (dtype, 'cat' or 'num')}``; strings are categorical."""
    wanted = set(columns or df.columns)
    return {c: (t, "cat" if t == "string" else "num") for c, t in df.dtypes if c in wanted}


def _typed(names: DataFrame, types: Mapping[str, tuple[str, str]], key: str) -> DataFrame:
    rows = [(c, dtype, kind) for c, (dtype, kind) in types.items()]
    spark = names.sparkSession
    table = spark.createDataFrame(rows, f"{key} string, dtype string, type string")
    return names.join(F.broadcast(table), key, "left")


def feature_catalog(df: DataFrame, selected: DataFrame) -> DataFrame:
    """The selected columns of ``df`` with data type and ``cat``/``num`` kind."""
    names = selected.select(F.col("column").alias("feature_name"))
    return _typed(names, feature_types(df), "feature_name")


def null_profile(df: DataFrame) -> DataFrame:
    """Filled rows and data type per column."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    long = counts.unpivot([], list(counts.columns), "name", "non_null_cnt")
    types = {c: (t, "") for c, t in df.dtypes}
    return _typed(long, types, "name").drop("type")
