"""Confusion matrix and lift table of a scored table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featuremart.operators.ranking import global_row_number
from featuremart.sources.storage import checkpoint_dir


def confusion(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Two rows, actual positives and negatives, by predicted class; a missing score is negative."""
    positive = F.col(label) == 1
    predicted = F.coalesce(F.col(score) > threshold, F.lit(False))

    def cell(actual: Column, pred: Column) -> Column:
        return F.count_if(actual & pred)

    counts = df.agg(
        F.array(
            F.struct(
                F.lit("act_POS").alias("actual"),
                cell(positive, predicted).alias("pred_POS"),
                cell(positive, ~predicted).alias("pred_NEG"),
            ),
            F.struct(
                F.lit("act_NEG").alias("actual"),
                cell(~positive, predicted).alias("pred_POS"),
                cell(~positive, ~predicted).alias("pred_NEG"),
            ),
        ).alias("rows")
    )
    return counts.select(F.inline("rows"))


def lift_table(
    df: DataFrame,
    label: str,
    score: str,
    key: Sequence[str],
    n: int = 10,
    *,
    unique: bool = False,
) -> DataFrame:
    """Lift by equal-sized buckets of descending score.

    The first ``rows % n`` buckets hold one row more than the others. Equal
    scores are ordered by ``key``; say ``unique`` if it identifies a row.
    """
    narrow = df.select(*key, F.col(label).cast("long").alias("_label"), F.col(score).alias("_score"))
    ranked = global_row_number(narrow, [F.col("_score").desc(), *key], "_rank", unique=unique)
    total = narrow.agg(F.count("*").alias("n")).scalar()
    sized = ranked.withColumn("_size", F.floor(total / n)).withColumn("_extra", total % n)
    # rank of the last row in the longer buckets
    edge = F.col("_extra") * (F.col("_size") + 1)
    rank0 = F.col("_rank") - 1
    top = F.when(F.col("_rank") <= edge, F.floor(rank0 / (F.col("_size") + 1)) + 1).otherwise(
        F.col("_extra") + F.floor(F.try_divide(rank0 - edge, F.col("_size"))) + 1
    )
    buckets = sized.groupBy(top.cast("int").alias("top")).agg(
        F.sum("_label").alias("target_cnt"), F.count("*").alias("cnt")
    )
    return _lifts(buckets)


def _lifts(buckets: DataFrame) -> DataFrame:
    """Cumulative counts, shares and lift of ``top, target_cnt, cnt``."""
    # the windows see one row per bucket
    upto = Window.orderBy("top").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy()
    share = F.sum("target_cnt").over(whole) / F.sum("cnt").over(whole)
    return (
        buckets.withColumns(
            {
                "target_cnt_cum": F.sum("target_cnt").over(upto),
                "cnt_cum": F.sum("cnt").over(upto),
                "_share": share,
                "_targets": F.sum("target_cnt").over(whole),
            }
        )
        .withColumns(
            {
                "target_share": F.col("target_cnt") / F.col("cnt"),
                "target_share_cum": F.col("target_cnt_cum") / F.col("cnt_cum"),
            }
        )
        .withColumns(
            {
                "lift": F.try_divide("target_share", "_share"),
                "cum_lift": F.try_divide("target_share_cum", "_share"),
                "coverage": F.try_divide("target_cnt_cum", "_targets"),
            }
        )
        .drop("_share", "_targets")
    )


#: Size of a score sketch. Ranks read from it are off by about 2.3 / size^0.9 of the rows: 0.13 % here.
SKETCH_SIZE = 4096


def score_sketches(df: DataFrame, label: str, score: str, by: Sequence[str] = (), size: int = SKETCH_SIZE) -> DataFrame:
    """Scores and scores of positives as quantile sketches, one small row per group: one read, no sort.

    Stored per month or per scoring run, they are added up by
    :func:`merge_score_sketches`. Rows without a score are left out; NaN is not a score.
    """
    value = F.nanvl(F.col(score).cast("double"), F.lit(None).cast("double"))
    positive = F.when(F.col(label) == 1, value)
    return df.groupBy(*by).agg(
        F.count(value).alias("cnt"),
        F.count(positive).alias("target_cnt"),
        F.kll_sketch_agg_double(value, F.lit(size)).alias("scores"),
        F.kll_sketch_agg_double(positive, F.lit(size)).alias("target_scores"),
    )


def merge_score_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of disjoint rows added up."""
    held = lambda c, n: F.when(F.col(n) > 0, F.col(c))
    return sketches.groupBy(*by).agg(
        F.sum("cnt").alias("cnt"),
        F.sum("target_cnt").alias("target_cnt"),
        F.kll_merge_agg_double(held("scores", "cnt")).alias("scores"),
        F.kll_merge_agg_double(held("target_scores", "target_cnt")).alias("target_scores"),
    )


def lift_from_sketches(sketches: DataFrame, n: int = 10) -> DataFrame:
    """:func:`lift_table` of the one row that :func:`merge_score_sketches` gives, without a sort of the rows.

    Borders are score quantiles, so equal scores stay in one bucket, and buckets
    without a score are left out. Up to the sketch's size nothing is estimated;
    beyond it, counts are off by at most the stated share of the rows.
    """
    checkpoint_dir(sketches.sparkSession)
    whole = sketches.checkpoint()
    ranks = F.array(*[F.lit(1 - i / n) for i in range(1, n)])
    found = whole.where("cnt > 0").select(F.kll_sketch_get_quantile_double("scores", ranks)).first() if n > 1 else None
    borders = list(dict.fromkeys(found[0])) if found else []

    def above(sketch: str, count: str):
        # rows above each border; after the last one all
        shares = F.kll_sketch_get_rank_double(sketch, F.array(*map(F.lit, borders))) if borders else F.array().cast("array<double>")
        rows = F.transform(shares, lambda share: F.round(F.col(count) * (1 - share)).cast("long"))
        none = F.array(*[F.lit(0).cast("long")] * len(borders)) if borders else F.array().cast("array<long>")
        return F.concat(F.when(F.col(count) > 0, rows).otherwise(none), F.array(F.col(count)))

    cumulated = whole.where("cnt > 0").select(F.posexplode(F.arrays_zip(above("target_scores", "target_cnt").alias("t"), above("scores", "cnt").alias("c"))))
    upto = cumulated.select("pos", "col.t", "col.c")
    before = Window.orderBy("pos")
    step = lambda c: F.col(c) - F.coalesce(F.lag(c).over(before), F.lit(0))
    buckets = upto.select("pos", step("t").alias("target_cnt"), step("c").alias("cnt")).where("cnt > 0")
    return _lifts(buckets.select(F.row_number().over(before).alias("top"), "target_cnt", "cnt"))
