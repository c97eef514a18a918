"""Quality rules: counts of a text, and robust multivariate outliers, with built-in expressions only.

A minimum-covariance-determinant estimate is fitted per language and source to
statistics of the words of the texts that pass the base rule: the logarithms of their mean length and of
their spread in length, and the exponent of the distinct words in all words. (Symbols, repeated lines and windows are
zero in most texts, so no covariance can be estimated for them; they are counted and enter the base rule.)

Four starts (medians and quartile ranges, all rows, two seeded subsets) take two concentration steps: the
rows nearest to an estimate give the next mean and covariance. The start with the least determinant goes on until its
determinant stands still. Rows within its 97.5 percent ellipsoid give the reweighted estimate, whose distances are
scaled to the median of chi-square. Texts farther than a quantile of chi-square are rejected; word statistics have
heavier tails than a normal law, so the tail is small.

Texts are parsed once, to a narrow stored table; equal vectors of a group count once in the estimate, so that copies
can't make it collapse. A step is one aggregation of the distinct vectors by group and distance class, combined before
its shuffle; the window that finds the nearest rows sees classes, not rows, so a group may hold any share of
the corpus. Vectors are fixed-point integers, so that sums are exact and a
retried task gives the same estimate.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featuremart.llm.common import BLANKS, bind, checkpointed, group_key, small_enough, stored, text_of, word_list

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Fixed-point steps of a unit, and the classes of squared distance per factor e.
SCALE, CLASSES = 4096, 64
#: Statistics of a vector; each variance has at least this part of the variance over all groups added, a guard of the inverse.
P, GUARD = 3, 1e-3
#: Seeds of the starts from subsets, rows of a subset, steps of each start, and steps of the best one at most.
SEEDS, SUBSET, FIRST_STEPS, MOST_STEPS = (1, 2), 24, 2, 30
#: Estimates sent to every task (13 numbers each).
GROUPS_SENT = 20_000


def _repeated(words: Column) -> Column:
    """Words of the array that lie in a window found twice or more."""
    windows = F.when(F.size(words) > WINDOW, F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW)))).otherwise(F.array().cast("array<bigint>"))

    def covered(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

        def starts(s: Column) -> Column:
            same = lambda a, b: F.coalesce(a["x"] == b["x"], F.lit(False))
            twice = F.filter(s, lambda e, j: same(e, F.get(s, j - 1)) | same(e, F.get(s, j + 1)))
            return F.sort_array(F.transform(twice, lambda e: e["i"]))

        lengths = lambda p: F.transform(p, lambda v, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - v, F.lit(WINDOW))))
        total = lambda p: F.aggregate(lengths(p), F.lit(0).cast("bigint"), lambda a, x: a + x)
        return bind(placed, lambda s: bind(starts(s), total))

    return bind(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(covered(h)))


def text_counts(docs: DataFrame, text: str = "text") -> dict[str, Column]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of the whole text; a null text has none.

    ``_c`` has the words' number, repeats, distinct number and sum of squared lengths.
    """
    t = text_of(text)
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    squares = lambda w: F.aggregate(w, F.lit(0).cast("bigint"), lambda a, x: a + F.length(x).cast("bigint") * F.length(x))
    counted = bind(word_list(t), lambda w: F.struct(F.size(w).cast("bigint").alias("n"), _repeated(w).alias("r"), F.size(F.array_distinct(w)).cast("bigint").alias("k"), squares(w).alias("q")))
    return {
        "_c": counted,
        "word_chars": F.length(F.translate(t, BLANKS, "")).cast("bigint"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("bigint"),
        "n_dup_lines": bind(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint")),
    }


def _vector() -> list[Column]:
    """The transformed statistics of a text with two words or more, as integers."""
    n = F.col("n_words")
    mean = F.col("word_chars") / n
    spread = F.sqrt(F.greatest(F.col("square_chars") / n - mean * mean, F.lit(0.0)))
    return [F.round(x * SCALE).cast("bigint") for x in (F.log(mean), F.log1p(spread), F.log(F.col("n_distinct").cast("double")) / F.log(n.cast("double")))]


PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


def _medians(rows: DataFrame, guard: list[float]) -> DataFrame:
    """Medians, and a diagonal precision from the quartile ranges, per group."""
    long = rows.select("g", F.posexplode(F.array(*(F.col(f"x{i}") for i in range(P)))).alias("i", "v"))
    counts = long.groupBy("g", "i", "v").agg(F.count("*").alias("n"))
    whole = Window.partitionBy("g", "i")
    upto = F.sum("n").over(whole.orderBy("v"))
    ranked = counts.select("g", "i", "v", upto.alias("upto"), F.sum("n").over(whole).alias("all"))
    quartile = lambda q: F.min(F.when(F.col("upto") >= F.col("all") * q, F.col("v")))
    three = ranked.groupBy("g", "i").agg(quartile(0.25).alias("a"), quartile(0.5).alias("m"), quartile(0.75).alias("b"))
    pick = lambda i, name: F.max(F.when(F.col("i") == i, F.col(name)))
    wide = three.groupBy("g").agg(*(pick(i, c).alias(f"{c}{i}") for i in range(P) for c in "amb"))
    spread = lambda i: (F.col(f"b{i}") - F.col(f"a{i}")) / (1.349 * SCALE)
    cov = [(spread(i) * spread(i) + guard[i] if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in PAIRS]
    return _precision(wide.select("g", F.lit(0).alias("s"), *((F.col(f"m{i}") / SCALE).alias(f"m{i}") for i in range(P)), *cov))


def _distance() -> Column:
    """Squared distance to the estimate ``m*, w*`` in the same row."""
    d = [F.col(f"x{i}") / SCALE - F.col(f"m{i}") for i in range(P)]
    return reduce(lambda a, b: a + b, [F.col(f"w{i}{j}") * d[i] * d[j] * (1 if i == j else 2) for i in range(P) for j in range(i + 1)])


def _precision(df: DataFrame) -> DataFrame:
    """``w*`` and the log determinant ``ld`` from the covariance ``c*``, by Cholesky factor and its inverse."""
    for i in range(P):
        for j in range(i + 1):
            left = F.col(f"c{i}{j}") - sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
            df = df.withColumn(f"l{i}{j}", F.sqrt(left) if i == j else left / F.col(f"l{j}{j}"))
    for j in range(P):
        for i in range(j, P):
            top = F.lit(1.0) if i == j else -sum((F.col(f"l{i}{k}") * F.col(f"v{k}{j}") for k in range(j, i)), F.lit(0.0))
            df = df.withColumn(f"v{i}{j}", top / F.col(f"l{i}{i}"))
    whole = [sum((F.col(f"v{k}{i}") * F.col(f"v{k}{j}") for k in range(i, P)), F.lit(0.0)).alias(f"w{i}{j}") for i in range(P) for j in range(i + 1)]
    log_det = sum((2 * F.log(f"l{i}{i}") for i in range(P)), F.lit(0.0))
    return df.select("g", "s", *(f"m{i}" for i in range(P)), *whole, log_det.alias("ld"))


def _sums() -> list[Column]:
    return [F.count("*").alias("n"), *(F.sum(f"x{i}").alias(f"s{i}") for i in range(P)), *(F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{i}{j}") for i, j in PAIRS)]


NAMES = ["n", *(f"s{i}" for i in range(P)), *(f"q{i}{j}" for i, j in PAIRS)]


def _estimate(sums: DataFrame, factor: float, guard: list[float]) -> DataFrame:
    """Mean and precision from sums per group and start; ``factor`` multiplies the covariance."""
    mean = [F.col(f"s{i}") / F.col("n") for i in range(P)]
    cov = [((F.col(f"q{i}{j}") / F.col("n") - mean[i] * mean[j]) * (factor / SCALE**2) + (guard[i] if i == j else 0.0)).alias(f"c{i}{j}") for i, j in PAIRS]
    return _precision(sums.select("g", "s", *((mean[i] / SCALE).alias(f"m{i}") for i in range(P)), *cov))


def _classed(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    return rows.join(small_enough(estimate, 4 * GROUPS_SENT), "g").withColumn("d", F.floor(F.log1p(F.greatest(_distance(), F.lit(0.0))) * CLASSES))


def _first_class(counts: DataFrame, part: float, *names: str) -> DataFrame:
    """Running sums of ``n`` and ``names`` at the first distance class by which ``part`` of the rows are seen."""
    whole = Window.partitionBy("g", "s")
    upto = counts.select("g", "s", "d", F.sum("n").over(whole).alias("all"), *(F.sum(c).over(whole.orderBy("d")).alias(c) for c in ("n", *names)))
    return upto.where(F.col("n") >= part * F.col("all")).withColumn("k", F.row_number().over(whole.orderBy("d"))).where("k = 1")


def _concentrate(rows: DataFrame, estimate: DataFrame, part: float, guard: list[float]) -> DataFrame:
    """Mean and covariance of the nearest ``part`` of each group's rows, as the next estimate."""
    sums = _classed(rows, estimate).groupBy("g", "s", "d").agg(*_sums())
    return _estimate(_first_class(sums, part, *NAMES[1:]), consistency(part), guard)


def _least(estimates: DataFrame, *ties: str) -> DataFrame:
    """Per group the estimate with the least determinant."""
    order = Window.partitionBy("g").orderBy(F.round("ld", 9), *ties)
    return estimates.withColumn("_k", F.row_number().over(order)).where("_k = 1").drop("_k")


def minimum_determinant(rows: DataFrame, part: float) -> DataFrame:
    """The reweighted estimate of each group ``g`` of the stored vectors ``x*``: ``g, m*, w*``."""
    over_all = rows.agg(*(F.coalesce(F.var_pop(f"x{i}"), F.lit(0.0)).alias(f"v{i}") for i in range(P))).first()
    guard = [max(GUARD * over_all[f"v{i}"] / SCALE**2, 1e-6) for i in range(P)]
    # starts; a seeded subset is found by a limit within each task before its shuffle
    drawn = rows.withColumn("s", F.explode(F.array(*(F.lit(2 + k) for k in range(len(SEEDS))))))
    key = F.xxhash64("g", *(f"x{i}" for i in range(P)), F.element_at(F.array(*map(F.lit, SEEDS)), F.col("s") - 1))
    drawn = drawn.withColumn("_k", F.row_number().over(Window.partitionBy("g", "s").orderBy(key, *(f"x{i}" for i in range(P))))).where(F.col("_k") <= SUBSET)
    sums = rows.withColumn("s", F.lit(1)).groupBy("g", "s").agg(*_sums()).union(drawn.groupBy("g", "s").agg(*_sums()))
    best = checkpointed(_medians(rows, guard).union(_estimate(sums, 1.0, guard)))
    for _ in range(FIRST_STEPS):
        best = checkpointed(_concentrate(rows, best, part, guard))
    best = checkpointed(_least(best, "s"))
    for _ in range(MOST_STEPS):
        both = best.withColumn("age", F.lit(0)).union(_concentrate(rows, best, part, guard).withColumn("age", F.lit(1)))
        best = checkpointed(_least(both, "age"))
        moved = best.where("age = 1").count()
        best = best.drop("age")
        if not moved:
            break
    inner = rows.join(small_enough(best, GROUPS_SENT), "g").where(_distance() <= chi_quantile(0.025))
    best = checkpointed(_estimate(inner.groupBy("g", "s").agg(*_sums()), consistency(0.975), guard))
    middle = _first_class(_classed(rows, best).groupBy("g", "s", "d").agg(F.count("*").alias("n")), 0.5)
    scale = F.lit(chi_quantile(0.5)) / F.expm1((F.col("d") + 0.5) / CLASSES)
    scaled = best.join(middle.select("g", scale.alias("_scale")), "g")
    return checkpointed(scaled.select("g", *(f"m{i}" for i in range(P)), *((F.col(f"w{i}{j}") * F.col("_scale")).alias(f"w{i}{j}") for i, j in PAIRS)))


def chi_tail(x: float, degrees: int = P) -> float:
    """Upper tail of chi-square with an odd number of degrees of freedom."""
    tail = math.erfc(math.sqrt(x / 2))
    for k in range(1, degrees, 2):
        tail += (x / 2) ** (k / 2) * math.exp(-x / 2) / math.gamma(k / 2 + 1)
    return tail


def chi_quantile(tail: float) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_tail(mid) > tail else (lo, mid)
    return lo


def consistency(part: float) -> float:
    """What the covariance of the nearest ``part`` is too small by, for normal rows in P dimensions."""
    return part / (1 - chi_tail(chi_quantile(1 - part), P + 2))


def quality_rules(
    docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", part: float = 0.6, tail: float = 1e-8, least: int = 50
) -> DataFrame:
    """Counts, ``base_failed``, squared ``distance`` and ``kept`` per document.

    ``base_failed``: fewer than 20 words, or over 30 of 100 words in repeated
    8-word windows. Cells of language and source with fewer than ``least`` passing texts are estimated
    together with the other small ones of their language, and those with fewer than ``least`` then all together; if even
    those are fewer there is no estimate, ``distance`` is null and the base rule alone decides. Null languages and sources are
    values of their own; null, empty and word-free texts fail the base rule; repeated rows are judged
    alike. Extra columns are ignored.
    """
    counts = text_counts(docs, text)
    narrow = docs.select(F.col(id).alias("doc_id"), group_key([lang]).alias("tongue"), group_key([lang, source]).alias("cell"), *(c.alias(k) for k, c in counts.items()))
    narrow = narrow.select(
        "doc_id", "tongue", "cell", F.col("_c.n").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", F.col("_c.r").alias("n_repeat_words"),
        F.col("_c.k").alias("n_distinct"), F.col("_c.q").alias("square_chars"),
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    narrow = stored(narrow.withColumn("base_failed", failed), "quality-counts")

    passing = narrow.where(~F.col("base_failed"))
    sizes = checkpointed(passing.groupBy("tongue", "cell").count().withColumn("own", F.col("count") >= least))
    rest = Window.partitionBy("tongue", "own")
    group = F.when(F.col("own"), F.concat(F.lit("c"), "cell")).when(F.sum("count").over(rest) >= least, F.concat(F.lit("l"), "tongue")).otherwise(F.lit(""))
    groups = checkpointed(sizes.select("cell", group.alias("g"), "count"))
    large = groups.groupBy("g").agg(F.sum("count").alias("n")).where(F.col("n") >= least).select("g")
    placed = narrow.join(small_enough(groups.select("cell", "g"), GROUPS_SENT), "cell", "left").drop("cell", "tongue")
    vector = [F.when(~F.col("base_failed"), x).alias(f"x{i}") for i, x in enumerate(_vector())]
    placed = placed.select("*", *vector).drop("n_distinct", "square_chars")
    rows = placed.where(~F.col("base_failed")).select("g", *(f"x{i}" for i in range(P))).distinct()
    rows = stored(rows.join(small_enough(checkpointed(large), GROUPS_SENT), "g"), "quality-vectors")
    estimate = minimum_determinant(rows, part)
    judged = placed.join(small_enough(estimate, GROUPS_SENT), "g", "left").withColumn("distance", _distance())
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= chi_quantile(tail), F.lit(True))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "distance")

