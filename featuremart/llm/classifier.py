"""Quality classifier: a generalised additive model with pairwise interactions.

Features of a text are put into bins. Boosting goes round the features in a cycle: each
step fits a shallow tree of one feature to the current residuals and adds it to that
feature's lookup table, slowly, so that the order of features does not
matter. Then the pairs of features whose joint histogram explains most of
what is left get two-dimensional tables in the same way. A score is the
logistic function of the sum of one table entry per feature and pair.

The model is fitted on the driver from a bounded sample of labelled rows. Features are
built-in expressions; scoring looks up bins and adds table entries for whole
batches of numbers, and no text leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremart.llm.common import BLANKS, bind, remainder, text_of, word_list

#: Labelled rows that are used at most; those with the smallest hash of their id.
SAMPLE_ROWS = 20_000
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


NAMES = ("length", "word_length", "longest", "distinct", "line_words", "line_repeats", "capitals", "digits", "stops", "shouts", "symbols", "blanks")


def features(text: str = "text") -> Column:
    """Numbers that describe a whole text, as an array in the order of ``NAMES``; an empty or null text has zeros."""
    t = text_of(text)
    share = lambda chars: (F.length(t) - F.length(F.translate(t, chars, ""))) / F.greatest(F.length(t), F.lit(1))
    longest = lambda w: F.coalesce(F.array_max(F.transform(w, F.length)), F.lit(0))
    words = bind(word_list(t), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d"), longest(w).alias("m")))
    lines = bind(F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != ""), lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d")))

    def numbers(x: Column) -> Column:
        w, line = x["w"], x["l"]
        count, rows = F.greatest(w["n"], F.lit(1)), F.greatest(line["n"], F.lit(1))
        out = (
            F.log1p(w["n"]),
            x["c"] / count,
            F.log1p(w["m"]),
            w["d"] / count,
            F.log1p(w["n"] / rows),
            (line["n"] - line["d"]) / rows,
            share(LETTERS),
            share("0123456789"),
            share(".,;:?"),
            share("!"),
            share("#*$%&|<>@^~_=+/\\{}[]"),
            share(BLANKS),
        )
        return F.array(*(v.cast("double") for v in out))

    return bind(F.struct(words.alias("w"), lines.alias("l"), F.length(F.translate(t, BLANKS, "")).alias("c")), numbers)


@dataclass
class Model:
    """Bin edges, one table per feature, coarse edges and tables of pairs, and the intercept."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def logit(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for i, (e, t) in enumerate(zip(self.edges, self.tables, strict=True)):
            out += t[np.searchsorted(e, x[:, i], side="right")]
        if self.pairs:
            bins = [np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(self.coarse)]
            for a, b, t in self.pairs:
                out += t[bins[a], bins[b]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def _quantiles(v: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(v, np.arange(1, bins) / bins)) if len(v) else np.empty(0)


def _gain(g, h, ridge):
    return g * g / (h + ridge)


def _cut(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, int]:
    """Best place to cut a row of bins in two, and what it gains."""
    if len(g) < 2:
        return 0.0, 0
    a, b = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gains = _gain(a, b, ridge) + _gain(g.sum() - a, h.sum() - b, ridge) - _gain(g.sum(), h.sum(), ridge)
    k = int(np.argmax(gains))
    return float(gains[k]), k + 1


def _leaf(g, h, ridge):
    return g.sum() / (h.sum() + ridge)


def _tree(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    """A tree of depth two over the bins of one feature: its value in each bin."""
    out = np.full(len(g), _leaf(g, h, ridge))
    _, k = _cut(g, h, ridge)
    for lo, hi in ((0, k), (k, len(g))):
        if hi > lo:
            _, m = _cut(g[lo:hi], h[lo:hi], ridge)
            for a, b in ((lo, lo + m), (lo + m, hi)):
                if b > a:
                    out[a:b] = _leaf(g[a:b], h[a:b], ridge)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    """One cut on a feature, then one on the other in each half; the better of both orders."""

    def rows_first(g, h):
        _, k = _cut(g.sum(1), h.sum(1), ridge)
        out, total = np.zeros(g.shape), 0.0
        for lo, hi in ((0, k), (k, len(g))):
            if hi > lo:
                gain, m = _cut(g[lo:hi].sum(0), h[lo:hi].sum(0), ridge)
                total += gain
                for a, b in ((0, m), (m, g.shape[1])):
                    if b > a:
                        out[lo:hi, a:b] = _leaf(g[lo:hi, a:b], h[lo:hi, a:b], ridge)
        return total, out

    one, other = rows_first(g, h), rows_first(g.T, h.T)
    return one[1] if one[0] >= other[0] else other[1].T


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 120, rate: float = 0.15, bins: int = 32, pair_bins: int = 8, pairs: int = 6, pair_rounds: int = 40, ridge: float = 5.0) -> Model:
    """The model of 0/1 labels ``y``. Without rows, or with one label only, a constant."""
    n = len(y)
    mean = (y.sum() + 1) / (n + 2)
    edges = [_quantiles(x[:, i], bins) for i in range(x.shape[1])]
    model = Model(float(np.log(mean / (1 - mean))), edges, [np.zeros(len(e) + 1) for e in edges])
    if n == 0 or y.min() == y.max():
        return model
    logit = np.full(n, model.base)
    binned = [np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(edges)]

    def residuals():
        p = 1 / (1 + np.exp(-logit))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for b, t in zip(binned, model.tables, strict=True):
            r, w = residuals()
            step = rate * _tree(np.bincount(b, r, len(t)), np.bincount(b, w, len(t)), ridge)
            t += step
            logit += step[b]
    model.coarse = [_quantiles(x[:, i], pair_bins) for i in range(x.shape[1])]
    coarse = [np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(model.coarse)]
    sizes = [len(e) + 1 for e in model.coarse]

    def joint(a, b, v):
        return np.bincount(coarse[a] * sizes[b] + coarse[b], v, sizes[a] * sizes[b]).reshape(sizes[a], sizes[b])

    r, w = residuals()
    found = [(_gain(joint(a, b, r), joint(a, b, w), ridge).sum(), a, b) for a in range(len(sizes)) for b in range(a + 1, len(sizes))]
    model.pairs = [(a, b, np.zeros((sizes[a], sizes[b]))) for _, a, b in sorted(found, reverse=True)[:pairs]]
    for _ in range(pair_rounds):
        for a, b, t in model.pairs:
            r, w = residuals()
            step = rate * _pair_tree(joint(a, b, r), joint(a, b, w), ridge)
            t += step
            logit += step[coarse[a], coarse[b]]
    return model


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", rows: int = SAMPLE_ROWS, folds: int = 5) -> Model:
    """A model of the labelled documents outside the held-out fold (crc32 of the id modulo ``folds`` is 0).

    At most ``rows`` labelled ids are used, those with the smallest hash. An id
    with several labels has the smallest, an id with several texts the least vector of
    features; null ids and labels are left out.
    """
    known = labels.where(F.col(id).isNotNull() & F.col(label).isNotNull()).where(remainder(id, folds) != 0)
    known = known.groupBy(F.col(id).alias("_id")).agg(F.min(label).alias("_y"))
    used = known.orderBy(F.xxhash64(F.col("_id").cast("bigint"), F.lit(11)), "_id").limit(rows)
    one = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(used), "_id")
    seen = one.select("_id", features("_text").alias("_x"), "_y").groupBy("_id").agg(F.min("_x").alias("_x"), F.min("_y").alias("_y"))
    seen = seen.toPandas().sort_values("_id", kind="stable")  # at most ``rows`` rows
    x = np.stack(seen["_x"].to_numpy()) if len(seen) else np.empty((0, len(NAMES)))
    order = np.lexsort((*x.T[::-1], seen["_id"].to_numpy(np.int64)))
    return fit(x[order].astype(float), seen["_y"].to_numpy(float)[order])


def classify(docs: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in ``score`` (replaced if there); every row is kept."""
    docs = docs.drop(score)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in batches:
            yield pd.Series(model.score(np.stack(x.to_numpy())) if len(x) else [], dtype=float)

    return docs.withColumn(score, F.pandas_udf(run, "double")(features(text)))
