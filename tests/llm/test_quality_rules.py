"""The robust estimate against a plain one with many starts."""

import numpy as np
import pytest

from featuremart.llm import quality_rules as q


def plain_estimate(x, part, starts=60, seed=0):
    """Least determinant over many random starts, exact nearest rows, reweighted and scaled to the median."""
    rng, size, best = np.random.default_rng(seed), int(np.ceil(part * len(x))), (np.inf, None, None)
    for _ in range(starts):
        idx, last = rng.choice(len(x), 8, replace=False), np.inf
        for _ in range(60):
            mean, cov = x[idx].mean(0), np.cov(x[idx].T, bias=True) + 1e-9 * np.eye(x.shape[1])
            now = np.linalg.slogdet(cov)[1]
            if len(idx) == size and now >= last - 1e-12:
                break
            last = now if len(idx) == size else np.inf
            idx = np.argsort(distance(x, mean, cov), kind="stable")[:size]
        if last < best[0]:
            best = (last, mean, cov * q.consistency(part))
    inner = x[distance(x, *best[1:]) <= q.chi_quantile(0.025)]
    mean, cov = inner.mean(0), np.cov(inner.T, bias=True) * q.consistency(0.975)
    return distance(x, mean, cov) * q.chi_quantile(0.5) / np.median(distance(x, mean, cov))


def distance(x, mean, cov):
    return np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)


def vectors(n, seed):
    """Correlated vectors, and a fifth as many that no statistic alone shows: they leave the common line."""
    rng = np.random.default_rng(seed)
    cov = np.array([[1, 0.97, 0.3], [0.97, 1, 0.3], [0.3, 0.3, 1]]) * 0.04
    good = rng.multivariate_normal([1.6, 0.9, 0.8], cov, n)
    bad = rng.multivariate_normal([0, 0, 0], 0.0004 * np.eye(3), n // 5) + [1.6 + 0.25, 0.9 - 0.25, 0.8]
    return np.rint(np.r_[good, bad] * q.SCALE).astype(int), np.r_[np.zeros(n, bool), np.ones(n // 5, bool)]


@pytest.fixture(scope="module")
def judged(spark):
    groups = {"a": vectors(900, 1), "b": vectors(300, 2)}
    rows = [(g, *map(int, v)) for g, (x, _) in groups.items() for v in x]
    frame = spark.createDataFrame(rows, "g string, x0 bigint, x1 bigint, x2 bigint")
    estimate = {r["g"]: r for r in q.minimum_determinant(frame, 0.6).collect()}
    out = {}
    for g, (x, bad) in groups.items():
        e = estimate[g]
        w = np.array([[e[f"w{max(i, j)}{min(i, j)}"] for j in range(q.P)] for i in range(q.P)])
        d = x / q.SCALE - [e[f"m{i}"] for i in range(q.P)]
        out[g] = np.einsum("ij,jk,ik->i", d, w, d), plain_estimate(x / q.SCALE, 0.6), bad, x
    return out


@pytest.mark.parametrize("group", ["a", "b"])
def test_verdicts_equal_the_plain_version(judged, group):
    got, want, _, _ = judged[group]
    limit = q.chi_quantile(1e-3)
    clear = np.abs(np.log(want / limit)) > 0.25  # classes of distance in place of exact ranks
    assert clear.mean() > 0.97 and ((got > limit) == (want > limit))[clear].all()
    assert np.corrcoef(np.log1p(got), np.log1p(want))[0, 1] > 0.995


@pytest.mark.parametrize("group", ["a", "b"])
def test_outliers_that_no_statistic_shows(judged, group):
    got, _, bad, x = judged[group]
    z = np.abs(x - np.median(x, 0)) / (0.2 * q.SCALE)
    assert (z[bad].max(1) < 2).mean() > 0.99
    assert (got[bad] > q.chi_quantile(1e-8)).all() and (got[~bad] > q.chi_quantile(1e-8)).mean() < 0.01
    assert abs(np.median(got[~bad]) - q.chi_quantile(0.5)) < 0.7


def test_copies_and_equal_vectors(spark):
    """Thousands of copies leave the estimate as it is; texts that are all equal are kept."""
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcdefghij"), rng.integers(1, 10)))
    texts = [" ".join(word() for _ in range(rng.integers(60, 300))) for _ in range(150)]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    docs = lambda r: spark.createDataFrame(r, "doc_id bigint, text string, lang string, source string")
    alone = {r.doc_id: (r.kept, r.distance) for r in q.quality_rules(docs(rows)).collect()}
    crowd = rows + [(1000 + i, texts[0], "en", "s") for i in range(2000)]
    among = {r.doc_id: (r.kept, r.distance) for r in q.quality_rules(docs(crowd)).collect()}
    assert all(among[i] == alone[i] for i in alone) and sum(k for k, _ in alone.values()) >= 148
    same = q.quality_rules(docs([(i, texts[0], None, "s") for i in range(80)])).collect()
    assert len(same) == 80 and all(r.kept for r in same)
