"""Periodic runs against a search of all periods."""

import hashlib
import random
import zlib

import pytest

from featuremart.llm import periodic
from featuremart.llm.common import table
from featuremart.llm.queries import QUERIES

import brute

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, runs int, collapsed int, _both string, s string"


def plain_runs(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        equal = [words[i] == words[i + q] for i in range(n - q)] + [False]
        start = 0
        for i, same in enumerate(equal):
            if not same:
                length = i + q - start
                if length >= max(6, 4 * q):
                    run = words[start : start + length]
                    if not any(all(run[j] == run[j + s] for j in range(length - s)) for s in range(1, q)):
                        out.append((start, length, q))
                start = i + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def plain_planted(i, text):
    words, h = brute.words(text), zlib.crc32(("" if i is None else str(i)).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[j] if j < a else words[a + (j - a) % p] for j in range(n)]


def noise(rnd):
    """Words of few letters with nested repetitions."""
    words = [rnd.choice("abc") for _ in range(rnd.randrange(1, 9))]
    for _ in range(rnd.randrange(7)):
        cut = rnd.randrange(len(words) + 1)
        words = words[:cut] + words[cut:] * rnd.randrange(1, 6) + [rnd.choice("abcd") for _ in range(rnd.randrange(3))]
        if len(words) > 400:
            break
    return words[:400]


def test_random_words():
    rnd, found = random.Random(3), 0
    documents = [noise(rnd) for _ in range(1500)] + [[], ["a"], ["a"] * 5, ["a"] * 6, ["a", "b"] * 4, ["a", "b"] * 3 + ["a"]]
    coded = [[w.encode() for w in d] for d in documents]
    for d, c, runs in zip(documents, coded, periodic.find_runs(coded)):
        want = plain_runs(d)
        assert runs == want
        assert periodic.collapse(c, runs).decode() == plain_collapse(d, want)
        found += len(want)
    assert found > 1000 and periodic.find_runs([]) == []


def test_long_periods():
    rnd = random.Random(5)
    for period in (2, 3, 4, 7, 8, 31, 64, 100, 333):
        block = [f"w{rnd.randrange(5)}".encode() for _ in range(period)]
        words = [b"x", *(block * 5)[: 4 * period + period // 2], b"y"]
        (runs,) = periodic.find_runs([words])
        assert max(runs, key=lambda r: r[1])[0] <= 1 and runs == plain_runs(words)


def test_many_occurrences_stay_linear():
    """A word that fills a text gives one seed a place, not all pairs, and is extended once."""
    words = [b"a"] * 300_000 + [b"b", b"a"] * 50_000
    (runs,) = periodic.find_runs([words])
    # the first run of b a begins with the last a of the run before
    assert runs == [(0, 300_000, 1), (299_999, 100_001, 2)]


def test_query(spark):
    docs = {r.doc_id: r.text for r in table(spark, SMALL, "documents").collect()}
    rows = QUERIES["op12_periodic_runs"](spark, SMALL).collect()
    assert len(rows) == len(docs) and sum(r.n_runs > 0 for r in rows) > 5
    for r in rows:
        words = plain_planted(r.doc_id, docs[r.doc_id])
        runs = plain_runs(words)
        assert r.n_runs == len(runs)
        best = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=(None,) * 3)
        assert (r.start, r.length, r.period) == best and r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(plain_collapse(words, runs).encode()).hexdigest()


def test_edges(spark):
    texts = [(1, None), (2, ""), (3, " \n\t\x0b"), (4, "a b " * 5), (4, "a b " * 5), (None, "é é é é é é"), (5, "x " * 100_000), (6, "a\x1ca a a a a a a"), (7, "a\x85 " * 3)]
    df = spark.createDataFrame([(i, t, 1, 2, "b", "s") for i, t in texts], SCHEMA)
    rows = sorted(((r.doc_id or 0, [tuple(x) for x in r.runs], r.collapsed, r._both, r.s) for r in periodic.periodic_runs(df).collect()), key=str)
    want = []
    for i, t in texts:
        words = brute.words(t)
        runs = plain_runs(words) if i != 5 else [(0, 100_000, 1)]
        want.append((i or 0, runs, plain_collapse(words, runs), "b", "s"))
    assert rows == sorted(want, key=str)
    assert periodic.periodic_runs(df.where("doc_id < 0")).count() == 0


@pytest.mark.parametrize("runs, best", [([(0, 8, 2), (9, 12, 3), (30, 4, 1)], (0, 8, 2)), ([(5, 9, 2), (8, 5, 1)], (8, 5, 1)), ([], None)])
def test_strongest(spark, runs, best):
    df = spark.createDataFrame([(runs,)], "runs array<struct<start: bigint, length: bigint, period: bigint>>")
    got = df.select(periodic.strongest(df.runs)).first()[0]
    assert (tuple(got) if got else None) == best
