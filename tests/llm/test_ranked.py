"""Ranked search against a plain evaluation of every item and document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from featuremart.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id bigint, text string, score int, _key string, n int"
ITEMS = "item_id bigint, text string, rank int, id string"


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k):
    """{row of items: [(id, score)]}, null ids last."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for _, text in items:
        rows = []
        for i, c in counted:
            m = 10 + (90 * sum(c.values()) * n_docs) // max(n_terms, 1)
            weight = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
            rows.append((i, sum(weight(t) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)))
        rows = sorted((r for r in rows if r[1] > 0), key=lambda r: (-r[1], r[0] is None, r[0] or 0))
        out.append(rows[:k])
    return out


def got(df, items):
    found = {}
    for r in df.collect():
        found.setdefault(r.item_id, []).append((r["rank"], r.doc_id, r.score))
    return [[x[1:] for x in sorted(found.get(i, []), key=lambda x: x[0])] for i, _ in items]


def texts(rnd, n, words=40):
    vocabulary = [f"t{int(60 * rnd.random() ** 2)}" for _ in range(200)] + ["É", "日本", "Ab"]
    return [" ,-"[rnd.randrange(3)].join(rnd.choice(vocabulary) for _ in range(rnd.randrange(1, words))) for _ in range(n)]


@pytest.mark.parametrize("block", [512, 5])
def test_random_texts(spark, block):
    rnd = random.Random(block)
    docs = [(i % 900, t) for i, t in enumerate(texts(rnd, 1300))]
    items = list(enumerate(texts(rnd, 40, 15)))
    df = spark.createDataFrame([(*d, 1, "k", 2) for d in docs], DOCS).repartition(7)
    out = ranked.search(df, spark.createDataFrame([(*i, 1, "x") for i in items], ITEMS), 10, block=block)
    assert [c for c in out.columns] == ["item_id", "rank", "doc_id", "score"]
    assert got(out, items) == plain(docs, items, 10)


def test_edges(spark):
    """Nulls, empty texts, ties, repeated rows, a giant text and a hot group of copies."""
    copies = [(1000 + i, "one two Two") for i in range(3000)]
    docs = [(1, None), (2, ""), (3, "--- \n"), (None, "one two Two"), (5, "one " * 50_000), (6, "zwei é"), (6, "zwei é"), *copies]
    items = [(1, "ONE two, two"), (2, None), (3, "!?"), (4, "unseen"), (5, "Zwei É é"), (6, "one"), (7, "one")]
    df = spark.createDataFrame([(*d, 1, "k", 2) for d in docs], DOCS)
    asked = spark.createDataFrame([(*i, 1, "x") for i in items], ITEMS)
    out = ranked.search(df, asked, 10)
    assert got(out, items) == plain(docs, items, 10)
    assert [r[0] for r in got(out, items)[0]] == list(range(1000, 1010))
    few = ranked.search(df.where("doc_id is null or doc_id < 6"), asked.union(asked.where("item_id = 1")), 3)
    assert sorted((r["rank"], r.doc_id) for r in few.where("item_id = 1").collect())[:2] == [(1, None), (1, None)]
    assert ranked.search(df.where("false"), asked).count() == 0 and ranked.search(df, asked.where("false")).count() == 0
    with pytest.raises(TypeError):
        ranked.search(df, asked, id="_key")


def test_shared_sums_are_the_plain_sums():
    rnd = np.random.default_rng(1)
    for n_items, n_terms in ((1, 1), (30, 50), (60, 200), (5, 3)):
        items = [sorted(set((n_terms * rnd.random(rnd.integers(0, 30)) ** 2).astype(int).tolist())) for _ in range(n_items)]
        plan = ranked.SharedSums(items, n_terms)
        values = rnd.integers(0, 1 << 40, (n_terms, 7))
        term, doc = np.nonzero(values >= 0)
        out = plan.scores(term, doc, values[term, doc], 7) if len(plan.items) else []
        for row, i in zip(out, plan.items):
            assert (row == values[items[i]].sum(axis=0)).all()
        assert [bool(x) for x in items] == [i in plan.items for i in range(n_items)]
        # fewer additions than without sharing
        adds = sum(len(a) for a, _ in plan.rounds) + len(plan.nodes) - len(plan.items)
        assert adds <= sum(max(len(x) - 1, 0) for x in items)
