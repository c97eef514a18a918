"""The language model against a plain version that takes one decision at a time."""

import math
import tracemalloc

import numpy as np
import pytest

from featuremart.llm import mixing_lm as lm

MASK = (1 << 64) - 1


def paths(code):
    """Per byte its decisions: (hashed node, answer)."""
    return [[(int(code.node[s + j]), int(code.bit[s + j])) for j in range(n)] for s, n in zip(code.start, code.length)]


def plain_slots(text, i, node):
    """The slots that a decision of byte ``i`` reads, from the bytes before it alone."""
    back = [text[i - k] if i >= k else 10 for k in range(1, 7)]
    two = back[0] | back[1] << 8
    four = two | back[2] << 16 | back[3] << 24
    six = ((back[4] | back[5] << 8) * 0x85EBCA6B ^ four) & 0xFFFFFFFF
    word = text[:i].split(b" ")[-1]
    h = sum((b + 1) * pow(0x5851F42D4C957F2D, j, 1 << 64) for j, b in enumerate(word)) & MASK
    h = ((h ^ h >> 29) * 0x9FB21C651E98DF25 & MASK) >> 32
    out = []
    for c, bits in zip((two, four, six, h), lm.BITS):
        x = (c * 0x9E3779B1 & 0xFFFFFFFF) ^ node
        x ^= x >> 15
        out.append((x * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - bits))
    return out


def plain_loss(text, code, tables, weights, extra):
    """Nats of one text: log odds mixed under a gate's weights, corrected, and both learnt after each block."""
    walk, borders = paths(code), set(map(int, lm.borders_of(len(text))))
    weights, extra = [list(map(float, w)) for w in weights], list(map(float, extra))
    total, block = 0.0, []
    for i, byte in enumerate(text):
        for node, y in walk[byte]:
            packed = [int(tables[k][s]) for k, s in enumerate(plain_slots(text, i, node))]
            x = [((p & 63) - 32) / lm.STEPS for p in packed]
            gate = (packed[2] >> 6) + 4 * (packed[3] >> 6)
            z = sum(w * v for w, v in zip(weights[gate], x))
            kind = min(max(int((z + 8) * 2), 0), lm.CLASSES - 1) if z > -8 else 0
            z = min(max(z + extra[kind], -12), 12)
            p = 1 / (1 + math.exp(-z))
            total -= math.log(p if y else 1 - p)
            block.append((gate, kind, x, y - p, p * (1 - p)))
        if i + 1 in borders:
            for g in {b[0] for b in block}:
                mine = [b for b in block if b[0] == g]
                slope = 30 + sum(b[4] * sum(v * v for v in b[2]) for b in mine)
                for k in range(lm.K):
                    weights[g][k] += lm.RATE * sum(b[3] * b[2][k] for b in mine) / slope
            for c in {b[1] for b in block}:
                mine = [b for b in block if b[1] == c]
                extra[c] += lm.REFINE * sum(b[3] for b in mine) / (sum(b[4] for b in mine) + 6)
            block = []
    return total


def corpus(n, seed, words=40):
    rng = np.random.default_rng(seed)
    return [b" ".join(rng.choice([b"the", b"cat", b"sat", b"on", b"mats", "größe".encode(), b"7"], words)) + b" \n" for _ in range(n)]


@pytest.fixture(scope="module")
def model():
    code = lm.Code(np.bincount(np.frombuffer(b"".join(corpus(20, 1)), np.uint8), minlength=256))
    counts = lm.count_tables(iter(corpus(50, 2)), code)
    return code, counts, [lm.odds(t) for t in counts]


def test_counts_equal_the_plain_version(model):
    code, counts, _ = model
    expected, walk = [{} for _ in counts], paths(code)
    for text in corpus(50, 2):
        for i, byte in enumerate(text):
            for node, y in walk[byte]:
                for k, s in enumerate(plain_slots(text, i, node)):
                    expected[k][2 * s + y] = expected[k].get(2 * s + y, 0) + 1
    for got, want in zip(counts, expected):
        assert {int(i): int(got[i]) for i in np.flatnonzero(got)} == want


def test_score_equals_the_plain_version(model):
    code, _, tables = model
    texts = [*corpus(4, 3), b"\n", b"the \n", *corpus(1, 4, 900), b"unseen " * 30 + b"\n"]
    rng = np.random.default_rng(5)
    start = rng.uniform(0, 0.5, (lm.GATES, lm.K)), rng.normal(0, 0.1, lm.CLASSES)
    got = lm.mixed_loss(texts, code, tables, start)
    for one, text in zip(got, texts):
        assert one == pytest.approx(plain_loss(text, code, tables, *start), rel=1e-3)


def test_windows_hold_the_contexts_of_the_whole(model, monkeypatch):
    """Texts and words that go over several windows have the contexts, counts and costs that they have alone."""
    code, counts, tables = model
    texts = [b"a" * 9000 + b" bb \n", *corpus(30, 6, 300), b"x " + b"y" * 5000 + b" " + b"z" * 4096 + b" \n"]
    long = b"".join(t[:-1] for t in texts) + b"\n"
    wide = [lm.contexts(*lm._joined(some)) for some in (texts, [long])]
    lesson, loss = lm.lesson(texts, code, tables, lm.WEIGHTS.astype(float)), lm.mixed_loss([long], code, tables)
    several = lm.mixed_loss(texts, code, tables)
    monkeypatch.setattr(lm, "WINDOW", 2048)
    for some, want in zip((texts, [long]), wide):
        parts = [seen for _, seen in lm.windows(some)]
        assert len(parts) > 5
        for k, all_ in enumerate(want):
            assert (np.concatenate([p[k] for p in parts]) == all_).all()
    assert np.allclose(lm.lesson(texts, code, tables, lm.WEIGHTS.astype(float)), lesson)
    assert np.allclose(lm.mixed_loss([long], code, tables), loss, rtol=1e-6)
    assert np.allclose(lm.mixed_loss(texts, code, tables), several, rtol=1e-6)


def test_memory_of_a_giant_text(model):
    code, _, tables = model
    giant = b" ".join(corpus(1, 7, 400_000)).replace(b"\n", b"") * 4 + b"\n"
    assert len(giant) > 6 << 20
    tracemalloc.start()
    lm.mixed_loss([giant], code, tables)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20
