"""The registered queries over the smallest tables, against SQL or plain versions."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from featuremart.llm import classifier
from featuremart.llm.common import table
from featuremart.llm.pieces import load_vocabulary
from featuremart.llm.queries import LINE_RULE, MIX_SEED, ORACLES, QUALITY_FROM, QUERIES

import brute

SMALL = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "labels", "benchmark")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SMALL}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in table(spark, SMALL, "documents").collect()}


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_all_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_copies", "mixture", "encoded"]


@pytest.mark.parametrize("name", ORACLES)
def test_same_rows_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    theirs = duck.sql(ORACLES[name])
    assert sorted(theirs.columns) == columns
    want = theirs.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall()
    assert ordered(map(tuple, df.select(columns).collect())) == ordered(want)


@pytest.mark.parametrize("name", ["op1_line_dedup", "op3_quality_rules", "op8_secrets"])
def test_native_plans_hold_no_python(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct"))


def test_language_model(spark, docs):
    want = brute.base_scores([(i, r.text) for i, r in docs.items()])
    rows = QUERIES["op2_lm_scoring"](spark, SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        tokens, known, total, base = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (tokens, known, total, brute.remainder(r.doc_id, 7) == 2)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
    held = [r for r in rows if r.held_out]
    # far better than eight bits, also on texts that taught nothing
    assert sum(r.bits_per_byte * r.n_bytes for r in held) / sum(r.n_bytes for r in held) < 3.5


def test_quality_rules(spark, docs):
    rows = QUERIES["op3_quality_rules"](spark, SMALL).collect()
    labels = {r.doc_id: r.quality for r in table(spark, SMALL, "labels").collect()}
    for r in rows:
        n, *others = brute.quality_counts(docs[r.doc_id].text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, *others)
        assert r.base_failed == (n < 20 or 100 * others[-1] > 30 * n)
        assert not (r.base_failed and r.kept)
    good = [r.kept for r in rows if labels.get(r.doc_id) == 1 and not r.base_failed]
    assert len(rows) == len(docs) and sum(good) >= 0.97 * len(good)


def test_quality_classifier(spark, docs):
    rows = QUERIES["op5_quality_classifier"](spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r.quality for r in table(spark, "/root/testdata/sf0.01", "labels").collect()}
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p == y for p, y in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_pieces(spark, docs):
    v = load_vocabulary()
    rows = QUERIES["op6_sentencepiece"](spark, SMALL).collect()
    assert len(rows) == len(docs) and all(r.same_text for r in rows)
    assert all(r.pieces == brute.pieces(docs[r.doc_id].text, v) for r in rows)


def test_secrets(spark, docs):
    for r in QUERIES["op8_secrets"](spark, SMALL).collect():
        base = brute.secrets(docs[r.doc_id].text)
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(base.count(f"{k}:") for k in ("assign", "access", "hex"))


def test_jaccard_join(spark, docs):
    want = brute.components([(i, r.text) for i, r in docs.items()], 4, 85)
    rows = QUERIES["op9_jaccard_join"](spark, SMALL).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want


def test_pipeline(spark, docs):
    """run() against the plain stages; the classifier's model is shared, its features are not."""
    model = classifier.train(table(spark, SMALL, "documents"), table(spark, SMALL, "labels"))
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.values() if model.score(brute.features(r.text)[None])[0] >= QUALITY_FROM]
    texts = brute.without_boilerplate([(r[3], r[1]) for r in rows], LINE_RULE["ratio"], LINE_RULE["min_pages"], LINE_RULE["long_ratio"], LINE_RULE["long_pages"])
    rows = [(i, t, lang, source) for (i, _, lang, source), t in zip(rows, texts)]
    groups = brute.components([(r[0], r[1]) for r in rows], 5, 80)
    rows = [r for r in rows if groups[r[0]][1] == r[0]]
    taken = brute.mixture([(i, lang, source, len(brute.words(t))) for i, t, lang, source in rows], corpus_pipeline.KEPT_SHARE, 1, MIX_SEED)
    v = load_vocabulary()
    want = {r[0]: brute.pieces(r[1], v) for r in rows if r[0] in taken}
    got = {r.doc_id: r.pieces for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert got == want and 0 < len(want) < len(docs)
