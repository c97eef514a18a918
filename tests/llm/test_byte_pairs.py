"""Byte-level BPE against the tiktoken library, and the stitching of chunks."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from featuremart.llm import byte_pairs
from featuremart.llm.common import table
from featuremart.llm.queries import QUERIES, RANK_FILE

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, tokens string, decoded int, _row int, _at string, _rest string, m map<string, int>"


@pytest.fixture(scope="module")
def pairs():
    return byte_pairs.load_ranks(public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def plain(pairs):
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=pairs.ranks, special_tokens={})


def noise(seed, n, signs=" \n\t'.,;abcdrestvml  ABC019é日本　\xa0\x85\x1c"):
    rnd = random.Random(seed)
    return "".join(rnd.choice(signs) for _ in range(n))


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1, 2, "y", "z", {"k": 1}) for i, t in texts], SCHEMA)


def test_every_character(pairs, plain):
    chars = [chr(c) for c in (*range(0xD800), *range(0xE000, 0x110000, 37))]
    for at in range(0, len(chars), 500):
        text = "".join(f"a{c}b 1{c}{c} .{c}  {c}" for c in chars[at : at + 500])
        assert pairs.encode([text], {})[0].tolist() == plain.encode_ordinary(text)


def test_merges(pairs, plain):
    for signs in ("ab", "etaoinshrdlu", "a", "日本語", "'!?"):
        for n in (1, 2, 17, 399, 401, 5000):  # both ways of searching
            word = noise(n, n, signs)
            assert pairs.merged(word.encode()) == plain.encode_ordinary(word) or not word.isalpha()
            raw = word.encode()
            assert pairs._few(raw) == pairs._many(raw)
            assert [np.frombuffer(x, np.int32).tolist() for x in pairs.merged_all([raw, b"z", raw])] == [pairs.merged(raw), pairs.merged(b"z"), pairs.merged(raw)]


def test_certain_places_are_boundaries(pairs):
    for seed in range(300):
        text = noise(seed, 60)
        starts = {m.start() for m in pairs.cut.finditer(text)} | {0, len(text)}
        assert {m.start() for m in pairs.CERTAIN.finditer(text)} <= starts


def test_query(spark, plain):
    docs = {r.doc_id: r.text or "" for r in table(spark, SMALL, "documents").collect()}
    rows = QUERIES["op11_byte_pairs"](spark, SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = plain.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


@pytest.mark.parametrize("chunk, overlap", [(64, 16), (50, 50), (7, 3), (1, 1)])
def test_chunks(spark, pairs, plain, chunk, overlap):
    endless = "x" * 500 + " " * 300 + "y" * 200  # no place to stitch
    texts = [(1, None), (2, ""), (3, noise(3, 700)), (3, noise(3, 700)), (None, endless), (5, noise(5, 64)), (6, "it's we're <|endoftext|> " * 40), (7, "日本語。" * 200)]
    rows = byte_pairs.encode(frame(spark, texts), pairs, decoded="decoded", chunk=chunk, overlap=overlap).collect()
    want = sorted((i or 0, t or "", plain.encode_ordinary(t or "")) for i, t in texts)
    assert sorted((r.doc_id or 0, r.text or "", r.tokens) for r in rows) == want
    assert all(r.decoded == (r.text or "") and (r._row, r._at, r._rest, r.m) == (2, "y", "z", {"k": 1}) for r in rows)


def test_long_text_and_hot_chunks(spark, pairs, plain):
    """Most chunks belong to one text."""
    text = noise(1, 200_000, "abc def. ghi's 12\n")
    texts = [(1, text)] + [(k, "short one") for k in range(2, 50)]
    rows = byte_pairs.encode(frame(spark, texts), pairs, chunk=4096, overlap=256).collect()
    assert next(r.tokens for r in rows if r.doc_id == 1) == plain.encode_ordinary(text) and len(rows) == 49


def test_decode(spark, pairs):
    df = spark.createDataFrame([(1, [64, 65]), (2, []), (3, None)], "id int, tokens array<int>")
    assert [bytes(r.decoded) for r in byte_pairs.decode(df, pairs).orderBy("id").collect()] == [pairs.decode([64, 65]), b"", b""]
    none = frame(spark, [(1, "")]).where("doc_id < 0")
    assert byte_pairs.encode(none, pairs).count() == 0
    with pytest.raises(ValueError):
        byte_pairs.encode(none, pairs, chunk=4, overlap=5)
