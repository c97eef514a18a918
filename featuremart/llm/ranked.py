"""Ranked lexical search of many queries at once, with common parts evaluated once.

All items are evaluated together over each document. Terms that the same set of
items asks for form one shared set, whose partial score of a document is
accumulated once. Sets that several items have in common are then joined in
pairs, most items first, until no two nodes meet in two items: a graph that all
items share. A task walks it for a block of documents at a time, one vector
addition per node, and keeps its best documents of each item; only these are
shuffled. All sums are whole numbers, so their order does not matter.

The documents are read twice: once as text, for an index of their terms that
some item asks for (stored, whose counts give the statistics), once as that
index. Items come in blocks, so what the driver and the tasks hold is bounded
by a block and not by the number of items.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featuremart.llm.common import runs_of, stored, text_of

ITEMS = 512  # item texts of a block
DOCUMENTS = 512  # documents whose accumulators a task holds
#: Bytes that belong to terms, A-Z as a-z; all others part them. Bytes from 128 on make up the other characters.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


class SharedSums:
    """How the scores of all items come from those of single terms.

    ``leaf`` gives each term's accumulator. ``rounds`` lists nodes to add, as two
    arrays; the sums follow the nodes before them. ``nodes`` and ``starts`` list
    each item's nodes; items without terms have none and are not in ``items``.
    """

    def __init__(self, items: Sequence[Sequence[int]], terms: int):
        askers: list[list[int]] = [[] for _ in range(terms)]
        for i, of in enumerate(items):
            for t in of:
                askers[t].append(i)
        number: dict[tuple[int, ...], int] = {}
        self.leaf = np.array([number.setdefault(tuple(a), len(number)) for a in askers], np.int64)
        has = np.zeros((len(items), len(number)), bool)
        for asked, node in number.items():
            has[list(asked), node] = True
        self.leaves, self.rounds = len(number), []
        while True:
            often = np.flatnonzero(has.sum(axis=0) > 1)
            part = has[:, often].astype(np.float32)
            both = np.triu(part.T @ part, 1)
            a, b = np.nonzero(both > 1)
            order = np.lexsort((b, a, -both[a, b]))
            free, pairs = np.ones(len(often), bool), []
            for x, y in zip(a[order].tolist(), b[order].tolist()):
                if free[x] and free[y]:
                    free[x] = free[y] = False
                    pairs.append((often[x], often[y]))
            if not pairs:
                break
            left, right = np.array(pairs).T
            shared = has[:, left] & has[:, right]
            has[:, left] &= ~shared
            has[:, right] &= ~shared
            has = np.hstack([has, shared])
            self.rounds.append((left, right))
        self.items = np.flatnonzero(has.any(axis=1))
        self.nodes = np.concatenate([np.flatnonzero(has[i]) for i in self.items] or [np.zeros(0, np.int64)])
        sizes = has[self.items].sum(axis=1)
        self.starts = np.cumsum(sizes) - sizes

    def scores(self, terms: np.ndarray, documents: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
        """Scores of all ``items`` (rows) for ``size`` documents, from the values of (term, document) pairs."""
        sums = np.zeros((self.leaves + sum(len(a) for a, _ in self.rounds), size), np.int64)
        np.add.at(sums, (self.leaf[terms], documents), values)
        at = self.leaves
        for left, right in self.rounds:
            sums[at : at + len(left)] = sums[left] + sums[right]
            at += len(left)
        return np.add.reduceat(sums[self.nodes], self.starts, axis=0)


class Best:
    """The k best documents of each item so far: highest score, then smallest id, null ids last."""

    def __init__(self, items: int, k: int):
        self.k, self.border = k, np.zeros(items, np.int64)
        self.rows = [np.zeros(0, np.int64) for _ in range(3)] + [np.zeros(0, bool)]

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        item, at = np.nonzero((scores > 0) & (scores >= self.border[:, None]))
        if not len(item):
            return
        new = (item, scores[item, at], ids[at], null[at])
        item, score, ids, null = (np.concatenate(x) for x in zip(self.rows, new))
        order = np.lexsort((ids, null, -score, item))
        item = item[order]
        first = np.searchsorted(item, item)
        keep = np.arange(len(item)) - first < self.k
        self.rows = [item[keep], score[order][keep], ids[order][keep], null[order][keep]]
        full = np.arange(len(item)) - first == self.k - 1
        self.border[item[full]] = score[order][full]


def search(docs: DataFrame, items: DataFrame, k: int = 10, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", block: int = ITEMS) -> DataFrame:
    """``item, rank, id, score`` of each item's ``k`` documents with the highest scores above 0.

    Terms are runs of ASCII letters, digits and all characters beyond ASCII, A-Z
    lower-cased. With N documents that hold a term, L terms in all, n of a document
    and df documents that hold the term, a term's weight is
    floor(1000 ln((2N + 2) / (2df + 1))), and a document's score sums weight *
    (10^9 tf div (1000 tf + 8 m)) over the item's terms, with
    m = 10 + (90 n N) div L: a saturated frequency, longer texts discounted.

    Equal scores are ranked by id, null ids last; rows with equal ids and
    scores in either order. Each row of ``docs`` is a document and each row of
    ``items`` an item, repeated ones too; items with equal texts are evaluated
    once. Null texts, and items without a term that occurs, have no results. The
    ids of ``docs`` must be whole numbers; other columns are ignored.
    """
    if docs.schema[id].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise TypeError(f"{id} must be an integral column")
    spark = docs.sparkSession
    asked = items.select(F.col(item), text_of(item_text).alias("_text")).withColumn("_key", F.sha2("_text", 256))
    texts = stored(asked.select("_key", "_text").distinct(), "item-texts")
    blocks = -(-texts.count() // block)
    rows = docs.select(F.col(id).cast("bigint").alias("id"), F.encode(text_of(text), "utf-8").alias("text"))
    found = None
    for b in range(blocks):
        some = texts.where(F.pmod(F.xxhash64("_key"), F.lit(blocks)) == b).collect()
        part = _search_block(spark, rows, [r["_key"] for r in some], [terms_of(r["_text"].encode()) for r in some], k)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "_key string, id bigint, score bigint")
    order = Window.partitionBy("_key").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return asked.join(ranked, "_key").select(F.col(item), "rank", F.col("id").alias(id), "score")


def _search_block(spark: SparkSession, rows: DataFrame, keys: list[str], items: list[list[bytes]], k: int) -> DataFrame:
    """``_key, id, score``: of each task the best ``k`` documents of each item."""
    vocabulary = {t: i for i, t in enumerate(sorted(set(chain.from_iterable(items))))}
    plan = SharedSums([sorted({vocabulary[t] for t in of}) for of in items], len(vocabulary))
    known = spark.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, width = known.value.get, len(known.value)
        for batch in batches:
            at = 0
            for part in runs_of(batch.column("text").to_pylist()):
                documents = [terms_of(t) for t in part]
                sizes = np.array([len(d) for d in documents], np.int64)
                ids = np.fromiter(map(find, chain.from_iterable(documents), repeat(-1)), np.int64, int(sizes.sum()))
                of = np.repeat(np.arange(len(part)), sizes)[ids >= 0]
                codes, counts = np.unique(of * width + ids[ids >= 0], return_counts=True)
                ends = np.searchsorted(codes, np.arange(len(part) + 1) * width).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (codes % max(width, 1), counts)]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, len(part)), pa.array(sizes), *lists], ["id", "n", "terms", "counts"])
                at += len(part)

    index = stored(rows.mapInArrow(count, "id bigint, n bigint, terms array<int>, counts array<int>"), "term-index")

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, whole = np.zeros(len(known.value), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            n = batch.column("n").to_numpy(zero_copy_only=False)
            whole += (np.count_nonzero(n), n.sum())
            held += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=len(held))
        # documents and terms in all stand under -1 and -2
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, -2, np.flatnonzero(held)]), pa.array(np.r_[whole, held[held > 0]])], ["term", "n"])

    sums = {r["term"]: r["n"] for r in index.mapInArrow(totals, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    n_docs, n_terms = sums.get(-1, 0), sums.get(-2, 0)
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sums.get(t, 0) + 1))) for t in range(len(vocabulary))], np.int64)
    shared = spark.sparkContext.broadcast((plan, weights, [keys[i] for i in plan.items]))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, weights, names = shared.value
        top = Best(len(names), k)
        for batch in batches:
            n, ids = batch.column("n").to_numpy(zero_copy_only=False), batch.column("id")
            null, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(zero_copy_only=False)
            terms, counts = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("terms", "counts"))
            ends = np.r_[0, np.cumsum(batch.column("terms").value_lengths().to_numpy(zero_copy_only=False))]
            m = 10 + (90 * n * n_docs) // max(n_terms, 1)
            for lo in range(0, len(n), DOCUMENTS):
                hi = min(lo + DOCUMENTS, len(n))
                part = slice(ends[lo], ends[hi])
                if not len(names) or part.start == part.stop:
                    continue
                of = np.repeat(np.arange(hi - lo), np.diff(ends[lo : hi + 1]))
                values = weights[terms[part]] * ((1_000_000_000 * counts[part]) // (1000 * counts[part] + 8 * m[lo:hi][of]))
                top.add(plan.scores(terms[part], of, values, hi - lo), ids[lo:hi], null[lo:hi])
        item, score, ids, null = top.rows
        yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in item], pa.string()), pa.array(ids, mask=null), pa.array(score)], ["_key", "id", "score"])

    return index.mapInArrow(best, "_key string, id bigint, score bigint")
