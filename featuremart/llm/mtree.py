"""Exact top-k inner products by best-first search of a paged M-tree.

With M the greatest norm, every vector x gets one more coordinate sqrt(M^2 - |x|^2) and
a query gets 0 there. Then the squared distance of query and vector is |q|^2 + M^2 - 2 q.x, so the
largest inner products are the nearest neighbours of a metric, and the triangle inequality
bounds them.

* The root holds routing vectors from a bounded sample. Every vector belongs to its nearest one and stores the
  distance to it; each routing vector has a covering radius.
* A routing vector's members are dealt into pages of about PAGE vectors, so thousands of equal vectors are
  just several pages. A page's inner nodes are made where it is read: routing vectors with
  covering radius, distance to the parent, and members with their distances.

A query first searches one page of its nearest routing vector. Its k-th score there rules out
routing vectors, then nodes, then members: by stored distances alone before any product is computed,
nearest bound first. Scores are exact integers; bounds leave room for rounding. Pages meet
blocks of queries, never all of them at once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featuremart.llm.common import checkpointed, stored

PAGE, ROUTES, BLOCK = 1024, 256, 2048  # vectors of a page, routing vectors at most, queries of a block
LARGEST = 2.0**500  # components from here on have no finite square
EXACT = 2.0**52  # products of norms up to here have exact sums as doubles
NODE = 32
SENT = 4096  # queries' copies sent to pages at a time
#: Scores beyond a long's range count as its ends; the lower end is also the floor of a query that has none yet.
END = (1 << 63) - 1
NONE = -END


def whole_vectors(df: DataFrame, id: str = "vec_id", vector: str = "embedding", factor: int = 256) -> DataFrame:
    """``id, v`` of the usable rows: components floor(factor * x), as doubles that hold whole numbers.

    Left out: null vectors, vectors with null or non-finite components, and those with
    a component of ``LARGEST`` or more, which single-precision vectors can't have. A null id can't be reported and is left out.
    """
    x = F.transform(F.col(vector), lambda e: e.cast("double") * factor)
    good = F.forall(F.col(vector), lambda e: e.isNotNull() & (F.abs(e.cast("double") * factor) < LARGEST))  # false for NaN and infinities
    rows = df.where(F.col(id).isNotNull() & F.col(vector).isNotNull()).where(F.coalesce(good, F.lit(False)))
    whole = lambda e: F.when(F.abs(e) < 2.0**53, F.floor(e).cast("double")).otherwise(e)
    return rows.select(F.col(id).cast("bigint").alias("id"), F.transform(x, whole).alias("v"))


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return out


def _lifted(v: np.ndarray, top: float) -> np.ndarray:
    return np.c_[v, np.sqrt(np.maximum(top - (v * v).sum(1), 0))]


def _reach(norm: np.ndarray, top: float, least: np.ndarray) -> np.ndarray:
    """The distances within which vectors of a score of ``least`` or more lie, with room for the rounding of all distances."""
    whole = np.sqrt(np.maximum(norm + top - 2.0 * least, 0.0)) + 1e-6 * np.sqrt(norm + top) + 1e-3
    return np.where(least <= NONE, np.inf, whole)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0))


class Page:
    """Inner nodes of one page, below routing vector ``route``."""

    def __init__(self, ids: np.ndarray, v: np.ndarray, to_route: np.ndarray, top: float):
        order = np.lexsort((ids, to_route))
        self.ids, self.v = ids[order], v[order]
        full = _lifted(self.v, top)
        to_route = to_route[order]
        self.top = top
        picks = np.arange(0, len(ids), NODE)
        self.center, self.to_parent = full[picks], to_route[picks]
        d = _distances(full, self.center)
        node = d.argmin(1)
        own = d[np.arange(len(ids)), node]
        by_node = np.lexsort((own, node))
        self.ids, self.v, self.own = self.ids[by_node], self.v[by_node], own[by_node]
        self.begin = np.searchsorted(node[by_node], np.arange(len(picks) + 1))
        self.radius = np.array([self.own[a:b].max() if b > a else -1.0 for a, b in zip(self.begin, self.begin[1:])])

    def _scores(self, q: np.ndarray, plain: np.ndarray, a: int, b: int) -> np.ndarray:
        """Exact inner products of queries and the members from ``a`` to ``b``."""
        if plain.all():  # whole numbers whose sums are exact in any order
            return (q @ self.v[a:b].T).astype(np.int64)
        out = np.empty((len(q), b - a), np.int64)
        out[plain] = (q[plain] @ self.v[a:b].T).astype(np.int64)
        members = [[int(y) for y in row] for row in self.v[a:b]]
        for i in np.flatnonzero(~plain):
            asked = [int(x) for x in q[i]]
            out[i] = [min(max(sum(x * y for x, y in zip(asked, row)), -END), END) for row in members]
        return out

    def search(self, q: np.ndarray, skip: np.ndarray, to_route: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query number, id and score of up to ``k`` members for each query, none below its floor; ties to the smaller id.

        All queries go through the nodes together; each has its own bounds, which tighten with its ``k``-th score.
        """
        norm = (q * q).sum(1)
        plain = np.sqrt(norm) * np.sqrt(self.top) < EXACT
        bar, best = floor.copy(), np.full((len(q), k), NONE)
        far = _reach(norm, self.top, bar)
        # by distances to the parent alone
        open_ = (np.abs(to_route[:, None] - self.to_parent) - self.radius <= far[:, None]) & (self.radius >= 0)
        gap = _distances(np.c_[q, np.zeros(len(q))], self.center)
        bound = gap - self.radius
        found = [(np.empty(0, np.int64),) * 3]
        for j in np.argsort(bound.sum(0), kind="stable"):
            a, b = self.begin[j], self.begin[j + 1]
            asking = np.flatnonzero(open_[:, j] & (bound[:, j] <= far))
            lo = np.searchsorted(self.own[a:b], gap[asking, j] - far[asking], side="left")
            hi = np.searchsorted(self.own[a:b], gap[asking, j] + far[asking], side="right")
            asking, lo, hi = (x[hi > lo] for x in (asking, lo, hi))
            if not len(asking):
                continue
            a, b = a + lo.min(), a + hi.max()
            scores = self._scores(q[asking], plain[asking], a, b)
            take = (self.ids[a:b] != skip[asking, None]) & (scores >= bar[asking, None])
            row, member = np.nonzero(take)
            if not len(row):
                continue
            found.append((asking[row], self.ids[a + member], scores[row, member]))
            held = np.sort(np.c_[best[asking], np.where(take, scores, NONE)], axis=1)[:, -k:]
            best[asking], bar[asking] = held, np.maximum(bar[asking], held[:, 0])
            far[asking] = _reach(norm[asking], self.top, bar[asking])
        which, ids, scores = (np.concatenate(part) for part in zip(*found))
        kept = scores >= bar[which]
        which, ids, scores = which[kept], ids[kept], scores[kept]
        order = np.lexsort((ids, -scores, which))
        which, ids, scores = which[order], ids[order], scores[order]
        first = np.arange(len(which)) - np.searchsorted(which, which) < k
        return which[first], ids[first], scores[first]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` largest inner products with the other rows.

    Both frames have ``id, v``, as from :func:`whole_vectors`. Scores are exact; those that a long can't hold count as
    its largest or smallest value and tie there. Shorter vectors count as filled up with zeros. Candidates with the query's own id are left out; ties go to
    the smaller id. Fewer candidates give fewer rows. Rows that repeat an id are candidates of their own; a query that is
    repeated is asked once. Empty inputs give no rows.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    vectors = stored(vectors.select("id", "v"), "mtree-vectors")
    asked = queries.select("id", "v").distinct()
    norm = F.aggregate("v", F.lit(0.0), lambda t, x: t + x * x)
    sizes = vectors.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width"), F.max(norm).alias("top")).first()
    asked = checkpointed(asked.withColumn("key", F.xxhash64("id", "v")))
    many = asked.agg(F.count("*"), F.max(F.size("v"))).first()
    n, top = sizes["n"], sizes["top"] or 0.0
    width = max(sizes["width"] or 0, many[1] or 0, 1)
    if not n or not many[0]:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    routes = vectors.orderBy(F.xxhash64("id"), "id", "v").limit(min(ROUTES, -(-n // PAGE))).collect()
    centers = _lifted(_matrix([r["v"] for r in routes], width), top)

    def assign(batches):
        for b in batches:
            d = _distances(_lifted(_matrix(b["v"], width), top), centers)
            near = d.argmin(1)
            yield b.assign(route=near.astype(np.int32), far=d[np.arange(len(b)), near])

    placed = stored(vectors.mapInPandas(assign, "id bigint, v array<double>, route int, far double"), "mtree-leaves")
    cover = {r["route"]: (r["pages"], r["far"]) for r in placed.groupBy("route").agg(F.ceil(F.count("*") / PAGE).alias("pages"), F.max("far").alias("far")).collect()}
    pages = np.array([cover.get(j, (0, 0.0))[0] for j in range(len(routes))], np.int64)
    radius = np.array([cover.get(j, (0, 0.0))[1] for j in range(len(routes))])
    per_route = F.element_at(F.array(*(F.lit(int(max(p, 1))) for p in pages)), F.col("route") + 1)
    blocks = -(-many[0] // BLOCK)
    leaves = placed.withColumn("page", F.col("route") * (1 << 32) + F.pmod(F.xxhash64("id", F.lit(3)), per_route))

    def visits(first: bool):
        """Pages that each query must read: one of its nearest routing vector, or all that its floor leaves."""

        def run(batches):
            for b in batches:
                q = _matrix(b["v"], width)
                gap = _distances(np.c_[q, np.zeros(len(q))], centers)
                if first:
                    row, route = np.arange(len(b)), np.where(pages > 0, gap, np.inf).argmin(1)
                    part = b["key"].to_numpy() % pages[route]
                else:
                    far = _reach((q * q).sum(1), top, b["floor"].to_numpy())
                    row, route = np.nonzero((pages > 0) & (gap - radius <= far[:, None]))
                    times = pages[route]
                    row, route = np.repeat(row, times), np.repeat(route, times)
                    part = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                for at in range(0, len(row), SENT):
                    i, j, c = row[at : at + SENT], route[at : at + SENT], part[at : at + SENT]
                    asked = b.iloc[i]
                    yield pd.DataFrame({
                        "page": j * (1 << 32) + c, "block": asked["key"].to_numpy() % blocks, "key": asked["key"].to_numpy(), "id": asked["id"].to_numpy(),
                        "v": asked["v"].to_numpy(), "gap": gap[i, j], "floor": NONE if first else asked["floor"].to_numpy(),
                    })

        return run

    def search(page: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(page) or not len(block):
            return pd.DataFrame([], columns=["key", "query_id", "vec_id", "score"])
        tree = Page(page["id"].to_numpy(), _matrix(page["v"], width), page["far"].to_numpy(), top)
        key, id, gap, floor = (block[c].to_numpy() for c in ("key", "id", "gap", "floor"))
        which, ids, scores = tree.search(_matrix(block["v"], width), id, gap, floor, k)
        return pd.DataFrame({"key": key[which], "query_id": id[which], "vec_id": ids, "score": scores})

    def answered(asking: DataFrame, first: bool) -> DataFrame:
        sent = asking.mapInPandas(visits(first), "page bigint, block bigint, key bigint, id bigint, v array<double>, gap double, floor bigint")
        copies = leaves.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
        if first:  # only pages that are asked for
            copies = copies.join(sent.select("page", "block").distinct(), ["page", "block"], "left_semi")
        met = copies.select("page", "block", "id", "v", "far").groupBy("page", "block").cogroup(sent.groupBy("page", "block"))
        return met.applyInPandas(search, "key bigint, query_id bigint, vec_id bigint, score bigint")

    order = Window.partitionBy("key").orderBy(F.col("score").desc(), "vec_id")
    early = answered(asked, True).withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k).select("key", F.col("score").alias("floor"))
    again = checkpointed(asked.join(early, "key", "left").select("key", "id", "v", F.coalesce("floor", F.lit(NONE)).alias("floor")))
    best = answered(again, False).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
